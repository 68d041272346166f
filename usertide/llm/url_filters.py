"""URL filters with redirect equivalence.

Rules name a host, with all its subdomains, and a path beginning; the longest that fits decides.  URLs that
redirect to each other or name each other as canonical are aliases: connected components over those edges
carry a block decision to every alias without a rule of its own, unless an alias is explicitly allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm.components import components
from usertide.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*[0-9.]*\s*;\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def identity(url: Column) -> Column:
    """The URL as a node: without its fragment, host in lower case; null without ``://``."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    rest = plain.substr(F.length(F.regexp_extract(plain, r"(?s)^.*?://[^/?]*", 0)) + 1, F.length(plain))
    scheme = F.translate(F.regexp_extract(plain, r"(?s)^(.*?)://", 1), UPPER, LOWER)
    return F.when(plain.contains("://"), F.concat(scheme, F.lit("://"), host_of(plain), rest))


def resolved(base: Column, link: Column) -> Column:
    """An absolute URL from a link as it stands on the page ``base``."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    origin = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.concat(origin, F.coalesce(F.nullif(F.regexp_extract(path_of(base), r"(?s)^.*/", 0), F.lit("")), F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?):", 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows ``source, target``: the canonical links and meta refreshes of pages."""
    html = F.col(html_col)
    links = F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(REFRESH), F.lit(1)))
    found = pages.where(F.col(url_col).contains("://")).select(F.col(url_col).alias("base"), F.explode(links).alias("link"))
    return found.select(F.col("base").alias("source"), resolved(F.col("base"), F.col("link")).alias("target"))


def ruled(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``host, path`` of ``places`` that a rule fits, with ``rule, verdict`` of the longest.

    Hosts meet rules by an equal join on each of their suffixes, so long rule lists aren't compared one by one.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wide = places.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
    own = rules.select("rule_host", "rule_path", "verdict").where("rule_host is not null and rule_path is not null")
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("size"), F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("allow"), rule.alias("rule"), F.col("verdict").alias("verdict")))
    fits = wide.join(own, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    *,
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    ``rules`` has ``rule_host``, ``rule_path`` and ``verdict``; of equally long rules that fit, allow wins.
    ``redirects`` adds edges ``source, target`` to those that the pages declare.  A URL with a rule keeps
    the rule's verdict.  Without one it is blocked if an alias is blocked by a rule and none is allowed by
    one, else allowed.  Null URLs and URLs without ``://`` have an empty host and path and are allowed
    unless a rule names the empty host.  Rows may repeat; an empty table gives no rows.  Added columns
    replace columns of the same name.
    """
    url = F.col(url_col)
    rows = pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    links = declared_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    aliases = materialize(components(links.select(identity(F.col("source")).alias("a"), identity(F.col("target")).alias("b"))))
    places = aliases.select(host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    known = materialize(ruled(rows.select("host", "path").union(places), rules))
    votes = (
        aliases.withColumn("host", host_of(F.col("node")))
        .withColumn("path", path_of(F.col("node")))
        .join(known, ["host", "path"])
        .groupBy("component")
        .agg(F.max((F.col("verdict") == "block").cast("int")).alias("block"), F.max((F.col("verdict") == "allow").cast("int")).alias("allow"))
        .where("block = 1 and allow = 0")
    )
    blocked = aliases.join(votes, "component").select(F.col("node").alias("__node"), F.lit(True).alias("__blocked"))
    out = rows.drop("rule", "verdict").join(known, ["host", "path"], "left").withColumn("__node", identity(url)).join(blocked, "__node", "left")
    by_alias = F.when(F.col("__blocked"), "block").otherwise("allow")
    out = out.withColumn("verdict", F.coalesce("verdict", by_alias))
    return out.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")], "host", "path", "rule", "verdict")
