"""The registered queries: each applies one operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.llm import alignment, archives, bpe, decontamination, exact_dedup, language_id, near_duplicates, pii, spelling, token_lengths, toxicity, url_filters, vectors
from usertide.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of a table reader under ``name``, with the SQL that must give the same rows."""

    def add(build: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return add


def rank_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op1_language_id")
def op1(table: Callable) -> DataFrame:
    docs = table("documents").select("doc_id", "text", "lang")
    return language_id.language_id(docs).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


OP2_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n
    FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS size
    FROM item_words, generate_series(1, len(w) - least(13, len(w)) + 1) AS s(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM windows),
doc_windows AS (
    SELECT doc_id, pos, size,
           string_agg(word, ' ') OVER (PARTITION BY doc_id, size ORDER BY pos ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS win
    FROM doc_words, sizes
),
hits AS (SELECT doc_id, pos, d.size, item_id FROM doc_windows d JOIN windows w ON d.win = w.win AND d.size = w.size),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
),
lengths AS (SELECT doc_id, max(n) AS n FROM doc_words GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n, 0) AS contaminated
FROM documents d LEFT JOIN lengths USING (doc_id) LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op2_decontamination", OP2_SQL)
def op2(table: Callable) -> DataFrame:
    found = decontamination.contamination(table("documents").select("doc_id", "text"), table("benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP3_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
    SELECT DISTINCT hex,
           list_transform(range(1, 41), lambda i: instr('0123456789abcdef', substr(hex, i, 1)) - 1) AS nibbles
    FROM payloads
),
-- Five hexadecimal digits are four base32 letters.
digests AS (
    SELECT hex, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        ((nibbles[k // 4 * 5 + 1] * 65536 + nibbles[k // 4 * 5 + 2] * 4096 + nibbles[k // 4 * 5 + 3] * 256
          + nibbles[k // 4 * 5 + 4] * 16 + nibbles[k // 4 * 5 + 5]) >> (15 - k % 4 * 5)) & 31 AS BIGINT), 1)), '') AS digest
    FROM bits
),
firsts AS (SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN digests USING (hex) JOIN firsts USING (hex)
"""


@query("op3_warc_archives", OP3_SQL)
def op3(table: Callable) -> DataFrame:
    return archives.archived(table("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# The pages declare no canonical links or refreshes, so every URL is its own component here.
OP4_SQL = """
WITH rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
places AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
),
fits AS (
    SELECT page_id, rule_host || rule_path AS rule, verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place_no
    FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM places p LEFT JOIN fits f ON p.page_id = f.page_id AND place_no = 1
"""


@query("op4_url_filters", OP4_SQL)
def op4(table: Callable) -> DataFrame:
    pages = table("pages").select("page_id", "url", "html")
    rules = pages.sparkSession.createDataFrame(RULES, "rule_host string, rule_path string, verdict string")
    return url_filters.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op5_nearest_vectors")
def op5(table: Callable) -> DataFrame:
    return vectors.nearest_vectors(table("embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_token_lengths")
def op6(table: Callable) -> DataFrame:
    ranks = bpe.load_ranks(rank_file())
    return token_lengths.histogram(token_lengths.lengths(table("documents"), ranks, public_tokenizers.PATTERN))


@query("op7_near_duplicates")
def op7(table: Callable) -> DataFrame:
    return near_duplicates.near_duplicates(table("documents"))


@query("op8_toxicity")
def op8(table: Callable) -> DataFrame:
    scored = toxicity.toxicity(table("documents").select("doc_id", "text"), table("labels"))
    return scored.select("doc_id", "held_out", F.col("toxicity_score").alias("score"), F.col("toxicity_predicted").alias("predicted"))


@query("op9_pii_surrogates")
def op9(table: Callable) -> DataFrame:
    return pii.replace_pii(table("documents").select("doc_id", "text"))


@query("op10_byte_bpe")
def op10(table: Callable) -> DataFrame:
    ranks = bpe.load_ranks(rank_file())
    coded = bpe.decode(bpe.encode(table("documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN), ranks)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(bpe.packed("ids"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op11_token_alignment")
def op11(table: Callable) -> DataFrame:
    a_path, b_path = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.aligned_with_counts(table("documents").select("doc_id", "text"), a_path, b_path, keep=["doc_id"])
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_spelling_variants")
def op12(table: Callable) -> DataFrame:
    return spelling.spelling_variants(table("documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""


@query("op13_exact_duplicates", OP13_SQL)
def op13(table: Callable) -> DataFrame:
    rows = exact_dedup.fingerprint(table("documents").select("doc_id", "text")).select("doc_id", "text_sha256")
    return exact_dedup.exact_duplicates(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
