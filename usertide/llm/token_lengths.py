"""Token counts: an exact length histogram with suffix sums.

Documents are reduced to their encoded lengths, lengths to a histogram, and the histogram to running sums
from the long end.  One row per distinct length then answers totals, quantiles and truncated totals for
every context limit, however many documents there were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.llm.bpe import encode
from usertide.session import materialize

#: Lengths per block of the running sums.
BLOCK = 1024


def lengths(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text_col: str = "text") -> DataFrame:
    """Rows ``n_tokens``, one per document; null and empty texts have 0."""
    return encode(docs.select(text_col), ranks, pattern, text_col=text_col, ids_col="ids").select(F.size("ids").cast("long").alias("n_tokens"))


def histogram(counts: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with sums over all documents of that length and longer or shorter.

    ``n_docs`` have this length, ``docs_longer`` more; ``docs_up_to`` and ``tokens_up_to`` count documents of
    this length and shorter; ``tokens_truncated`` is the total if this length were the limit.  Null lengths
    are left out; no rows give none.  Sums run within blocks of lengths and over the blocks' totals, so
    neither window holds more than a block or the number of blocks.  The counts are stored once, as both the
    rows and the blocks read them; nothing above them asks for a document's length again.
    """
    rows = materialize(counts.groupBy(F.col(length_col).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))).where("length is not null")
    rows = rows.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    starts = totals.select(
        "block",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("d").over(everything).alias("all_docs"),
    )
    out = rows.join(starts, "block")
    docs_up_to = F.sum("n_docs").over(inside) + F.col("docs_before")
    tokens_up_to = F.sum("tokens").over(inside) + F.col("tokens_before")
    out = out.withColumn("docs_up_to", docs_up_to).withColumn("tokens_up_to", tokens_up_to).withColumn("docs_longer", F.col("all_docs") - F.col("docs_up_to"))
    truncated = F.col("tokens_up_to") + F.col("docs_longer") * F.col("length")
    return out.select("length", "n_docs", "docs_up_to", "docs_longer", "tokens_up_to", truncated.alias("tokens_truncated"))


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit the documents that fit, the longer ones, and the total after truncation; one pass."""
    asked = F.explode(F.array(*(F.lit(x).cast("long") for x in sorted(set(limits))))).alias("limit")
    rows = table.select("length", "n_docs", asked)
    fits = F.col("length") <= F.col("limit")
    return rows.groupBy("limit").agg(
        F.sum(F.when(fits, F.col("n_docs")).otherwise(0)).alias("docs_that_fit"),
        F.sum(F.when(fits, 0).otherwise(F.col("n_docs"))).alias("docs_truncated"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("tokens"),
    )


def quantile(table: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents don't exceed; none without documents."""
    found = table.where((F.col("docs_up_to") >= F.lit(share) * (F.col("docs_up_to") + F.col("docs_longer"))) & (F.col("docs_up_to") > 0))
    return found.agg(F.min("length")).first()[0]
