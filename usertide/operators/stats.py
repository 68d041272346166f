"""Summary statistics: describe tables, histograms, box-plot figures, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.functions.numeric import share_of
from usertide.operators.ranking import present, quantile_name
from usertide.operators.selection import quantiles
from usertide.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def to_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., metric, value) for the non-missing values of ``columns``."""
    values = [present(F.col(c)).alias(c) for c in columns]
    return (
        df.select(*by, *values).unpivot(list(by), list(columns), "metric", "value").filter(F.col("value").isNotNull())
    )


def describe(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float] = QUARTILES, digits: int | None = None
) -> DataFrame:
    """One row per column: metric, n, mean, std (sample), min, quantiles, max.

    Quantiles are exact and come from passes of counts (:mod:`usertide.operators.selection`), so ``df`` is read several times:
    it should be a stored table or a cheap view of one.
    """
    rows = to_long(df, columns)
    moments = materialize(
        rows.groupBy("metric").agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
        )
    )
    found = moments.join(quantiles(rows, "value", shares, moments, ["metric"]), "metric")
    stats = ["mean", "std", "min", *[quantile_name(s) for s in shares], "max"]
    rounded = [F.col(c) if digits is None else F.round(c, digits).alias(c) for c in stats]
    found = found.select("metric", "n", *rounded)
    # One row per requested column, so a column without any value still shows, with n = 0.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "metric string")
    return names.join(found, "metric", "left").na.fill(0, ["n"])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 100) -> DataFrame:
    """Equal-width bins per column, empty ones included: metric, bin (0-based), lower, upper, n.

    Bins are left-closed and the last one also takes its right edge.  A column with a single value
    gets a range of 1 around it.
    """
    rows = to_long(df, columns)
    spans = [
        F.struct(F.lit(c).alias("metric"), F.min(present(F.col(c))).alias("lo"), F.max(present(F.col(c))).alias("hi"))
        for c in columns
    ]
    single = F.col("lo") == F.col("hi")
    limits = df.agg(F.array(*spans).alias("spans")).select(F.inline("spans")).filter("lo is not null")
    limits = limits.select(
        "metric",
        F.when(single, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(single, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )

    def edge(index):
        return F.col("lo") + index * ((F.col("hi") - F.col("lo")) / bins)

    position = (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins
    guess = F.least(F.floor(position), F.lit(bins - 1))
    # Rounding in the division can land next to the true bin; the edges decide.
    settled = (
        F.when(F.col("value") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("value") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    # ``limits`` has one row per requested column.
    filled = (
        rows.join(F.broadcast(limits), "metric")
        .withColumn("guess", guess)
        .groupBy("metric", settled.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    upper = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(edge(F.col("bin") + 1))
    return frame.join(filled, ["metric", "bin"], "left").select(
        "metric",
        "bin",
        edge(F.col("bin")).alias("lower"),
        upper.alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Per group and column: quartiles, whisker ends (last values within 1.5 IQR) and outlier count.

    ``by`` must take few values.  Quartiles come from passes of counts, the rest from one aggregate, so ``df`` is read
    several times.
    """
    keys = [by, "metric"]
    rows = to_long(df, columns, [by])
    sizes = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    boxes = quantiles(rows, "value", QUARTILES, sizes, keys)
    boxes = materialize(boxes.select(F.col(by).alias("_by"), F.col("metric").alias("_metric"), *[quantile_name(s) for s in QUARTILES]))
    q1, q3 = F.col(quantile_name(0.25)), F.col(quantile_name(0.75))
    reach = (q3 - q1) * 1.5
    # A row per group and column.
    placed = rows.join(F.broadcast(boxes), F.col(by).eqNullSafe(F.col("_by")) & (F.col("metric") == F.col("_metric")))
    placed = placed.withColumn("_inside", F.col("value").between(q1 - reach, q3 + reach))
    return placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.max(quantile_name(s)).alias(quantile_name(s)) for s in QUARTILES],
        F.min(F.when(F.col("_inside"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("_inside"), F.col("value"))).alias("whisker_high"),
        F.count_if(~F.col("_inside")).alias("outliers"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, ordered by value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(column)
    )


def value_shares(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Percentage of the non-null rows per value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.select(column, "n", share_of(F.col("n"), total, digits).alias("pct"))
