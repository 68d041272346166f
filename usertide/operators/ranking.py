"""Exact global ranks, cumulative counts and quantiles without a single-task sort.

Rows are first reduced to one row per distinct value and stored, range-partitioned by value, with the number
of their range.  Range totals give each range its offset, and a window inside the range adds the rest.  The
ranges decide only how even the work is, never the result; there are as many as shuffle partitions, whatever
the data, and the offset table has at most one row per range and group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.schema import quoted
from usertide.session import materialize

RANGE = "__range"


def present(col: Column) -> Column:
    """The value as a double, with NaN treated as missing."""
    value = col.cast("double")
    return F.when(~F.isnan(value), value)


def value_table(df: DataFrame, value: str, measures: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One stored row per (``by``, distinct ``value``) with additive ``measures`` and the row's range.

    Missing values form one row.
    """
    counts = (
        df.withColumn(value, present(F.col(quoted(value))))
        .groupBy(*[quoted(c) for c in (*by, value)])
        .agg(*[m.alias(name) for name, m in measures.items()])
    )
    ranged = counts.repartitionByRange(parallelism(df), quoted(value)).withColumn(RANGE, F.spark_partition_id())
    return materialize(ranged)


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def add_range(df: DataFrame, value: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Add the number of cut points not above ``value``."""
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)


def running_totals(
    counts: DataFrame, value: str, measures: Sequence[str], by: Sequence[str] = (), previous: bool = False
) -> DataFrame:
    """Running totals over a :func:`value_table`, missing values left out.

    For each measure m the result holds m, m_before (sum over smaller values) and m_total; with
    ``previous`` also m_previous, the measure of the next smaller value (null for the smallest).
    ``by`` must take few values: the offset table holds a row per range for each of them.
    """
    by = list(by)
    known = counts.filter(F.col(value).isNotNull())
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    rows = _with_offsets(known, value, measures, by, group)
    ordered = Window.partitionBy(*by, RANGE).orderBy(value)
    smaller = ordered.rowsBetween(Window.unboundedPreceding, -1)
    columns = [*by, value]
    for m in measures:
        before = F.col(f"_offset_{m}") + F.coalesce(F.sum(m).over(smaller), F.lit(0))
        columns += [m, before.alias(f"{m}_before"), f"{m}_total"]
        if previous:
            columns.append(F.coalesce(F.lag(m).over(ordered), F.col(f"_below.{m}")).alias(f"{m}_previous"))
    return rows.select(*columns)


def _with_offsets(ranged: DataFrame, value: str, measures: Sequence[str], by: list[str], group) -> DataFrame:
    """Rows with the totals of the ranges below theirs and of all ranges."""
    in_order = group.orderBy(RANGE)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, RANGE).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.max_by(F.struct(*measures), F.col(value)).alias("_top"),
    )
    offsets = totals.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col(RANGE).alias("_range_key"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_offset_{m}") for m in measures],
        *[F.sum(m).over(group).alias(f"{m}_total") for m in measures],
        F.lag("_top").over(in_order).alias("_below"),
    )
    same = [F.col(RANGE) == F.col("_range_key")]
    same += [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    if not by:
        # One row per shuffle partition at most.
        offsets = F.broadcast(offsets)
    return ranged.join(offsets, same)


def ordered_counts(
    df: DataFrame, value: str, measures: Mapping[str, Column], by: Sequence[str] = (), previous: bool = False
) -> DataFrame:
    """:func:`running_totals` straight from rows."""
    return running_totals(value_table(df, value, measures, by), value, list(measures), by, previous)


def average_rank(count: str = "n") -> Column:
    """Rank of a value among all rows when tied rows share the mean of their ranks."""
    return F.col(f"{count}_before") + (F.col(count) + 1) / 2


def percentile_ranks(counts: DataFrame, value: str, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Running totals of a :func:`value_table` with each value's average rank as a percentage of all ranked rows."""
    return running_totals(counts, value, measures).withColumn("percentile", average_rank() / F.col("n_total") * 100)


def look_up_by_value(rows: DataFrame, ranks: DataFrame, value: str, found: str) -> DataFrame:
    """``rows`` with the column ``found`` of ``ranks``, which has a row per distinct ``value`` with counts n and n_total.

    The ranks are stored.  Rows of each frequent value are dealt over several tasks, and the few matching
    rank rows are repeated once per task; null values match nothing and are dealt out the same way.  Whether
    the join broadcasts is left to the optimizer.
    """
    tasks = parallelism(rows)
    known = ranks.select(F.col(value).alias("__value"), F.col("n").alias("__n"), F.col("n_total").alias("__total"), F.col(found).alias("__found"))
    known = materialize(known)
    # Fewer than ``tasks`` values can each hold more than 1/tasks of the rows.
    frequent = [r[0] for r in known.filter(F.col("__n") * tasks > F.col("__total")).select("__value").collect()]
    here = F.col(quoted(value))
    crowded = lambda c: c.isin(frequent) if frequent else F.lit(False)
    dealt = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c, kind in rows.dtypes if not kind.startswith("map")]), F.lit(tasks)).cast("int")
    salted = rows.withColumn("__salt", F.when(crowded(here) | here.isNull(), dealt).otherwise(0))
    copies = F.when(crowded(F.col("__value")), F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0)))
    spread = known.select("__value", "__found", F.explode(copies).alias("__copy"))
    joined = salted.join(spread, (here == F.col("__value")) & (F.col("__salt") == F.col("__copy")), "left")
    return joined.withColumn(found, F.col("__found")).drop("__salt", "__value", "__found", "__copy")


def quantile_columns(value: str, shares: Sequence[float], count: str = "n") -> dict[str, Column]:
    """Aggregates over :func:`running_totals` rows giving linearly interpolated quantiles."""
    before, own, total = F.col(f"{count}_before"), F.col(count), F.col(f"{count}_total")

    def value_at(position: Column) -> Column:
        return F.max(F.when((before <= position) & (position < before + own), F.col(value)))

    found = {}
    for share in shares:
        target = F.lit(float(share)) * (total - 1)
        low, high = value_at(F.floor(target)), value_at(F.ceil(target))
        part = F.max(target - F.floor(target))
        found[quantile_name(share)] = low + (high - low) * part
    return found


def quantile_name(share: float) -> str:
    return f"p{share * 100:g}".replace(".", "_")
