"""Exact order statistics by radix selection: counts per prefix of an ordered number, no sort and no stored values.

A double is taken as a 64-bit integer of the same order.  A pass counts the rows per next 16 bits among the rows whose
number begins like a wanted one, which says in which prefix each wanted rank lies.  Two passes usually leave few rows, and those
are ranked; four leave equal ones.  Every pass is one aggregate that is combined per task, so a task sends at most 65,536
counts for each prefix still in question, whatever the number of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.operators.ranking import present, quantile_name
from usertide.schema import quoted
from usertide.session import materialize

STEP_BITS = 16
#: Rows of one prefix that are ranked in a window instead of being split further.
FEW = 10_000
#: Wanted ranks (some 40 bytes each) that are broadcast at most.
BROADCAST_RANKS = 100_000
MANTISSA = 52


def with_ordered_bits(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with ``name``, a bigint of the same order as the double ``value``: sign, exponent and mantissa.

    Zeros of both signs are equal; NaN is no number.  Each step is a column of its own, so that it is computed once.
    """
    x, p, e = F.col("_x"), F.col("_power"), F.col("_exponent")
    steps = df.withColumn("_x", F.abs(F.col(quoted(value)).cast("double")))
    steps = steps.withColumn("_exponent", F.least(F.greatest(F.floor(F.log2(x)), F.lit(-1022).cast("bigint")), F.lit(1023).cast("bigint")).cast("int"))
    # Powers of two are exact; the logarithm may be off by one beside them.
    steps = steps.withColumn("_power", F.pow(F.lit(2.0), e.cast("double")))
    below, above = (x < p) & (e > -1022), (x / 2 >= p) & (e < 1023)
    move = F.when(below, -1).when(above, 1).otherwise(0)
    # A mantissa below 1 has no leading bit of its own, so its exponent counts as the smallest.
    scaled = (x / (p * F.when(below, 0.5).when(above, 2.0).otherwise(1.0)) * F.lit(float(2**MANTISSA))).cast("bigint")
    bits = (e + move + 1022).cast("bigint") * F.lit(2**MANTISSA) + scaled
    size = F.when(x == 0, F.lit(0).cast("bigint")).when(x == float("inf"), F.lit(2047 << MANTISSA)).otherwise(bits)
    return steps.withColumn(name, size * F.when(F.col(quoted(value)) < 0, -1).otherwise(1)).drop("_x", "_power", "_exponent")


def _same(names: Sequence[str], other: str) -> Column:
    return reduce(and_, [F.col(quoted(c)).eqNullSafe(F.col(f"{other}{i}")) for i, c in enumerate(names)])


def select_ranks(rows: DataFrame, value: str, ranks: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., rank, value): the value at each 0-based rank among the non-missing values of its group.

    ``ranks`` has ``by`` and ``rank``, a few for each group, and may have ``n``, the group's number of values, which saves small
    groups the passes.  Ranks that a group doesn't have are left out.  ``rows`` is read once per pass, at most five times,
    and should be a stored table or a cheap view of one.
    """
    by = list(by)
    group = [f"_g{i}" for i in range(len(by))]
    number = present(F.col(quoted(value))) + F.lit(0.0)
    plain = rows.select(*[F.col(quoted(c)) for c in by], number.alias("_value")).filter(F.col("_value").isNotNull())
    keyed = with_ordered_bits(plain, "_value", "_key")
    size = F.col("n") if "n" in ranks.columns else F.lit(2**62)
    rank = F.col("rank").cast("bigint")
    named = [F.col(quoted(c)).alias(g) for c, g in zip(by, group)]
    wanted = materialize(ranks.select(*named, rank.alias("rank"), F.lit(0).cast("bigint").alias("_prefix"), rank.alias("_place"), size.cast("bigint").alias("_n")).distinct())
    small = F.broadcast if wanted.count() <= BROADCAST_RANKS else (lambda df: df)
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"p{g}")) for g in group]) & (F.col("_prefix") == F.col("p_prefix"))

    def asked(left: int) -> DataFrame:
        """The rows whose number begins like a wanted one, with their group and prefix."""
        here = _same(by, "_g") if left == 64 else _same(by, "_g") & (F.shiftright("_key", left) == F.col("_prefix"))
        return keyed.join(small(wanted.select(*group, "_prefix").distinct()), here).select(
            *[F.col(g).alias(f"p{g}") for g in group], F.col("_prefix").alias("p_prefix"), "_key", "_value"
        )

    settled, left = [], 64
    while left and wanted.filter(F.col("_n") > FEW).limit(1).count():
        counts = asked(left).groupBy(*[f"p{g}" for g in group], "p_prefix", F.shiftright("_key", left - STEP_BITS).alias("_next")).agg(
            F.count(F.lit(1)).alias("_count"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
        )
        # At most 65,536 rows per group and prefix.
        before = Window.partitionBy(*[f"p{g}" for g in group], "p_prefix").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0)))
        inside = (F.col("_before") <= F.col("_place")) & (F.col("_place") < F.col("_before") + F.col("_count"))
        found = materialize(
            placed.join(small(wanted), same & inside).select(
                *group, "rank", F.col("_next").alias("_prefix"), (F.col("_place") - F.col("_before")).alias("_place"), F.col("_count").alias("_n"), "_low", "_high"
            )
        )
        # A prefix of equal values needs no more passes.
        settled.append(found.filter("_low = _high").select(*group, "rank", F.col("_low").alias("_value")))
        wanted = found.filter("_low <> _high").drop("_low", "_high")
        left -= STEP_BITS
    # Few rows share a prefix now; after all passes none is left, as equal numbers have equal values.
    order = Window.partitionBy(*[f"p{g}" for g in group], "p_prefix").orderBy("_value")
    last = asked(left).withColumn("_at", F.row_number().over(order) - 1)
    settled.append(last.join(small(wanted), same & (F.col("_at") == F.col("_place"))).select(*group, "rank", "_value"))
    every = reduce(DataFrame.unionByName, settled)
    return every.select(*[F.col(g).alias(c) for g, c in zip(group, by)], "rank", F.col("_value").alias(value))


def quantiles(rows: DataFrame, value: str, shares: Sequence[float], sizes: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., p25, ...): linearly interpolated quantiles of the non-missing values.

    ``sizes`` is a stored table of ``by`` and the number ``n`` of its values.
    """
    by = list(by)
    sizes = sizes.select(*by, "n").filter("n > 0")
    targets = [F.lit(float(s)) * (F.col("n") - 1) for s in shares]
    ranks = sizes.select(*by, "n", F.explode(F.array_distinct(F.array(*[f(t) for t in targets for f in (F.floor, F.ceil)]))).alias("rank"))
    found = select_ranks(rows, value, ranks, by)
    of = sizes.select(*[F.col(quoted(c)).alias(f"_g{i}") for i, c in enumerate(by)], "n")
    joined = found.join(of, _same(by, "_g"))

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col(quoted(value))))

    columns = []
    for share, target in zip(shares, targets):
        low, high, part = at(F.floor(target)), at(F.ceil(target)), F.max(target - F.floor(target))
        # No difference is taken between equal values, which may be infinite.
        columns.append(F.when(low == high, low).otherwise(low + (high - low) * part).alias(quantile_name(share)))
    return joined.groupBy(*by).agg(*columns)
