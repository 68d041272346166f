"""Active months as bitmaps: a row per user, whatever the number of events and months.

Months count from January 1970.  Sixty-four of them share a word, and a user's bitmap is the words from the first to the last
that anyone uses (a word spans five years and four months).  Bitmaps are built with ``bit_or``, which Spark combines per task, so a
user with a third of all events sends as much as any other; bitmaps of two loads are merged the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


def month_ordinal(at: Column) -> Column:
    """Months since January 1970; negative before."""
    day = F.to_date(at)
    return ((F.year(day) - 1970) * 12 + F.month(day) - 1).cast("int")


def ordinal_month(ordinal: Column) -> Column:
    """The first day of a month as a date."""
    return F.make_date(F.floor(ordinal / 12).cast("int") + 1970, F.pmod(ordinal, F.lit(12)).cast("int") + 1, F.lit(1))


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """Bitmaps from rows ``key, word, bits``."""
    # Two numbers; a calendar has few words.
    span = rows.agg(F.min("word").alias("lo"), F.max("word").alias("hi")).first()
    words = [] if span["lo"] is None else list(range(span["lo"], span["hi"] + 1))
    merged = [F.bit_or(F.when(F.col("word") == w, F.col("bits"))).alias(f"w{i}") for i, w in enumerate(words)]
    if not merged:
        return rows.select(key, F.lit(0).alias("first_word"), F.array().cast("array<bigint>").alias("months"))
    filled = F.array(*[F.coalesce(F.col(f"w{i}"), F.lit(0).cast("bigint")) for i in range(len(words))])
    return rows.groupBy(key).agg(*merged).select(key, F.lit(words[0]).alias("first_word"), filled.alias("months"))


def activity_bitmaps(events: DataFrame, key: str = "user_id", at: str = "event_timestamp") -> DataFrame:
    """(key, first_word, months): the months in which a user has events, as bits of 64-bit words.

    Rows without a user or a time don't count.  No rows give none.
    """
    month = month_ordinal(F.col(at))
    known = events.select(key, month.alias("month")).filter(F.col(key).isNotNull() & F.col("month").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("month", F.lit(WORD)).cast("int"))
    return _packed(known.select(key, F.floor(F.col("month") / WORD).cast("int").alias("word"), bit.alias("bits")), key)


def merge_bitmaps(*tables: DataFrame, key: str = "user_id") -> DataFrame:
    """The bitmaps of several loads as one; loads may span different years and hold the same users."""
    every = reduce(DataFrame.unionByName, tables)
    return _packed(every.select(key, "first_word", F.posexplode("months")).select(key, (F.col("first_word") + F.col("pos")).alias("word"), F.col("col").alias("bits")), key)


def active_months(bitmaps: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, n_months, first_month, last_month) of each bitmap."""
    count = F.aggregate(F.transform("months", F.bit_count), F.lit(0), lambda total, n: total + n)
    start = F.col("first_word") * WORD
    # Months of the set bits, some hundred at most.
    ordinals = F.flatten(F.transform("months", lambda w, i: F.filter(F.transform(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.when(F.getbit(w, b) == 1, start + i * WORD + b)), lambda o: o.isNotNull())))
    return bitmaps.select(key, count.cast("bigint").alias("n_months"), ordinals.alias("o")).select(
        key, "n_months", ordinal_month(F.array_min("o")).alias("first_month"), ordinal_month(F.array_max("o")).alias("last_month")
    )


def months_by_group(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """(groups..., month, active): how many rows of each group have a month's bit.

    One aggregate with a sum per month between the first and the last in use; a task sends a row per group.
    """
    shape = bitmaps.agg(F.max("first_word").alias("first"), F.max(F.size("months")).alias("n")).first()
    if not shape["n"] or shape["n"] < 1:
        return bitmaps.select(*groups, F.current_date().alias("month"), F.lit(0).cast("bigint").alias("active")).limit(0)
    used = bitmaps.agg(*[F.bit_or(F.get("months", F.lit(i))).alias(f"w{i}") for i in range(shape["n"])]).first()
    places = [(i, b) for i in range(shape["n"]) for b in range(WORD) if (used[f"w{i}"] or 0) >> b & 1]
    sums = [F.sum(F.getbit(F.get("months", F.lit(i)), F.lit(b)).cast("bigint")).alias(f"m{i}_{b}") for i, b in places]
    counted = bitmaps.groupBy(*groups).agg(*sums)
    entries = [F.struct(ordinal_month(F.lit((shape["first"] + i) * WORD + b)).alias("month"), F.col(f"m{i}_{b}").alias("active")) for i, b in places]
    return counted.select(*groups, F.inline(F.array(*entries))).filter("active > 0")

