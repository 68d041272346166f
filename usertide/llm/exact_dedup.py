"""Exact duplicates by two passes of Bloom filters; DataFrame functions only.

A pass hashes every row to one bit of a filter of 64-bit words.  A word of the filter is the ``bit_or`` of its
rows' bits; where more rows than set bits were counted, some bit was set twice, so one of the word's rows may
be a copy.  Rows of all other words cannot be.  The second pass asks the same of the rows that are left, with
another hash and a sparser filter.  Only the rows that fail both passes are shuffled, by the hash of their
text; every other row goes straight through, whatever its columns hold.  A filter never misses a copy: equal
texts have equal hashes and set the same bit.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.session import materialize

BITS = 64
#: Rows per filter word in the first and second pass.
LOADS = (2.0, 0.125)
#: Filter words (16 bytes each) that are broadcast at most; a larger filter is joined without a hint.
BROADCAST_WORDS = 4_000_000
#: Groups with at least this share of the rows to shuffle are hot; there are at most ``1 / HOT_SHARE``, so they are broadcast.
HOT_SHARE = 0.001
OWN = "__dedup_"


def normalised(text: Column) -> Column:
    """The text with one space for each run of white space (space, tab to carriage return); null counts as empty.

    Single spaces stay as they are, so the pattern looks only for runs that change.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def fingerprint(docs: DataFrame, *, text_col: str = "text", sha_col: str = "text_sha256") -> DataFrame:
    """``docs`` with the SHA-256 of the normalised text, in lower-case hexadecimal; ``sha_col`` replaces a column of that name."""
    return docs.withColumn(sha_col, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))


def filter_words(rows: int, load: float) -> int:
    """The size of a filter in words, a power of two."""
    return 1 << max(0, (max(1, round(rows / load)) - 1).bit_length())


def places(key: str, words: int, seed: int) -> tuple[Column, Column]:
    """The filter word of a key, and its bit in that word."""
    h = F.xxhash64(key, F.lit(seed))
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)), F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(BITS - 1)).cast("int"))


def repeated_words(rows: DataFrame, key: str, words: int, seed: int) -> DataFrame:
    """The filter words in which some bit was set twice: column ``__dedup_word<seed>``."""
    word, bit = places(key, words, seed)
    filled = rows.select(word.alias(f"{OWN}word{seed}"), bit.alias("bit")).groupBy(f"{OWN}word{seed}").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
    return materialize(filled.where(F.col("n") > F.bit_count("bits")).select(f"{OWN}word{seed}"))


def sized(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_WORDS else small


def exact_duplicates(rows: DataFrame, *, id_col: str = "doc_id", key_col: str = "text_sha256") -> DataFrame:
    """All rows and columns of ``rows`` with ``keep_id``, ``group_size`` and ``kept``.

    Rows with equal ``key_col`` form a group (null is a value like any other).  The row with the smallest id stays,
    rows without an id last; of rows that share the smallest id one stays, chosen by a hash of all its columns.
    ``keep_id`` is the id of the row that stays, ``group_size`` the number of rows, ``kept`` whether this is
    the row that stays.  Columns of those names are replaced; no rows give none.  A group may hold any share of
    the rows: counts and minima are combined before the shuffle, and the largest groups are broadcast to their rows.
    """
    own = ("keep_id", "group_size", "kept")
    columns = [c for c in rows.columns if c not in own]
    quoted = [F.col(f"`{c}`") for c in columns]
    stored = materialize(rows.select(*quoted, F.coalesce(F.col(key_col).cast("string"), F.lit("null")).alias(f"{OWN}key"), F.monotonically_increasing_id().alias(f"{OWN}row")))
    order = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.xxhash64(*quoted).alias("hash"), F.col(f"{OWN}row").alias("row"))
    suspects = stored.select(f"{OWN}key", order.alias("order"))
    tested = stored
    for seed, load in enumerate(LOADS):
        words = filter_words(suspects.count(), load)
        found = repeated_words(suspects, f"{OWN}key", words, seed)
        small = sized(found, found.count())
        place = places(f"{OWN}key", words, seed)[0]
        suspects = materialize(suspects.withColumn(f"{OWN}word{seed}", place).join(small, f"{OWN}word{seed}", "left_semi").drop(f"{OWN}word{seed}"))
        tested = tested.withColumn(f"{OWN}word{seed}", place).join(small.withColumn(f"{OWN}hit{seed}", F.lit(True)), f"{OWN}word{seed}", "left")
    possible = reduce(and_, [F.col(f"{OWN}hit{seed}").isNotNull() for seed in range(len(LOADS))])

    grouped = suspects.groupBy(f"{OWN}key").agg(F.count(F.lit(1)).alias(f"{OWN}n"), F.min("order").alias(f"{OWN}first"))
    groups = materialize(grouped.where(F.col(f"{OWN}n") > 1))
    least_hot = max(2, int(suspects.count() * HOT_SHARE))
    hot, rest = groups.where(F.col(f"{OWN}n") >= least_hot), groups.where(F.col(f"{OWN}n") < least_hot)

    first, n = F.col(f"{OWN}first"), F.col(f"{OWN}n")
    decided = [
        F.when(n.isNull(), F.col(id_col)).otherwise(first["id"]).alias("keep_id"),
        F.coalesce(n, F.lit(1)).cast("long").alias("group_size"),
        (n.isNull() | (first["row"] == F.col(f"{OWN}row"))).alias("kept"),
    ]
    single = [F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")]
    straight = tested.where(~possible).select(*quoted, *single)
    doubtful = tested.where(possible).join(F.broadcast(hot), f"{OWN}key", "left")
    in_hot = doubtful.where(n.isNotNull()).select(*quoted, *decided)
    others = doubtful.where(n.isNull()).drop(f"{OWN}n", f"{OWN}first").join(rest, f"{OWN}key", "left").select(*quoted, *decided)
    return straight.unionByName(in_hot).unionByName(others)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``exact_duplicates`` of whole texts, equal up to the length and kind of white space: adds ``text_sha256`` too.

    Null and empty texts are equal.
    """
    return exact_duplicates(fingerprint(docs, text_col=text_col), id_col=id_col)
