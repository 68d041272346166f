"""Bloom filters of keys: most rows whose key doesn't occur elsewhere are told apart without a shuffle.

A filter is a table of 64-bit words, sized by the counted keys.  A key sets a few bits of one word, so testing a row is
one look-up in a broadcast table.  The table is built with ``bit_or``, which Spark combines per task.  Rows that
pass still need an exact join; none that has a key fails.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.session import materialize

BITS_PER_KEY = 16
BITS_SET = 4
#: Words of a filter at most, 16 MB of bits for 8 million keys; more keys get no filter.
MOST_WORDS = 2_000_000


def _bits(key: Column) -> Column:
    """A word with the bits a key sets: a six-bit piece of its hash for each."""
    hashed = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.pmod(F.shiftright(hashed, 6 * i), F.lit(64)).cast("int")) for i in range(BITS_SET)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int] | None:
    """The stored filter (rows ``word, bits``) of the distinct non-null keys and its size in words; none for too many keys."""
    known = keys.filter(F.col(key).isNotNull())
    words = max(1, math.ceil(known.count() * BITS_PER_KEY / 64))
    if words > MOST_WORDS:
        return None
    word = F.pmod(F.xxhash64(F.col(key)), F.lit(words)).alias("word")
    return materialize(known.select(word, _bits(F.col(key)).alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))), words


def possible(rows: DataFrame, filtered: tuple[DataFrame, int], key: str, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false where the key certainly isn't in the filter, or is null."""
    table, words = filtered
    # At most MOST_WORDS rows.
    small = F.broadcast(table.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))
    joined = rows.join(small, F.pmod(F.xxhash64(F.col(key)), F.lit(words)) == F.col("__word"), "left")
    own = _bits(F.col(key))
    return joined.withColumn(flag, F.coalesce(F.col(key).isNotNull() & (F.col("__bits").bitwiseAND(own) == own), F.lit(False))).drop("__word", "__bits")
