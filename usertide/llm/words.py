"""Tokens of whole Arrow columns and bounded lists of the most frequent values."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The row and word number of every word of lower-cased texts, a maximal run of letters, and the words they number."""
    split = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
    row = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    # What stands before the first and after the last run of other characters may be empty.
    empty = pc.index(coded.dictionary, "").as_py()
    there = code != empty
    return row[there], code[there], coded.dictionary


def least_count(counts: DataFrame, n_col: str, most: int) -> int:
    """The smallest count such that at most ``most`` rows have as many; found from a histogram of counts.

    Counts fall into some hundred ranges, so nothing is sorted and a few numbers reach the driver.
    """
    steps = F.floor(F.log2(n_col) * 16)
    total, least = 0, 2**62
    for r in sorted(counts.where(F.col(n_col) > 0).groupBy(steps.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min(n_col).alias("low")).collect(), key=lambda r: -r["step"]):
        total += r["rows"]
        if total > most:
            return least
        least = math.ceil(r["low"])
    return least
