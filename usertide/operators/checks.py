"""Counting checks, key checks, deduplication and repairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tidy(one_row: DataFrame) -> DataFrame:
    """Turn a one-row aggregate into rows (metric, value)."""
    return one_row.unpivot([], one_row.columns, "metric", "value")


def null_count(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column in one pass, as rows (metric, value)."""
    return tidy(df.agg(*[null_count(c).alias(f"null_{c}") for c in columns or df.columns]))


def duplicate_count(name: str) -> Column:
    """Rows minus distinct non-null values."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(name))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Each key held by more than one row, with its row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def assert_unique(df: DataFrame, key: str, table: str = "table") -> DataFrame:
    """Raise when ``key`` repeats; stops at the first repeated key found."""
    if duplicate_keys(df, key).head(1):
        raise ValueError(f"{table} has repeated values of {key}")
    return df


def keep_one(
    df: DataFrame, key: str, order: Column, ties: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row per ``key`` in ``order``; remaining ties go by ``ties`` ascending.

    By default every other column that has an order takes part in the tie-break, so the outcome does not
    depend on file order.  The filter on ``row_number`` lets Spark trim each key to one row per input
    partition before the shuffle, so a key with very many copies stays cheap.
    """
    tie_columns = [c for c, kind in df.dtypes if c != key and "map<" not in kind and kind != "variant"] if ties is None else ties
    position = F.row_number().over(
        Window.partitionBy(key).orderBy(order, *[F.asc_nulls_last(c) for c in tie_columns])
    )
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def keep_latest(df: DataFrame, key: str, at: str, ties: Sequence[str] | None = None) -> DataFrame:
    return keep_one(df, key, F.desc_nulls_last(at), ties)


def keep_earliest(df: DataFrame, key: str, at: str, ties: Sequence[str] | None = None) -> DataFrame:
    return keep_one(df, key, F.asc_nulls_last(at), ties)


def swap_inverted(df: DataFrame, first: str, second: str) -> DataFrame:
    """Exchange the two columns where ``first > second``; rows with a null in either stay as they are."""
    inverted = F.col(first) > F.col(second)
    return df.withColumns(
        {
            first: F.when(inverted, F.col(second)).otherwise(F.col(first)),
            second: F.when(inverted, F.col(first)).otherwise(F.col(second)),
        }
    )


def fill_by_type(df: DataFrame, text: str = "unknown") -> DataFrame:
    """Numeric nulls become 0, text nulls become ``text``, other types stay."""
    return df.na.fill(0).na.fill(text)


def align_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Exactly ``wanted``, in that order: absent columns appear as 0, extra ones go."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in wanted])


def cast_key_like(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Give ``key`` the type it has in ``other``; values that do not convert become null."""
    target = other.schema[key].dataType
    if df.schema[key].dataType == target:
        return df
    return df.withColumn(key, F.col(key).try_cast(target))
