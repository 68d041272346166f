"""Where queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.catalog.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a function of :class:`Views` under ``name``, with the SQL that must give the same rows."""

    def add(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Views(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql.strip(), *views)
        return build

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double: sums of doubles depend on the order of addition."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
