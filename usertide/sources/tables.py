"""CSV and Parquet tables, JSON reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.functions.time import parse_utc

# Keeps microseconds, which the default CSV format cuts to milliseconds.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, date_formats: tuple[str, ...] = ()
) -> DataFrame:
    """CSV with a header.  Types come from ``schema`` by column name, nothing is inferred.

    Columns of ``schema`` may be absent and extra columns stay text.  A value that does not fit its
    type becomes null; timestamps are read leniently as UTC.
    """
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    wanted = {f.name: f.dataType for f in schema.fields}

    def typed(name: str):
        column, kind = F.col(f"`{name}`"), wanted.get(name, T.StringType())
        if isinstance(kind, T.StringType):
            return column
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            return parse_utc(column, date_formats).alias(name)
        return column.try_cast(kind).alias(name)

    return raw.select(*[typed(c) for c in raw.columns])


def read_labels(spark: SparkSession, path: str, name: str = "label") -> DataFrame:
    """The first column of a headed CSV as integers."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col(f"`{raw.columns[0]}`").cast("double").cast("int").alias(name))


def write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", TIMESTAMP_TEXT).option("timestampFormat", TIMESTAMP_TEXT).csv(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and return the written table, so later steps read the result instead of redoing it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report table as JSON lines in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("metric string, value bigint").json(path)


def cleaned_to(
    clean: Callable[..., tuple[DataFrame, DataFrame]], raw: DataFrame, base: str, name: str
) -> DataFrame:
    """Run a cleaning job into ``<base>/<name>`` with its report in ``<base>/<name>_qa``; returns the written table."""
    written, report = clean(raw, store=lambda df: write_table(df, f"{base}/{name}"))
    write_report(report, f"{base}/{name}_qa")
    return written
