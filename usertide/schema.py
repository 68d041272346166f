"""Table schemas and plan-time column checks.  Nothing here starts a Spark job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("signup_date", T.TimestampNTZType()),
        T.StructField("last_active_date", T.TimestampNTZType()),
        T.StructField("country", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("subscription_type", T.StringType()),
        T.StructField("credits_purchased", T.LongType()),
        T.StructField("credits_spent", T.LongType()),
        T.StructField("episodes_completed", T.LongType()),
        T.StructField("views", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("avg_watch_time_sec", T.DoubleType()),
        T.StructField("sessions_7d", T.DoubleType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_uuid", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("received_at", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("app_version", T.StringType()),
    ]
)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str], table: str = "table") -> DataFrame:
    """Return ``df`` untouched, or raise before any work starts."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{table} lacks required columns: {', '.join(missing)}")
    return df


def quoted(name: str) -> str:
    """A column name as one identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def available_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """The candidates that exist in ``df``, in candidate order; raises when none does."""
    found = [name for name in candidates if name in df.columns]
    if not found:
        raise ValueError(f"none of the columns {', '.join(candidates)} exists")
    return found


def first_column_like(df: DataFrame, fragment: str) -> str | None:
    """The first column whose lower-case name contains ``fragment``."""
    return next((name for name in df.columns if fragment in name.lower()), None)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
