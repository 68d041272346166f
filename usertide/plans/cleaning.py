"""Cleaning of the raw user and event tables, each with a quality report (metric, value)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.functions.time import midnight, utc_column
from usertide.operators.checks import keep_earliest, keep_latest, null_count, swap_inverted, tidy
from usertide.schema import missing_columns

USER_KEYS = ("user_id", "signup_date", "last_active_date")
EVENT_KEYS = ("event_uuid", "user_id", "event_type", "event_timestamp")
EVENT_TIMES = ("event_timestamp", "received_at", "created_at")
# A label shipped with the raw users whose origin is unknown; keeping it would leak the target.
NATIVE_LABEL = "churned_30d"

Cleaned = tuple[DataFrame, DataFrame]
Store = Callable[[DataFrame], DataFrame]


def _missing_report(df: DataFrame, missing: list[str]) -> DataFrame:
    rows = [(f"missing_columns:{name}", 1) for name in missing]
    return df.sparkSession.createDataFrame(rows, "metric string, value bigint")


def parse_users(users: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Raw users without the native label and with both dates at UTC midnight."""
    return users.drop(NATIVE_LABEL).withColumns(
        {c: midnight(utc_column(users, c, formats)) for c in ("signup_date", "last_active_date")}
    )


def clean_users(users: DataFrame, formats: tuple[str, ...] = (), store: Store | None = None) -> Cleaned:
    """Clean users and their report.

    Inverted date pairs are exchanged, rows without a user id go, and of several rows of one user
    the most recently active stays.  When a key column is missing the input comes back untouched and
    the report names the column.

    ``store`` writes the clean table and returns the written one; the report then counts that
    instead of deduplicating once more.
    """
    missing = missing_columns(users, USER_KEYS)
    if missing:
        return users, _missing_report(users, missing)
    parsed = parse_users(users, formats)
    repaired = swap_inverted(parsed, "signup_date", "last_active_date").filter(F.col("user_id").isNotNull())
    clean = keep_latest(repaired, "user_id", "last_active_date")
    if store:
        clean = store(clean)
        kept = clean.agg(F.count("user_id")).scalar()
    else:
        kept = F.count_distinct("user_id")
    report = tidy(
        parsed.agg(
            *[null_count(c).alias(f"null_{c}") for c in USER_KEYS],
            F.count_if(F.col("signup_date") > F.col("last_active_date")).alias("temporal_inconsistencies"),
            null_count("user_id").alias("dropped_missing_user_id"),
            (F.count("user_id") - kept).alias("duplicates_removed"),
        )
    )
    return clean, report


def clean_events(events: DataFrame, formats: tuple[str, ...] = (), store: Store | None = None) -> Cleaned:
    """Clean events and their report; ``store`` as in :func:`clean_users`.

    Rows without an event id go, and of several rows of one event the earliest stays.  Rows without a
    user are counted but kept.  ``duplicates_removed`` includes the rows without an event id.
    """
    missing = missing_columns(events, EVENT_KEYS)
    if missing:
        return events, _missing_report(events, missing)
    times = [c for c in EVENT_TIMES if c in events.columns]
    parsed = events.withColumns({c: utc_column(events, c, formats) for c in times})
    clean = keep_earliest(parsed.filter(F.col("event_uuid").isNotNull()), "event_uuid", "event_timestamp")
    if store:
        clean = store(clean)
    raw_rows = events.agg(F.count(F.lit(1))).scalar()
    kept_checks = [(raw_rows - F.count(F.lit(1))).alias("duplicates_removed")]
    if "received_at" in times:
        kept_checks.append(F.count_if(F.col("received_at") < F.col("event_timestamp")).alias("received_before_event"))
    if "received_at" in times and "created_at" in times:
        kept_checks.append(F.count_if(F.col("created_at") > F.col("received_at")).alias("created_before_received"))
    nulls = parsed.agg(*[null_count(c).alias(f"null_{c}") for c in ("event_uuid", "user_id", "event_timestamp")])
    return clean, tidy(nulls).unionByName(tidy(clean.agg(*kept_checks)))


def swap_created_received(events: DataFrame) -> DataFrame:
    """Exchange the meaning of ``created_at`` and ``received_at`` in every row."""
    return events.withColumns({"created_at": F.col("received_at"), "received_at": F.col("created_at")})
