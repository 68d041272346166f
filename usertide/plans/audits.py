"""Quality, latency and relational audits, and the data contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.functions.time import seconds_between
from usertide.operators.checks import null_count, tidy
from usertide.operators.coverage import coverage_counts, events_per_user, known_users
from usertide.operators.stats import QUARTILES, describe, histogram
from usertide.schema import require_columns
from usertide.session import materialize

# Audited columns, delays and percentiles of the delays.
DOMAIN_COLUMNS = ("country", "device", "subscription_type", "event_type")
EVENT_TIMES = ("event_timestamp", "created_at", "received_at")
DELAYS = ("delay_event_created", "delay_created_received", "delay_event_received")
DELAY_SHARES = (0.01, 0.05, 0.5, 0.95, 0.99)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def domain_cardinality(users: DataFrame, events: DataFrame, columns: Sequence[str] = DOMAIN_COLUMNS) -> DataFrame:
    """Distinct non-null values per column, read from the users if they have it, else from the events."""
    in_users = [c for c in columns if c in users.columns]
    in_events = [c for c in columns if c not in users.columns and c in events.columns]
    counts = [
        tidy(table.select(*here).distinct().agg(*[F.count_distinct(c).alias(c) for c in here]))
        for table, here in ((users, in_users), (events, in_events))
        if here
    ]
    none = users.sparkSession.createDataFrame([], "metric string, value bigint")
    return _union([none, *counts]).select(F.col("metric").alias("column"), F.col("value").alias("distinct_values"))


def quality_audit(users: DataFrame, events: DataFrame) -> DataFrame:
    """Rows (position, metric, value): completeness, uniqueness, references, time order, cardinalities."""
    in_users = [c for c in DOMAIN_COLUMNS if c in users.columns]
    in_events = [c for c in DOMAIN_COLUMNS if c not in users.columns and c in events.columns]
    rows = F.count(F.lit(1))
    user_side = users.groupBy("user_id").agg(rows.alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("user_id").isNull(), F.col("n"))), F.lit(0)).alias("users_null_user_id"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("user_id")).alias("users_duplicate_user_id"),
    )
    ids = events.groupBy("event_uuid").agg(rows.alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("event_uuid").isNull(), F.col("n"))), F.lit(0)).alias("events_null_event_uuid"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("event_uuid")).alias("events_duplicate_event_uuid"),
    )
    # One pass gives all additive counts per user and category; users then tell known from unknown.
    flags = {}
    if set(EVENT_TIMES) <= set(events.columns):
        flags = {
            "events_created_before_event": F.col("created_at") < F.col("event_timestamp"),
            "events_received_before_created": F.col("received_at") < F.col("created_at"),
        }
    per_user = events.groupBy("user_id", *in_events).agg(rows.alias("n"), *[F.count_if(c).alias(name) for name, c in flags.items()])
    matched = per_user.join(known_users(users).withColumn("__known", F.lit(True)), "user_id", "left")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    sums = {
        "events_null_user_id": total(F.col("user_id").isNull()),
        "events_with_known_user": total(F.col("__known")),
        "events_orphan": total(F.col("__known").isNull()),
        **{name: F.coalesce(F.sum(name), F.lit(0)) for name in flags},
    }
    # A row per combination of categories, stored so that sums and distinct values come from one pass.
    by_category = materialize(matched.groupBy(*in_events).agg(*[c.alias(name) for name, c in sums.items()]))
    event_side = by_category.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums])
    distinct = domain_cardinality(users, by_category.select(*in_events) if in_events else events, [*in_users, *in_events])
    distinct = distinct.select(F.concat(F.lit("distinct_"), "column").alias("metric"), F.col("distinct_values").alias("value"))
    order = [
        "users_null_user_id", "events_null_event_uuid", "events_null_user_id",
        "users_duplicate_user_id", "events_duplicate_event_uuid",
        "events_with_known_user", "events_orphan",
        "events_created_before_event", "events_received_before_created",
        *[f"distinct_{c}" for c in DOMAIN_COLUMNS],
    ]
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric")).cast("int")
    return _union([tidy(user_side), tidy(ids), tidy(event_side), distinct]).select(
        position.alias("position"), "metric", "value"
    )


def event_delays(events: DataFrame) -> DataFrame:
    """Events with the three delays between the event, its creation and its receipt, in seconds."""
    require_columns(events, EVENT_TIMES, "events")
    event, created, received = (F.col(c) for c in EVENT_TIMES)
    return events.withColumns(
        {
            "delay_event_created": seconds_between(event, created),
            "delay_created_received": seconds_between(created, received),
            "delay_event_received": seconds_between(event, received),
        }
    )


def latency_summary(events: DataFrame) -> DataFrame:
    return describe(event_delays(events), DELAYS, DELAY_SHARES)


def latency_histogram(events: DataFrame, bins: int = 100) -> DataFrame:
    return histogram(event_delays(events), DELAYS, bins)


def relational_audit(users: DataFrame, events: DataFrame) -> DataFrame:
    """Rows (metric, value): totals, valid and orphan events, users with and without events."""
    total_users = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = coverage_counts(users, events)
    return tidy(
        counts.select(
            total_users.alias("total_users"),
            "total_events",
            "valid_events",
            "orphan_events",
            "active_users",
            (total_users - F.col("active_users")).alias("inactive_users"),
        )
    )


def events_per_user_summary(users: DataFrame, events: DataFrame) -> DataFrame:
    """Distribution of the number of events over the known users that have any."""
    per_user = events_per_user(events).join(known_users(users), "user_id", "left_semi")
    return describe(materialize(per_user.select("event_count")), ["event_count"], QUARTILES)


def contract_checks(
    users: DataFrame, events: DataFrame, first_year: int = 2020, last_year: int = 2025
) -> DataFrame:
    """Contract rules with their tolerances: rule, violations, total, rate, rate_limit, passed."""
    year = F.year("event_timestamp")
    user_side = users.agg(
        F.count(F.lit(1)).alias("users"),
        null_count("user_id").alias("user_id_present"),
        F.count_if(F.col("signup_date") > F.col("last_active_date")).alias("signup_before_last_active"),
    )
    event_side = events.agg(
        F.count(F.lit(1)).alias("events"),
        null_count("event_uuid").alias("event_uuid_present"),
        null_count("user_id").alias("event_user_id_present"),
        F.count_if(~year.between(first_year, last_year)).alias("event_time_in_range"),
        (F.count("event_uuid") - F.count_distinct("event_uuid")).alias("event_uuid_unique"),
    )
    references = coverage_counts(users, events).select(
        F.col("total_events").alias("events"), F.col("orphan_events").alias("event_user_exists")
    )
    # The contract's limits.  Zero means none allowed, the others are exclusive bounds.
    limits = {
        "user_id_present": 0.0, "event_uuid_present": 0.0, "event_user_id_present": 0.0,
        "signup_before_last_active": 0.001, "event_user_exists": 0.005,
        "event_time_in_range": 0.001, "event_uuid_unique": 0.0,
    }

    def rules(side: DataFrame, total: str) -> DataFrame:
        names = [c for c in side.columns if c != total]
        return side.unpivot([total], names, "rule", "violations").withColumnRenamed(total, "total")

    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("rule")]
    rate = F.coalesce(F.try_divide("violations", "total"), F.lit(0.0))
    return _union([rules(user_side, "users"), rules(event_side, "events"), rules(references, "events")]).select(
        "rule",
        "violations",
        "total",
        F.round(rate, 6).alias("rate"),
        limit.alias("rate_limit"),
        F.when(limit == 0, F.col("violations") == 0).otherwise(rate < limit).alias("passed"),
    )


def vocabulary_violations(df: DataFrame, vocabularies: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside their controlled vocabulary, nulls aside: column, found_value, n."""
    domain = df.sparkSession.createDataFrame(
        [(c, v) for c, allowed in vocabularies.items() for v in allowed], "column string, found_value string"
    )
    seen = (
        df.select(*[F.col(c).cast("string").alias(c) for c in vocabularies])
        .unpivot([], list(vocabularies), "column", "found_value")
        .filter(F.col("found_value").isNotNull())
        .groupBy("column", "found_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return seen.join(domain, ["column", "found_value"], "left_anti")
