"""Per-user features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.functions.numeric import ENGAGEMENT_WEIGHTS, safe_ratio, weighted_score
from usertide.functions.time import whole_days_between
from usertide.operators.checks import cast_key_like, fill_by_type
from usertide.schema import require_columns

# The event types of the contract.
EVENT_TYPES = ("play", "pause", "next", "open", "exit")
# Fixed value: recency of users without events.
NO_EVENTS_RECENCY = 9999
# The profile columns kept beside the features, and the ratios built from event counts.
PROFILE = ("user_id", "signup_date", "last_active_date", "country", "device", "language", "subscription_type")
RATIOS = (("ev_play", "ev_open"), ("ev_pause", "ev_play"), ("ev_next", "ev_play"))


def event_summary(events: DataFrame) -> DataFrame:
    """(user_id, event_count, last_event, unique_event_types) of the events that have a user."""
    return events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("event_uuid").alias("event_count"),
        F.max("event_timestamp").alias("last_event"),
        F.count_distinct("event_type").alias("unique_event_types"),
    )


def user_features(users: DataFrame, events: DataFrame, newest: Column | None = None) -> DataFrame:
    """All user columns plus event_count, recency_days and unique_event_types.

    Recency counts whole days back from the latest event of anyone, or from ``newest``; users without events get 9999.
    """
    require_columns(events, ["event_uuid", "user_id", "event_type", "event_timestamp"], "events")
    summary = event_summary(events)
    newest = _newest_event(summary, events) if newest is None else newest
    measured = summary.select(
        "user_id",
        "event_count",
        whole_days_between(F.col("last_event"), newest).alias("recency_days"),
        "unique_event_types",
    )
    return users.join(measured, "user_id", "left").na.fill(
        {"event_count": 0, "recency_days": NO_EVENTS_RECENCY, "unique_event_types": 0}
    )


def _newest_event(summary: DataFrame, events: DataFrame) -> Column:
    """The time of the latest event of anyone, from the summary of the events."""
    # Taking the maximum over the whole summary row lets Spark answer it from the shuffle the summary
    # has already written, instead of reading the events again.  Events of nobody are looked up apart:
    # Parquet skips the row groups without a null user.
    of_users = summary.select(
        F.max(F.struct("last_event", "event_count", "unique_event_types", "user_id"))["last_event"]
    ).scalar()
    of_nobody = events.filter(F.col("user_id").isNull()).select(F.max("event_timestamp")).scalar()
    return F.greatest(of_users, of_nobody)


def event_types_of(events: DataFrame) -> list[str]:
    """The event types that occur, sorted.  They become column names; ``event_counts_long`` needs none."""
    return sorted(r[0] for r in events.select("event_type").filter("event_type is not null").distinct().collect())


def event_counts_long(events: DataFrame) -> DataFrame:
    """(user_id, event_type, n): the counts as rows, for any number of types."""
    known = events.filter(F.col("user_id").isNotNull() & F.col("event_type").isNotNull())
    return known.groupBy("user_id", "event_type").agg(F.count("event_uuid").alias("n"))


def activity(events: DataFrame, event_types: Sequence[str] | None = None) -> DataFrame:
    """Per user: ev_<type> counts, active_days and, when sessions are known, sessions and their mean size.

    One grouping serves all of them.  The mean session size is the events inside sessions over the
    number of sessions, so no second grouping by session is needed.  The types that
    occur are looked up unless ``event_types`` names them.  Events without a type column give one count, ev_count.
    """
    if "event_type" in events.columns:
        types = event_types_of(events) if event_types is None else list(event_types)
        measures = [
            F.count(F.when(F.col("event_type") == t, F.col("event_uuid"))).alias(f"ev_{t}") for t in types
        ]
    else:
        measures = [F.count(F.lit(1)).alias("ev_count")]
    measures.append(F.count_distinct(F.to_date("event_timestamp")).alias("active_days"))
    if "session_id" in events.columns:
        sessions = F.count_distinct("session_id")
        measures += [
            sessions.alias("sessions"),
            F.try_divide(F.count("session_id").cast("double"), sessions.cast("double")).alias(
                "avg_events_per_session"
            ),
        ]
    return events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*measures)


def pivot_event_counts(events: DataFrame, event_types: Sequence[str] | None = None) -> DataFrame:
    """One row per user and one ev_<type> column per type that occurs or is named, absent = 0."""
    event_types = event_types_of(events) if event_types is None else event_types
    counts = (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .pivot("event_type", list(event_types))
        .agg(F.count("event_uuid"))
    )
    return counts.select(
        "user_id", *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).alias(f"ev_{t}") for t in event_types]
    )


def session_sizes(events: DataFrame) -> DataFrame:
    """Per user: sessions and the mean number of events in one."""
    per_session = (
        events.filter(F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", "session_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_session.groupBy("user_id").agg(
        F.count("session_id").alias("sessions"), F.avg("n").alias("avg_events_per_session")
    )


def add_ratios(df: DataFrame, pairs: Sequence[tuple[str, str]] = RATIOS) -> DataFrame:
    """ratio_<a>_<b> for each pair whose columns both exist."""
    here = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    return df.withColumns({f"ratio_{a}_{b}": safe_ratio(F.col(a), F.col(b)) for a, b in here}) if here else df


def add_engagement(df: DataFrame, weights: Mapping[str, float] = ENGAGEMENT_WEIGHTS) -> DataFrame:
    here = {c: w for c, w in weights.items() if c in df.columns}
    return df.withColumn("engagement_score", weighted_score(here)) if here else df


def behaviour_features(
    users: DataFrame,
    events: DataFrame,
    weights: Mapping[str, float] = ENGAGEMENT_WEIGHTS,
    event_types: Sequence[str] | None = None,
) -> DataFrame:
    """User profile with activity, ratios and the engagement score; remaining nulls are filled by type.

    Profile columns that ``users`` lacks are left out.
    """
    require_columns(users, ["user_id"], "users")
    measured = activity(cast_key_like(events, users, "user_id"), event_types)
    joined = users.select(*[c for c in PROFILE if c in users.columns]).join(measured, "user_id", "left")
    return fill_by_type(add_engagement(add_ratios(joined), weights))


def weekly_activity(events: DataFrame) -> DataFrame:
    """Per user and week: events, active days, and whole weeks back from the user's latest week."""
    weekly = (
        events.filter(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("user_id", F.to_date(F.date_trunc("week", "event_timestamp")).alias("week"))
        .agg(
            F.count("event_uuid").alias("events"),
            F.count_distinct(F.to_date("event_timestamp")).alias("active_days"),
        )
    )
    # A user has at most one row per calendar week here, so the window stays small for everyone.
    latest = F.max("week").over(Window.partitionBy("user_id"))
    return weekly.withColumn("weeks_before_latest", (F.datediff(latest, F.col("week")) / 7).cast("int"))
