"""Business figures: usage, revenue, sessions, credits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.functions.time import seconds_between
from usertide.operators.checks import tidy
from usertide.operators.ranking import ordered_counts, quantile_columns


def usage_kpis(users: DataFrame, events: DataFrame) -> DataFrame:
    """Rows (metric, value): plays per session, next rate, ARPU, ARPPU and premium share.

    Revenue is the credits purchased; ARPPU divides by users with any.  The next rate is the share of
    active users who moved on to a next episode.
    """
    by_user = (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("event_type") == "play").alias("plays"),
            F.count_if(F.col("event_type") == "next").alias("nexts"),
            F.count_distinct("session_id").alias("sessions"),
        )
    )
    activity = by_user.agg(
        F.try_divide(F.sum("plays").cast("double"), F.sum("sessions").cast("double")).alias("plays_per_session"),
        F.avg((F.col("nexts") > 0).cast("double")).alias("next_rate"),
    )
    credits, paying = F.sum("credits_purchased").cast("double"), F.count_if(F.col("credits_purchased") > 0)
    revenue = users.agg(
        F.try_divide(credits, F.count(F.lit(1)).cast("double")).alias("arpu"),
        F.try_divide(credits, paying.cast("double")).alias("arppu"),
        F.avg((F.col("subscription_type") == "premium").cast("double")).alias("premium_share"),
    )
    return tidy(activity).unionByName(tidy(revenue))


def sessions(events: DataFrame) -> DataFrame:
    """Per user and session: duration in seconds and whether it holds an exit event."""
    return (
        events.filter(F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", "session_id")
        .agg(
            seconds_between(F.min("event_timestamp"), F.max("event_timestamp")).alias("duration"),
            F.max((F.col("event_type") == "exit").cast("int")).alias("has_exit"),
        )
    )


def session_summary(events: DataFrame) -> DataFrame:
    """One row: number of sessions, mean and 95th percentile duration, share with an exit event."""
    measures = {"n": F.count(F.lit(1)), "s": F.sum("duration"), "exits": F.sum("has_exit")}
    counted = ordered_counts(sessions(events), "duration", measures)
    total = F.max("n_total")
    return counted.agg(
        total.alias("sessions"),
        (F.max("s_total") / total).alias("mean_duration"),
        quantile_columns("duration", [0.95])["p95"].alias("p95_duration"),
        (F.max("exits_total") / total).alias("exit_rate"),
    )


def retention_by_credits(users: DataFrame, metrics: DataFrame, credits: int = 20) -> DataFrame:
    """One row: 30-day retention above and up to ``credits`` purchased, and the ratio of the two."""
    joined = users.select("user_id", "credits_purchased").join(metrics.select("user_id", "events_D30"), "user_id")
    kept = (F.col("events_D30") > 0).cast("double")
    above = F.avg(F.when(F.col("credits_purchased") > credits, kept))
    rest = F.avg(F.when(F.col("credits_purchased") <= credits, kept))
    return joined.agg(
        above.alias("retention_above"), rest.alias("retention_rest"), F.try_divide(above, rest).alias("ratio")
    )
