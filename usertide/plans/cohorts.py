"""Monthly cohort retention, early-retention metrics and the churn label."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.functions.numeric import percent_text
from usertide.functions.time import midnight, month_key, month_start
from usertide.operators.activity import activity_bitmaps, months_by_group
from usertide.schema import require_columns
from usertide.session import materialize


def cohort_sizes(users: DataFrame) -> DataFrame:
    """(cohort, cohort_size): distinct users by month of signup, the month as a date."""
    cohort = month_start(F.col("signup_date")).alias("cohort")
    return (
        users.select("user_id", cohort)
        .filter(F.col("cohort").isNotNull())
        .groupBy("cohort")
        .agg(F.count_distinct("user_id").alias("cohort_size"))
    )


def retention_cohorts(users: DataFrame, events: DataFrame) -> DataFrame:
    """Active users and retention rate per (cohort month, activity month) that has activity.

    Events are cut to distinct (user, month) pairs first, so the join moves no raw events and no user
    is heavier than the number of months.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    require_columns(events, ["user_id", "event_timestamp"], "events")
    months = (
        events.select("user_id", month_start(F.col("event_timestamp")).alias("month"))
        .filter(F.col("user_id").isNotNull() & F.col("month").isNotNull())
        .distinct()
    )
    cohorts = users.select("user_id", month_start(F.col("signup_date")).alias("cohort")).filter(
        F.col("cohort").isNotNull()
    )
    # A user has one row per cohort and month, so counting rows counts users.
    active = months.join(cohorts.distinct(), "user_id").groupBy("cohort", "month").agg(F.count(F.lit(1)).alias("active_users"))
    # One row per calendar month of signup.
    return active.join(F.broadcast(cohort_sizes(users)), "cohort").select(
        month_key(F.col("cohort")).alias("cohort_month"),
        month_key(F.col("month")).alias("event_month"),
        "active_users",
        "cohort_size",
        (F.col("active_users") / F.col("cohort_size")).alias("retention_rate"),
    )


def retention_from_bitmaps(users: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """:func:`retention_cohorts` from stored activity bitmaps, without the events.

    One row per user meets the users, and what is shuffled after that is a row per cohort and task.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    cohorts = users.select("user_id", month_start(F.col("signup_date")).alias("cohort")).filter(F.col("cohort").isNotNull())
    active = months_by_group(materialize(bitmaps.join(cohorts.distinct(), "user_id")), ["cohort"])
    # One row per calendar month of signup.
    return active.join(F.broadcast(cohort_sizes(users)), "cohort").select(
        month_key(F.col("cohort")).alias("cohort_month"),
        month_key(F.col("month")).alias("event_month"),
        F.col("active").alias("active_users"),
        "cohort_size",
        (F.col("active") / F.col("cohort_size")).alias("retention_rate"),
    )


def retention_by_bitmaps(users: DataFrame, events: DataFrame) -> DataFrame:
    """:func:`retention_cohorts` with a row per user, not per user and month, before the join."""
    require_columns(events, ["user_id", "event_timestamp"], "events")
    return retention_from_bitmaps(users, activity_bitmaps(events))


def _at_midnight(signup: Column) -> Column:
    """The signup timestamp; the query fails if it carries a time of day."""
    fine = signup.isNull() | (signup == midnight(signup))
    problem = F.lit("signup_date must be at midnight; clean the users first or leave exact_signup_time on")
    return F.when(fine, signup).otherwise(F.raise_error(problem).cast("timestamp_ntz"))


def early_activity(
    users: DataFrame,
    events: DataFrame,
    days: Sequence[int] = (7, 30),
    min_day: int | None = None,
    exact_signup_time: bool = True,
) -> DataFrame:
    """One row per user: user_id, signup_date and events_D<n>, the events up to day n after signup.

    Day n ends where the n+1-th full day after signup ends.  There is no lower bound unless
    ``min_day`` sets one, so activity before signup counts.  Users must be unique, as cleaned users are.

    Events are cut to one row per user and calendar day before the join, so a user with very many
    events weighs no more than the days of the period.  The days on which a bound falls are counted from
    the events themselves; ``exact_signup_time=False`` saves that where all signups are at midnight, as
    cleaned users have them, and fails otherwise.
    """
    dated = events.select(
        "user_id", F.col("event_timestamp").cast("timestamp_ntz").alias("at"), F.to_date("event_timestamp").alias("day")
    ).filter(F.col("user_id").isNotNull() & F.col("day").isNotNull())
    daily = dated.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    signups = users.select("user_id", "signup_date", F.col("signup_date").cast("timestamp_ntz").alias("signup"))
    names = {f"events_D{d}": d + 1 for d in days}

    if not exact_signup_time:
        checked = signups.withColumn("signup", _at_midnight(F.col("signup")))
        since = F.datediff(F.col("day"), F.to_date("signup"))
        wanted = F.lit(True) if min_day is None else since >= min_day
        totals = [_total(wanted & (since < end), F.col("n")).alias(name) for name, end in names.items()]
        return checked.join(daily, "user_id", "left").groupBy("user_id", "signup_date").agg(*totals)

    def bound(k: int) -> Column:
        return F.col("signup") + F.make_dt_interval(days=F.lit(k))

    # A calendar day counts whole when no bound falls inside it.
    bounds = [bound(k) for k in names.values()] + ([] if min_day is None else [bound(min_day)])
    split_day = reduce(or_, [(F.to_date(b) == F.col("day")) & (b != midnight(b)) for b in bounds])
    # The left join also brings the users without events, with no time and so outside every bound.
    whole = (
        signups.join(daily, "user_id", "left")
        .withColumn("_whole", ~F.coalesce(split_day, F.lit(False)))
        .withColumn("at", F.when(F.col("_whole"), F.col("day").cast("timestamp_ntz")))
        .select(*signups.columns, "at", "n")
    )
    split = (
        signups.withColumn("day", F.explode(F.array_distinct(F.array(*[F.to_date(b) for b in bounds]))))
        .filter(split_day)
        .join(dated, ["user_id", "day"])
        .select(*signups.columns, "at", F.lit(1).cast("bigint").alias("n"))
    )
    lower = F.lit(True) if min_day is None else F.col("at") >= bound(min_day)
    totals = [_total(lower & (F.col("at") < bound(end)), F.col("n")).alias(name) for name, end in names.items()]
    return whole.unionByName(split).groupBy("user_id", "signup_date").agg(*totals)


def _total(condition: Column, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))


def user_retention_metrics(
    users: DataFrame,
    events: DataFrame,
    min_day: int | None = None,
    observed_only: bool = False,
    exact_signup_time: bool = True,
) -> DataFrame:
    """Per user: signup, cohort, churn_30d (1 = no activity by day 30), events_D7 and events_D30.

    ``min_day=0`` ignores activity before signup.  ``observed_only`` leaves out users whose first 30
    days are not covered by the span of the events, for whom the label says nothing.
    """
    require_columns(users, ["user_id", "signup_date"], "users")
    counted = early_activity(users, events, (7, 30), min_day, exact_signup_time)
    if observed_only:
        span = events.select(F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi"))
        counted = counted.filter(
            (F.col("signup_date") >= F.to_date(span.select("lo").scalar()))
            & (F.date_add(F.to_date("signup_date"), 30) <= F.to_date(span.select("hi").scalar()))
        )
    return counted.select(
        "user_id",
        "signup_date",
        month_key(F.col("signup_date")).alias("cohort_month"),
        F.when(F.col("events_D30") > 0, 0).otherwise(1).alias("churn_30d"),
        "events_D7",
        "events_D30",
    )


def retention_matrix(cohorts: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Cohorts as rows, activity months as columns, rates as values, 0 where there is no activity.

    Without ``months`` the activity months present are looked up (one row per calendar month).
    """
    if months is None:
        months = sorted(r[0] for r in cohorts.select("event_month").distinct().collect())
    wide = cohorts.groupBy("cohort_month").pivot("event_month", list(months)).agg(F.first("retention_rate"))
    return wide.na.fill(0.0).orderBy("cohort_month")


def retention_matrix_long(cohorts: DataFrame) -> DataFrame:
    """(cohort_month, event_month, rate): every cell of :func:`retention_matrix`, the empty ones as 0."""
    wide = retention_matrix(cohorts)
    months = [c for c in wide.columns if c != "cohort_month"]
    return wide.unpivot("cohort_month", [f"`{m}`" for m in months], "event_month", "rate")


def global_retention_rates(metrics: DataFrame) -> DataFrame:
    """One row: users and the shares retained by day 7 and day 30 and churned."""
    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    return metrics.agg(
        F.count(F.lit(1)).alias("users"),
        share(F.col("events_D7") > 0).alias("d7_rate"),
        share(F.col("events_D30") > 0).alias("d30_rate"),
        F.avg(F.col("churn_30d").cast("double")).alias("churn_rate"),
    )


def retention_summary(metrics: DataFrame, analysed_at: str) -> DataFrame:
    """The global rates as percent text, with the time of analysis as given."""
    rates = global_retention_rates(metrics)
    return rates.select(
        "users",
        *[percent_text(F.col(c)).alias(c) for c in ("d7_rate", "d30_rate", "churn_rate")],
        F.lit(analysed_at).alias("analysed_at"),
    )
