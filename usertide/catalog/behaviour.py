"""Queries for features, cohorts and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from usertide.catalog.registry import query, rounded
from usertide.operators import activity
from usertide.operators.checks import align_columns, cast_key_like, fill_by_type
from usertide.operators.stats import value_counts, value_shares
from usertide.plans import buckets, cohorts, features
from usertide.session import materialize

FEATURE_COLUMNS = """user_id, signup_date, last_active_date, country, device, language, subscription_type,
  credits_purchased, credits_spent, views, round(avg_watch_time_sec, 6) AS avg_watch_time_sec, sessions_7d,
  event_count, recency_days, unique_event_types"""

COUNTS_BY_TYPE = ", ".join(
    f"count(event_uuid) FILTER (event_type = '{t}') AS ev_{t}" for t in features.EVENT_TYPES
)

BEHAVIOUR = f"""
SELECT user_id, signup_date, last_active_date, country, device, language, subscription_type,
  ev_play, ev_pause, ev_next, ev_open, ev_exit, active_days, sessions,
  round(coalesce(avg_events_per_session, 0), 6) AS avg_events_per_session,
  round(CASE WHEN ev_open > 0 THEN ev_play / ev_open ELSE 0 END, 6) AS ratio_ev_play_ev_open,
  round(CASE WHEN ev_play > 0 THEN ev_pause / ev_play ELSE 0 END, 6) AS ratio_ev_pause_ev_play,
  round(CASE WHEN ev_play > 0 THEN ev_next / ev_play ELSE 0 END, 6) AS ratio_ev_next_ev_play,
  round(1.0::DOUBLE * ev_play + 0.5::DOUBLE * ev_pause + 1.2::DOUBLE * ev_next + 3.0::DOUBLE * active_days
    + 2.0::DOUBLE * sessions, 6) AS engagement_score
FROM (
  SELECT u.user_id, signup_date, last_active_date, country, device, language, subscription_type,
    {", ".join(f"coalesce(ev_{t}, 0) AS ev_{t}" for t in features.EVENT_TYPES)},
    coalesce(active_days, 0) AS active_days, coalesce(sessions, 0) AS sessions, avg_events_per_session
  FROM app_users u
  LEFT JOIN (SELECT user_id, {COUNTS_BY_TYPE}, count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days
             FROM app_events GROUP BY user_id) e ON u.user_id = e.user_id
  LEFT JOIN (SELECT user_id, count(*) AS sessions, avg(n) AS avg_events_per_session
             FROM (SELECT user_id, session_id, count(*) AS n FROM app_events WHERE session_id IS NOT NULL GROUP BY 1, 2)
             GROUP BY user_id) s ON u.user_id = s.user_id)
"""


@query("user_features", f"SELECT {FEATURE_COLUMNS} FROM features", ("features",))
def _(v):
    return rounded(v.features())


@query("order_user_features", """
SELECT u.user_id, u.signup_date, count(event_uuid) AS event_count,
  CAST(floor((epoch_us((SELECT max(event_timestamp) FROM order_events)) - epoch_us(max(event_timestamp)))
    / 86400000000.0) AS BIGINT) AS recency_days,
  count(DISTINCT event_type) AS unique_event_types
FROM order_users u JOIN order_events e ON u.user_id = e.user_id GROUP BY u.user_id, u.signup_date
""", ("order_users", "order_events"))
def _(v):
    return features.user_features(v.order_users(), v.order_events())


@query("behaviour_features", BEHAVIOUR, ("app_users", "app_events"))
def _(v):
    return rounded(features.behaviour_features(v.users(), v.events()))


@query("bucketed_user_features", f"SELECT {FEATURE_COLUMNS} FROM features", ("features",))
def _(v):
    return rounded(buckets.user_features(buckets.store_buckets(v.users(), v.events())))


@query("bucketed_behaviour_features", BEHAVIOUR, ("app_users", "app_events"))
def _(v):
    return rounded(buckets.behaviour_features(buckets.store_buckets(v.users(), v.events())))


@query("bucketed_retention_metrics", """
SELECT user_id, signup_date, cohort_month, churn_30d, events_D7, events_D30 FROM metrics
""", ("metrics",))
def _(v):
    return buckets.user_retention_metrics(buckets.store_buckets(v.users(), v.events()))


@query("pivot_event_counts", f"SELECT user_id, {COUNTS_BY_TYPE} FROM app_events GROUP BY user_id", ("app_events",))
def _(v):
    return features.pivot_event_counts(v.events())


@query("session_sizes", """
SELECT user_id, count(*) AS sessions, round(avg(n), 6) AS avg_events_per_session
FROM (SELECT user_id, session_id, count(*) AS n FROM app_events WHERE session_id IS NOT NULL GROUP BY 1, 2)
GROUP BY user_id
""", ("app_events",))
def _(v):
    return rounded(features.session_sizes(v.events()))


@query("safe_ratios", f"""
SELECT user_id, round(CASE WHEN ev_open > 0 THEN ev_play / ev_open ELSE 0 END, 6) AS ratio_ev_play_ev_open,
  round(CASE WHEN ev_play > 0 THEN ev_pause / ev_play ELSE 0 END, 6) AS ratio_ev_pause_ev_play,
  round(CASE WHEN ev_play > 0 THEN ev_next / ev_play ELSE 0 END, 6) AS ratio_ev_next_ev_play
FROM (SELECT user_id, {COUNTS_BY_TYPE} FROM app_events GROUP BY user_id)
""", ("app_events",))
def _(v):
    ratios = [f"ratio_{a}_{b}" for a, b in features.RATIOS]
    return rounded(features.add_ratios(features.pivot_event_counts(v.events())).select("user_id", *ratios))


@query("engagement_score", f"""
SELECT user_id, round(1.0::DOUBLE * ev_play + 0.5::DOUBLE * ev_pause + 1.2::DOUBLE * ev_next
  + 3.0::DOUBLE * active_days + 2.0::DOUBLE * sessions, 6) AS engagement_score
FROM (SELECT user_id, {COUNTS_BY_TYPE}, count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days,
        count(DISTINCT session_id) AS sessions FROM app_events GROUP BY user_id)
""", ("app_events",))
def _(v):
    return rounded(features.add_engagement(features.activity(v.events())).select("user_id", "engagement_score"))


@query("fill_by_type", """
SELECT coalesce(user_id, 0) AS user_id, coalesce(event_uuid, 'unknown') AS event_uuid, event_timestamp FROM raw_events
""", ("raw_events",))
def _(v):
    return fill_by_type(v.raw_events().select("user_id", "event_uuid", "event_timestamp"))


@query("align_columns", """
SELECT credits_spent, user_id, 0 AS likes, views FROM app_users
""", ("app_users",))
def _(v):
    return align_columns(v.users(), ["credits_spent", "user_id", "likes", "views"])


@query("cast_key_like", """
SELECT TRY_CAST(event_uuid AS BIGINT) AS user_id, event_type FROM raw_events
""", ("raw_events",))
def _(v):
    keyed = v.raw_events().select(F.col("event_uuid").alias("user_id"), "event_type")
    return cast_key_like(keyed, v.users(), "user_id")


@query("weekly_activity", """
SELECT user_id, week, events, active_days,
  CAST((max(week) OVER (PARTITION BY user_id) - week) // 7 AS INTEGER) AS weeks_before_latest
FROM (SELECT user_id, CAST(date_trunc('week', event_timestamp) AS DATE) AS week, count(event_uuid) AS events,
        count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days
      FROM app_events GROUP BY 1, 2)
""", ("app_events",))
def _(v):
    return features.weekly_activity(v.events())


COHORT_COLUMNS = "cohort_month, event_month, active_users, cohort_size, round(retention_rate, 6) AS retention_rate"


@query("retention_cohorts", f"SELECT {COHORT_COLUMNS} FROM cohorts", ("cohorts",))
def _(v):
    return rounded(cohorts.retention_cohorts(v.users(), v.events()))


@query("order_retention_cohorts", """
SELECT cohort_month, event_month, active_users, cohort_size, round(active_users / cohort_size, 6) AS retention_rate
FROM (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, strftime(event_timestamp, '%Y-%m') AS event_month,
        count(DISTINCT e.user_id) AS active_users
      FROM order_events e JOIN order_users u ON e.user_id = u.user_id GROUP BY 1, 2) a
JOIN (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, count(DISTINCT user_id) AS cohort_size
      FROM order_users GROUP BY 1) s USING (cohort_month)
""", ("order_users", "order_events"))
def _(v):
    return rounded(cohorts.retention_cohorts(v.order_users(), v.order_events()))


@query("cohort_sizes", """
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort, count(DISTINCT user_id) AS cohort_size
FROM app_users GROUP BY 1
""", ("app_users",))
def _(v):
    return cohorts.cohort_sizes(v.users())


@query("cohort_count", "SELECT count(DISTINCT cohort_month) AS cohorts FROM cohorts", ("cohorts",))
def _(v):
    table = cohorts.retention_cohorts(v.users(), v.events())
    return table.agg(F.count_distinct("cohort_month").alias("cohorts"))


@query("user_retention_metrics", """
SELECT user_id, signup_date, cohort_month, churn_30d, events_D7, events_D30 FROM metrics
""", ("metrics",))
def _(v):
    return v.metrics()


@query("order_retention_metrics", """
SELECT u.user_id, u.signup_date, strftime(u.signup_date, '%Y-%m') AS cohort_month,
  CASE WHEN count(d.days) FILTER (d.days <= 30) > 0 THEN 0 ELSE 1 END AS churn_30d,
  count(d.days) FILTER (d.days <= 7) AS events_D7, count(d.days) FILTER (d.days <= 30) AS events_D30
FROM order_users u JOIN (
  SELECT u.user_id, CAST(floor((epoch_us(event_timestamp) - epoch_us(signup_date)) / 86400000000.0) AS BIGINT) AS days
  FROM order_events e JOIN order_users u ON u.user_id = e.user_id) d ON u.user_id = d.user_id
GROUP BY u.user_id, u.signup_date
""", ("order_users", "order_events"))
def _(v):
    return cohorts.user_retention_metrics(v.order_users(), v.order_events())


@query("retention_metrics_from_signup", """
SELECT u.user_id, u.signup_date, strftime(u.signup_date, '%Y-%m') AS cohort_month,
  CASE WHEN count(d.days) FILTER (d.days BETWEEN 0 AND 30) > 0 THEN 0 ELSE 1 END AS churn_30d,
  count(d.days) FILTER (d.days BETWEEN 0 AND 7) AS events_D7,
  count(d.days) FILTER (d.days BETWEEN 0 AND 30) AS events_D30
FROM app_users u LEFT JOIN dated d ON u.user_id = d.user_id
WHERE u.signup_date >= (SELECT date_trunc('day', min(event_timestamp)) FROM app_events)
  AND u.signup_date + INTERVAL 30 DAY <= (SELECT max(event_timestamp) FROM app_events)
GROUP BY u.user_id, u.signup_date
""", ("app_users", "app_events", "dated"))
def _(v):
    return cohorts.user_retention_metrics(v.users(), v.events(), min_day=0, observed_only=True)


@query("retention_metrics_exact_time", """
SELECT u.user_id, u.signup_date, strftime(u.signup_date, '%Y-%m') AS cohort_month,
  CASE WHEN count(d.days) FILTER (d.days <= 30) > 0 THEN 0 ELSE 1 END AS churn_30d,
  count(d.days) FILTER (d.days <= 7) AS events_D7, count(d.days) FILTER (d.days <= 30) AS events_D30
FROM (SELECT user_id, signup_date + to_seconds(user_id * 977 % 86400) AS signup_date FROM app_users) u
LEFT JOIN (
  SELECT e.user_id, CAST(floor((epoch_us(event_timestamp) - epoch_us(signup_date + to_seconds(e.user_id * 977 % 86400)))
    / 86400000000.0) AS BIGINT) AS days
  FROM app_events e JOIN app_users u ON u.user_id = e.user_id) d ON u.user_id = d.user_id
GROUP BY u.user_id, u.signup_date
""", ("app_users", "app_events"))
def _(v):
    offset = F.make_dt_interval(secs=(F.col("user_id") * 977 % 86400).cast("decimal(18,6)"))
    users = v.users().withColumn("signup_date", F.col("signup_date") + offset)
    return cohorts.user_retention_metrics(users, v.events())


@query("event_counts_long", """
SELECT user_id, event_type, count(event_uuid) AS n FROM app_events WHERE user_id IS NOT NULL AND event_type IS NOT NULL
GROUP BY user_id, event_type
""", ("app_events",))
def _(v):
    return features.event_counts_long(v.events())


def _matrix(cohorts_view: str) -> str:
    """Every cohort against every activity month there is."""
    return f"""
SELECT c.cohort_month, e.event_month, round(coalesce(retention_rate, 0), 6) AS rate
FROM (SELECT DISTINCT cohort_month FROM {cohorts_view}) c CROSS JOIN (SELECT DISTINCT event_month FROM {cohorts_view}) e
LEFT JOIN {cohorts_view} r ON r.cohort_month = c.cohort_month AND r.event_month = e.event_month
"""


@query("retention_matrix", _matrix("cohorts"), ("cohorts",))
def _(v):
    return rounded(cohorts.retention_matrix_long(cohorts.retention_cohorts(v.users(), v.events())))


ORDER_COHORTS = """
SELECT cohort_month, event_month, active_users, cohort_size, active_users / cohort_size AS retention_rate
FROM (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, strftime(event_timestamp, '%Y-%m') AS event_month,
        count(DISTINCT e.user_id) AS active_users FROM order_events e JOIN order_users u ON e.user_id = u.user_id GROUP BY 1, 2) a
JOIN (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, count(DISTINCT user_id) AS cohort_size FROM order_users GROUP BY 1) s
  USING (cohort_month)
"""


@query("order_retention_matrix", f"SELECT * FROM (WITH order_cohorts AS ({ORDER_COHORTS}) {_matrix('order_cohorts')})", ("order_users", "order_events"))
def _(v):
    """The matrix over all years of orders."""
    return rounded(cohorts.retention_matrix_long(materialize(cohorts.retention_cohorts(v.order_users(), v.order_events()))))


@query("retention_by_bitmaps", "SELECT cohort_month, event_month, active_users, cohort_size, round(retention_rate, 6) AS retention_rate FROM cohorts", ("cohorts",))
def _(v):
    return rounded(cohorts.retention_by_bitmaps(v.users(), v.events()))


@query("order_retention_by_bitmaps", f"SELECT * REPLACE (round(retention_rate, 6) AS retention_rate) FROM ({ORDER_COHORTS})", ("order_users", "order_events"))
def _(v):
    """Orders arrive in loads, one per priority; their stored bitmaps are merged, then counted."""
    orders = v.order_events()
    kinds = [r[0] for r in orders.select("event_type").distinct().collect()]  # five priorities
    loads = [materialize(activity.activity_bitmaps(orders.filter(F.col("event_type") == kind))) for kind in sorted(kinds)]
    return rounded(cohorts.retention_from_bitmaps(v.order_users(), activity.merge_bitmaps(*loads)))


@query("active_months", """
SELECT user_id, count(DISTINCT date_trunc('month', event_timestamp)) AS n_months, CAST(min(date_trunc('month', event_timestamp)) AS DATE) AS first_month,
  CAST(max(date_trunc('month', event_timestamp)) AS DATE) AS last_month FROM order_events GROUP BY user_id
""", ("order_events",))
def _(v):
    return activity.active_months(activity.activity_bitmaps(v.order_events()))


@query("global_retention_rates", """
SELECT count(*) AS users, round(avg(CASE WHEN events_D7 > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS d7_rate,
  round(avg(CASE WHEN events_D30 > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS d30_rate,
  round(avg(CAST(churn_30d AS DOUBLE)), 6) AS churn_rate
FROM metrics
""", ("metrics",))
def _(v):
    return rounded(cohorts.global_retention_rates(v.metrics()))


@query("retention_summary", """
SELECT count(*) AS users, printf('%.1f%%', 100 * avg(CASE WHEN events_D7 > 0 THEN 1.0::DOUBLE ELSE 0 END)) AS d7_rate,
  printf('%.1f%%', 100 * avg(CASE WHEN events_D30 > 0 THEN 1.0::DOUBLE ELSE 0 END)) AS d30_rate,
  printf('%.1f%%', 100 * avg(CAST(churn_30d AS DOUBLE))) AS churn_rate, '2024-02-01 00:00' AS analysed_at
FROM metrics
""", ("metrics",))
def _(v):
    return cohorts.retention_summary(v.metrics(), "2024-02-01 00:00")


@query("churn_value_counts", """
SELECT churn_30d, count(*) AS n FROM metrics GROUP BY churn_30d
""", ("metrics",))
def _(v):
    return value_counts(v.metrics(), "churn_30d")


@query("churn_value_shares", """
SELECT churn_30d, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM metrics), 2) AS pct
FROM metrics GROUP BY churn_30d
""", ("metrics",))
def _(v):
    return value_shares(v.metrics(), "churn_30d")


@query("distinct_active_users", "SELECT DISTINCT user_id FROM app_events", ("app_events",))
def _(v):
    return v.events().select("user_id").distinct()
