"""Queries for sources, cleaning and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from usertide.catalog.registry import query, rounded
from usertide.functions.time import midnight, parse_utc, whole_days_between
from usertide.operators import checks, coverage
from usertide.operators.stats import describe
from usertide.plans import audits, cleaning

RAW_USERS = """
SELECT user_id, CAST(date_trunc('day', TRY_CAST(signup_date AS TIMESTAMP)) AS TIMESTAMP) AS signup_date,
  CAST(date_trunc('day', TRY_CAST(last_active_date AS TIMESTAMP)) AS TIMESTAMP) AS last_active_date, country
FROM raw_users
"""

SWAPPED = """
SELECT user_id, country,
  CASE WHEN signup_date > last_active_date THEN last_active_date ELSE signup_date END AS signup_date,
  CASE WHEN signup_date > last_active_date THEN signup_date ELSE last_active_date END AS last_active_date
"""


@query("parse_timestamps", RAW_USERS, ("raw_users",))
def _(v):
    return cleaning.parse_users(v.raw_users())


@query("null_counts", """
SELECT 'null_user_id' AS metric, count(*) FILTER (user_id IS NULL) AS value FROM raw_users
UNION ALL SELECT 'null_signup_date', count(*) FILTER (signup_date IS NULL) FROM raw_users
UNION ALL SELECT 'null_last_active_date', count(*) FILTER (last_active_date IS NULL) FROM raw_users
UNION ALL SELECT 'null_country', count(*) FILTER (country IS NULL) FROM raw_users
UNION ALL SELECT 'null_churned_30d', count(*) FILTER (churned_30d IS NULL) FROM raw_users
""", ("raw_users",))
def _(v):
    return checks.null_counts(v.raw_users())


@query("drop_leakage_columns", "SELECT user_id, signup_date, last_active_date, country FROM raw_users", ("raw_users",))
def _(v):
    return v.raw_users().drop(cleaning.NATIVE_LABEL)


@query("swap_inverted_dates", SWAPPED + " FROM app_users", ("app_users",))
def _(v):
    users = v.users().select("user_id", "country", "signup_date", "last_active_date")
    return checks.swap_inverted(users, "signup_date", "last_active_date")


@query("duplicate_keys", """
SELECT user_id, count(*) AS row_count FROM raw_users GROUP BY user_id HAVING count(*) > 1
""", ("raw_users",))
def _(v):
    return checks.duplicate_keys(v.raw_users(), "user_id")


@query("dedup_latest", """
SELECT user_id, signup_date, last_active_date, country, churned_30d FROM raw_users WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY last_active_date DESC NULLS LAST, signup_date NULLS LAST, country NULLS LAST, churned_30d NULLS LAST) = 1
""", ("raw_users",))
def _(v):
    return checks.keep_latest(v.raw_users().filter("user_id is not null"), "user_id", "last_active_date")


@query("dedup_earliest", """
SELECT event_uuid, user_id, event_type, event_timestamp, created_at, received_at FROM raw_events
WHERE event_uuid IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_uuid ORDER BY event_timestamp ASC NULLS LAST, user_id NULLS LAST,
  event_type NULLS LAST, created_at NULLS LAST, received_at NULLS LAST) = 1
""", ("raw_events",))
def _(v):
    return checks.keep_earliest(v.raw_events().filter("event_uuid is not null"), "event_uuid", "event_timestamp")


@query("clean_users", f"""
SELECT user_id, signup_date, last_active_date, country FROM (
  {SWAPPED} FROM ({RAW_USERS}) p WHERE user_id IS NOT NULL) s
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY last_active_date DESC NULLS LAST, signup_date NULLS LAST, country NULLS LAST) = 1
""", ("raw_users",))
def _(v):
    return cleaning.clean_users(v.raw_users())[0]


@query("clean_users_report", f"""
WITH p AS ({RAW_USERS}), a AS (
  SELECT count(*) FILTER (user_id IS NULL) AS null_user_id,
    count(*) FILTER (signup_date IS NULL) AS null_signup_date,
    count(*) FILTER (last_active_date IS NULL) AS null_last_active_date,
    count(*) FILTER (signup_date > last_active_date) AS temporal_inconsistencies,
    count(*) FILTER (user_id IS NULL) AS dropped_missing_user_id,
    count(user_id) - count(DISTINCT user_id) AS duplicates_removed FROM p)
SELECT metric, value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME metric VALUE value)
""".replace("WITH p AS", "SELECT * FROM (WITH p AS") + ")", ("raw_users",))
def _(v):
    return cleaning.clean_users(v.raw_users())[1]


@query("clean_events", """
SELECT event_uuid, user_id, event_type, event_timestamp, created_at, received_at FROM raw_events
WHERE event_uuid IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY event_uuid ORDER BY event_timestamp, user_id NULLS LAST) = 1
""", ("raw_events",))
def _(v):
    return cleaning.clean_events(v.raw_events())[0]


@query("clean_events_report", """
SELECT * FROM (
WITH k AS (SELECT * FROM raw_events WHERE event_uuid IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY event_uuid ORDER BY event_timestamp, user_id NULLS LAST) = 1),
a AS (SELECT
    (SELECT count(*) FILTER (event_uuid IS NULL) FROM raw_events) AS null_event_uuid,
    (SELECT count(*) FILTER (user_id IS NULL) FROM raw_events) AS null_user_id,
    (SELECT count(*) FILTER (event_timestamp IS NULL) FROM raw_events) AS null_event_timestamp,
    (SELECT count(*) FROM raw_events) - count(*) AS duplicates_removed,
    count(*) FILTER (received_at < event_timestamp) AS received_before_event,
    count(*) FILTER (created_at > received_at) AS created_before_received FROM k)
SELECT metric, value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME metric VALUE value))
""", ("raw_events",))
def _(v):
    return cleaning.clean_events(v.raw_events())[1]


@query("swap_created_received", """
SELECT event_uuid, event_timestamp, received_at AS created_at, created_at AS received_at FROM app_events
""", ("app_events",))
def _(v):
    events = v.events().select("event_uuid", "event_timestamp", "created_at", "received_at")
    return cleaning.swap_created_received(events)


@query("domain_cardinality", """
SELECT 'country' AS "column", count(DISTINCT country) AS distinct_values FROM app_users
UNION ALL SELECT 'device', count(DISTINCT device) FROM app_users
UNION ALL SELECT 'subscription_type', count(DISTINCT subscription_type) FROM app_users
UNION ALL SELECT 'event_type', (SELECT count(DISTINCT event_type) FROM app_events)
""", ("app_users", "app_events"))
def _(v):
    return audits.domain_cardinality(v.users(), v.events())


@query("quality_audit", """
SELECT CAST(position AS INTEGER) AS position, metric, value FROM (
SELECT 1 AS position, 'users_null_user_id' AS metric, count(*) FILTER (user_id IS NULL) AS value FROM app_users
UNION ALL SELECT 2, 'events_null_event_uuid', count(*) FILTER (event_uuid IS NULL) FROM raw_events
UNION ALL SELECT 3, 'events_null_user_id', count(*) FILTER (user_id IS NULL) FROM raw_events
UNION ALL SELECT 4, 'users_duplicate_user_id', count(*) - count(DISTINCT user_id) FROM app_users
UNION ALL SELECT 5, 'events_duplicate_event_uuid', count(*) - count(DISTINCT event_uuid) FROM raw_events
UNION ALL SELECT 6, 'events_with_known_user', count(*) FROM raw_events WHERE user_id IN (SELECT user_id FROM app_users)
UNION ALL SELECT 7, 'events_orphan', count(*) FROM raw_events e
  WHERE NOT EXISTS (SELECT 1 FROM app_users u WHERE u.user_id = e.user_id)
UNION ALL SELECT 8, 'events_created_before_event', count(*) FILTER (created_at < event_timestamp) FROM raw_events
UNION ALL SELECT 9, 'events_received_before_created', count(*) FILTER (received_at < created_at) FROM raw_events
UNION ALL SELECT 10, 'distinct_country', count(DISTINCT country) FROM app_users
UNION ALL SELECT 11, 'distinct_device', count(DISTINCT device) FROM app_users
UNION ALL SELECT 12, 'distinct_subscription_type', count(DISTINCT subscription_type) FROM app_users
UNION ALL SELECT 13, 'distinct_event_type', count(DISTINCT event_type) FROM raw_events)
""", ("app_users", "raw_events"))
def _(v):
    return audits.quality_audit(v.users(), v.raw_events())


@query("valid_events", """
SELECT event_uuid, user_id FROM app_events WHERE user_id IN (SELECT user_id FROM app_users)
""", ("app_users", "app_events"))
def _(v):
    return coverage.valid_events(v.users(), v.events()).select("event_uuid", "user_id")


@query("orphan_events", """
SELECT event_uuid, user_id FROM raw_events e
WHERE NOT EXISTS (SELECT 1 FROM app_users u WHERE u.user_id = e.user_id)
""", ("app_users", "raw_events"))
def _(v):
    return coverage.orphan_events(v.users(), v.raw_events()).select("event_uuid", "user_id")


@query("premium_user_events", """
SELECT event_uuid, user_id FROM app_events WHERE user_id IN (SELECT user_id FROM app_users WHERE subscription_type = 'premium')
""", ("app_users", "app_events"))
def _(v):
    premium = v.users().filter("subscription_type = 'premium'")
    return coverage.valid_events(premium, v.events(), prefilter=True).select("event_uuid", "user_id")


@query("events_without_premium_user", """
SELECT event_uuid, user_id FROM raw_events e
WHERE NOT EXISTS (SELECT 1 FROM app_users u WHERE u.user_id = e.user_id AND u.subscription_type = 'premium')
""", ("app_users", "raw_events"))
def _(v):
    premium = v.users().filter("subscription_type = 'premium'")
    return coverage.orphan_events(premium, v.raw_events(), prefilter=True).select("event_uuid", "user_id")


@query("users_without_events", """
SELECT user_id, country FROM app_users u WHERE NOT EXISTS (SELECT 1 FROM app_events e WHERE u.user_id = e.user_id)
""", ("app_users", "app_events"))
def _(v):
    return coverage.users_without_events(v.users(), v.events()).select("user_id", "country")


@query("relational_audit", """
SELECT * FROM (
WITH c AS (SELECT * FROM app_events WHERE user_id IN (SELECT user_id FROM app_users)),
a AS (SELECT (SELECT count(*) FROM app_users) AS total_users, (SELECT count(*) FROM app_events) AS total_events,
  count(*) AS valid_events, (SELECT count(*) FROM app_events) - count(*) AS orphan_events,
  count(DISTINCT user_id) AS active_users,
  (SELECT count(*) FROM app_users) - count(DISTINCT user_id) AS inactive_users FROM c)
SELECT metric, value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME metric VALUE value))
""", ("app_users", "app_events"))
def _(v):
    return audits.relational_audit(v.users(), v.events())


@query("events_per_user", """
SELECT user_id, count(*) AS event_rows, count(event_uuid) AS event_count FROM raw_events GROUP BY user_id
""", ("raw_events",))
def _(v):
    return coverage.events_per_user(v.raw_events())


@query("events_per_user_summary", """
SELECT 'event_count' AS metric, count(*) AS n, round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS std,
  CAST(min(c) AS DOUBLE) AS min, round(quantile_cont(c, 0.25), 6) AS p25, round(quantile_cont(c, 0.5), 6) AS p50,
  round(quantile_cont(c, 0.75), 6) AS p75, CAST(max(c) AS DOUBLE) AS max
FROM (SELECT CAST(count(event_uuid) AS DOUBLE) AS c FROM app_events
      WHERE user_id IN (SELECT user_id FROM app_users) GROUP BY user_id)
""", ("app_users", "app_events"))
def _(v):
    return rounded(audits.events_per_user_summary(v.users(), v.events()))


DELAYS_SQL = """
SELECT event_uuid, (epoch_us(created_at) - epoch_us(event_timestamp)) / 1e6 AS delay_event_created,
  (epoch_us(received_at) - epoch_us(created_at)) / 1e6 AS delay_created_received,
  (epoch_us(received_at) - epoch_us(event_timestamp)) / 1e6 AS delay_event_received
FROM app_events
"""


@query("event_delays", DELAYS_SQL, ("app_events",))
def _(v):
    return audits.event_delays(v.events()).select("event_uuid", *audits.DELAYS)


LONG_DELAYS = f"SELECT name AS metric, value FROM (UNPIVOT ({DELAYS_SQL}) ON delay_event_created, delay_created_received, delay_event_received INTO NAME name VALUE value)"


@query("latency_summary", f"""
SELECT metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
  round(quantile_cont(value, 0.01), 6) AS p1, round(quantile_cont(value, 0.05), 6) AS p5,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS max
FROM ({LONG_DELAYS}) GROUP BY metric
""", ("app_events",))
def _(v):
    return rounded(audits.latency_summary(v.events()))


def _histogram_sql(rows: str, bins: int) -> str:
    return f"""
SELECT metric, bin, round(lower, 6) AS lower, round(upper, 6) AS upper, n FROM (
WITH r AS ({rows}),
lim AS (SELECT metric, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM r GROUP BY metric),
bins AS (SELECT metric, CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS lower,
    CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}) END AS upper
  FROM lim, range({bins}) g(i))
SELECT b.metric, b.bin, b.lower, b.upper, count(r.value) AS n
FROM bins b LEFT JOIN r ON r.metric = b.metric AND r.value >= b.lower
  AND (r.value < b.upper OR (b.bin = {bins - 1} AND r.value <= b.upper))
GROUP BY ALL)
"""


@query("latency_histogram", _histogram_sql(LONG_DELAYS, 100), ("app_events",))
def _(v):
    return rounded(audits.latency_histogram(v.events()))


@query("contract_checks", """
SELECT rule, violations, total, round(violations / total, 6) AS rate, rate_limit,
  CASE WHEN rate_limit = 0 THEN violations = 0 ELSE violations / total < rate_limit END AS passed
FROM (
SELECT 'user_id_present' AS rule, count(*) FILTER (user_id IS NULL) AS violations, count(*) AS total,
  0.0::DOUBLE AS rate_limit FROM app_users
UNION ALL SELECT 'signup_before_last_active', count(*) FILTER (signup_date > last_active_date), count(*), 0.001
  FROM app_users
UNION ALL SELECT 'event_uuid_present', count(*) FILTER (event_uuid IS NULL), count(*), 0.0 FROM raw_events
UNION ALL SELECT 'event_user_id_present', count(*) FILTER (user_id IS NULL), count(*), 0.0 FROM raw_events
UNION ALL SELECT 'event_time_in_range', count(*) FILTER (year(event_timestamp) NOT BETWEEN 2020 AND 2025), count(*),
  0.001 FROM raw_events
UNION ALL SELECT 'event_uuid_unique', count(event_uuid) - count(DISTINCT event_uuid), count(*), 0.0 FROM raw_events
UNION ALL SELECT 'event_user_exists',
  count(*) FILTER (user_id IS NULL OR user_id NOT IN (SELECT user_id FROM app_users)), count(*), 0.005 FROM raw_events)
""", ("app_users", "raw_events"))
def _(v):
    return audits.contract_checks(v.users(), v.raw_events())


@query("vocabulary_violations", """
SELECT 'subscription_type' AS "column", subscription_type AS found_value, count(*) AS n FROM app_users
WHERE subscription_type NOT IN ('free', 'premium', 'trial') GROUP BY 2
UNION ALL SELECT 'language', language, count(*) FROM app_users WHERE language NOT IN ('es', 'en') GROUP BY 2
""", ("app_users",))
def _(v):
    return audits.vocabulary_violations(
        v.users(), {"subscription_type": ["free", "premium", "trial"], "language": ["es", "en"]}
    )


@query("preview_users", "SELECT user_id, country, device FROM app_users ORDER BY user_id LIMIT 5", ("app_users",))
def _(v):
    return v.users().select("user_id", "country", "device").orderBy("user_id").limit(5)


@query("row_counts", """
SELECT 'users' AS metric, count(*) AS value FROM app_users UNION ALL SELECT 'events', count(*) FROM app_events
""", ("app_users", "app_events"))
def _(v):
    users, events = (t.agg(F.count(F.lit(1)).alias(n)) for t, n in ((v.users(), "users"), (v.events(), "events")))
    return checks.tidy(users).unionByName(checks.tidy(events))


@query("scalar_time_functions", """
SELECT event_uuid, CAST(event_timestamp AS DATE) AS event_date, strftime(event_timestamp, '%Y-%m') AS event_month,
  CAST(date_trunc('day', event_timestamp) AS TIMESTAMP) AS event_midnight,
  CAST(floor((epoch_us(event_timestamp) - epoch_us(TIMESTAMP '2024-01-10 12:00:00')) / 86400000000.0) AS BIGINT)
    AS days_since
FROM app_events
""", ("app_events",))
def _(v):
    at = F.col("event_timestamp")
    return v.events().select(
        "event_uuid",
        F.to_date(at).alias("event_date"),
        F.date_format(F.to_date(at), "yyyy-MM").alias("event_month"),
        midnight(at).alias("event_midnight"),
        whole_days_between(parse_utc(F.lit("2024-01-10T12:00:00Z")), at).alias("days_since"),
    )


@query("describe_order_totals", """
SELECT 'o_totalprice' AS metric, count(*) AS n, round(avg(o_totalprice), 3) AS mean,
  round(stddev_samp(o_totalprice), 3) AS std, round(min(o_totalprice), 3) AS min,
  round(quantile_cont(o_totalprice, 0.25), 3) AS p25, round(quantile_cont(o_totalprice, 0.5), 3) AS p50,
  round(quantile_cont(o_totalprice, 0.75), 3) AS p75, round(max(o_totalprice), 3) AS max
FROM orders
""")
def _(v):
    return rounded(describe(v.table("orders"), ["o_totalprice"]), 3)
