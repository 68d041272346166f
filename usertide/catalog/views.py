"""User, event and score views over the given tables, once for Spark and once as SQL.

Each view covers its whole base table.  Modulo terms only decide values (which rows get a null, a
second copy, an unknown user, ...), never whether a row is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.plans.cohorts import user_retention_metrics
from usertide.plans.features import user_features
from usertide.session import configure

START = "2023-11-15 00:00:00"

# The columns of the given tables that the views read.  Naming them saves a schema lookup.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


class Views:
    """Lazy views for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def users(self) -> DataFrame:
        """Customers as app users: three signup months, some with last activity before signup."""
        key = F.col("c_custkey")
        signup_day, active_day = key * 7 % 75, key * 7 % 75 + key * 11 % 60 - 5
        subscription = (
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "basic")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "premium")
            .otherwise("none")
        )
        # The nation table has one row per country.
        nations = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))
        return self.table("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("user_id"),
            _days_after_start(signup_day).alias("signup_date"),
            _days_after_start(active_day).alias("last_active_date"),
            F.col("n_name").alias("country"),
            F.when(key % 2 == 0, "Android").otherwise("iOS").alias("device"),
            F.when(key % 3 == 0, "es").when(key % 3 == 1, "en").otherwise("pt").alias("language"),
            subscription.alias("subscription_type"),
            (key * 13 % 50).alias("credits_purchased"),
            (key * 5 % 30).alias("credits_spent"),
            (key * 3 % 40).alias("views"),
            (F.abs("c_acctbal") / 10).alias("avg_watch_time_sec"),
            (key % 8).alias("sessions_7d"),
        )

    def events(self) -> DataFrame:
        """App events; about one in 89 belongs to a user that does not exist, one in ten has no session."""
        key, user, at = F.col("event_id"), F.col("user_id"), F.col("ts")
        kind = F.col("event_type")
        created = F.when(key % 41 == 0, -1).otherwise(key % 3)
        return self.table("events").select(
            key.cast("string").alias("event_uuid"),
            F.when(key % 89 == 3, -1 - user).otherwise(user).alias("user_id"),
            F.when(kind == "view", "play")
            .when(kind == "click", "pause")
            .when(kind == "purchase", "next")
            .when(kind == "signup", "open")
            .otherwise("exit")
            .alias("event_type"),
            at.alias("event_timestamp"),
            _seconds_after(at, created).alias("created_at"),
            _seconds_after(at, key % 3 + key * 7 % 4 - 1).alias("received_at"),
            F.when(key % 10 != 9, F.concat(user.cast("string"), F.lit("-"), F.date_format(at, "yyyyMMdd"))).alias(
                "session_id"
            ),
        )

    def raw_users(self) -> DataFrame:
        """Users as text with null ids, unreadable dates, the native label and second copies."""
        u, key = self.users(), F.col("user_id")
        copies = F.when(key % 50 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        first = F.col("copy") == 0
        active = F.col("last_active_date")
        return u.withColumn("copy", F.explode(copies)).select(
            F.when(~(first & (key % 101 == 5)), key).alias("user_id"),
            F.when(first & (key % 103 == 7), "not a date")
            .otherwise(F.col("signup_date").cast("string"))
            .alias("signup_date"),
            F.when(first, active).otherwise(active + F.expr("INTERVAL 1 DAY")).cast("string").alias("last_active_date"),
            "country",
            F.when(first, key % 2).otherwise(0).alias("churned_30d"),
        )

    def raw_events(self) -> DataFrame:
        """Events with null ids, null users and second copies one second later."""
        e = self.events().withColumn("event_id", F.col("event_uuid").cast("bigint"))
        key = F.col("event_id")
        copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        first = F.col("copy") == 0
        return e.withColumn("copy", F.explode(copies)).select(
            F.when(~(first & (key % 101 == 0)), F.col("event_uuid")).alias("event_uuid"),
            F.when(~(first & (key % 107 == 0)), F.col("user_id")).alias("user_id"),
            "event_type",
            _seconds_after(F.col("event_timestamp"), F.col("copy")).alias("event_timestamp"),
            "created_at",
            "received_at",
        )

    def order_events(self) -> DataFrame:
        """Orders as events: another domain with a span of years."""
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("event_uuid"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("event_type"),
            F.col("o_orderdate").alias("event_timestamp"),
        )

    def order_users(self) -> DataFrame:
        """Customers with their first order as signup."""
        return self.table("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
            F.min("o_orderdate").alias("signup_date")
        )

    def scored(self) -> DataFrame:
        """A binary label and an informative score with many ties, one row per order."""
        label = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
        lift = F.when(F.col("o_orderstatus") == "F", 0.15).otherwise(0.0)
        return self.table("orders").select(
            F.col("o_orderkey").alias("row_id"),
            F.col("o_custkey").alias("user_id"),
            label.alias("label"),
            F.round(F.col("o_totalprice") / 1000000 + lift, 3).alias("score"),
        )

    def features(self) -> DataFrame:
        return user_features(self.users(), self.events())

    def metrics(self) -> DataFrame:
        return user_retention_metrics(self.users(), self.events(), exact_signup_time=False)


def _days_after_start(days: Column) -> Column:
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(days=days.cast("int"))


def _seconds_after(at: Column, seconds: Column) -> Column:
    return at + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


# The same views in SQL.  Each may use the ones it lists.
_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "app_users": ((), f"""
        SELECT c_custkey AS user_id,
          TIMESTAMP '{START}' + to_days(CAST(c_custkey * 7 % 75 AS INT)) AS signup_date,
          TIMESTAMP '{START}' + to_days(CAST(c_custkey * 7 % 75 + c_custkey * 11 % 60 - 5 AS INT)) AS last_active_date,
          n_name AS country,
          CASE WHEN c_custkey % 2 = 0 THEN 'Android' ELSE 'iOS' END AS device,
          CASE c_custkey % 3 WHEN 0 THEN 'es' WHEN 1 THEN 'en' ELSE 'pt' END AS language,
          CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'basic'
               WHEN c_mktsegment = 'HOUSEHOLD' THEN 'premium' ELSE 'none' END AS subscription_type,
          c_custkey * 13 % 50 AS credits_purchased, c_custkey * 5 % 30 AS credits_spent,
          c_custkey * 3 % 40 AS views, abs(c_acctbal) / 10 AS avg_watch_time_sec, c_custkey % 8 AS sessions_7d
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "app_events": ((), """
        SELECT CAST(event_id AS VARCHAR) AS event_uuid,
          CASE WHEN event_id % 89 = 3 THEN -1 - user_id ELSE user_id END AS user_id,
          CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'pause' WHEN 'purchase' THEN 'next'
               WHEN 'signup' THEN 'open' ELSE 'exit' END AS event_type,
          ts AS event_timestamp,
          ts + to_seconds(CASE WHEN event_id % 41 = 0 THEN -1 ELSE event_id % 3 END) AS created_at,
          ts + to_seconds(event_id % 3 + event_id * 7 % 4 - 1) AS received_at,
          CASE WHEN event_id % 10 <> 9
               THEN CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') END AS session_id
        FROM events"""),
    "raw_users": (("app_users",), """
        SELECT CASE WHEN copy = 0 AND user_id % 101 = 5 THEN NULL ELSE user_id END AS user_id,
          CASE WHEN copy = 0 AND user_id % 103 = 7 THEN 'not a date' ELSE CAST(signup_date AS VARCHAR) END
            AS signup_date,
          CAST(last_active_date + to_days(copy) AS VARCHAR) AS last_active_date, country,
          CASE WHEN copy = 0 THEN user_id % 2 ELSE 0 END AS churned_30d
        FROM (SELECT *, unnest(CASE WHEN user_id % 50 = 1 THEN [0, 1] ELSE [0] END) AS copy FROM app_users)"""),
    "raw_events": (("app_events",), """
        SELECT CASE WHEN copy = 0 AND event_id % 101 = 0 THEN NULL ELSE event_uuid END AS event_uuid,
          CASE WHEN copy = 0 AND event_id % 107 = 0 THEN NULL ELSE user_id END AS user_id,
          event_type, event_timestamp + to_seconds(copy) AS event_timestamp, created_at, received_at
        FROM (SELECT *, unnest(CASE WHEN event_id % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy
              FROM (SELECT *, CAST(event_uuid AS BIGINT) AS event_id FROM app_events))"""),
    "order_events": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS event_uuid, o_custkey AS user_id, o_orderpriority AS event_type,
          o_orderdate AS event_timestamp
        FROM orders"""),
    "order_users": ((), "SELECT o_custkey AS user_id, min(o_orderdate) AS signup_date FROM orders GROUP BY o_custkey"),
    "scored": ((), """
        SELECT o_orderkey AS row_id, o_custkey AS user_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
          round(o_totalprice / 1000000 + CASE WHEN o_orderstatus = 'F' THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END, 3)
            AS score
        FROM orders"""),
    "features": (("app_users", "app_events"), """
        SELECT u.*, coalesce(f.event_count, 0) AS event_count, coalesce(f.recency_days, 9999) AS recency_days,
          coalesce(f.unique_event_types, 0) AS unique_event_types
        FROM app_users u LEFT JOIN (
          SELECT user_id, count(event_uuid) AS event_count, count(DISTINCT event_type) AS unique_event_types,
            CAST(floor((epoch_us((SELECT max(event_timestamp) FROM app_events)) - epoch_us(max(event_timestamp)))
              / 86400000000.0) AS BIGINT) AS recency_days
          FROM app_events GROUP BY user_id) f ON u.user_id = f.user_id"""),
    "dated": (("app_users", "app_events"), """
        SELECT u.user_id, CAST(floor((epoch_us(event_timestamp) - epoch_us(signup_date)) / 86400000000.0) AS BIGINT)
          AS days
        FROM app_events e JOIN app_users u ON u.user_id = e.user_id"""),
    "metrics": (("app_users", "dated"), """
        SELECT u.user_id, u.signup_date, strftime(u.signup_date, '%Y-%m') AS cohort_month,
          CASE WHEN count(d.days) FILTER (d.days <= 30) > 0 THEN 0 ELSE 1 END AS churn_30d,
          count(d.days) FILTER (d.days <= 7) AS events_D7, count(d.days) FILTER (d.days <= 30) AS events_D30
        FROM app_users u LEFT JOIN dated d ON u.user_id = d.user_id GROUP BY u.user_id, u.signup_date"""),
    "cohorts": (("app_users", "app_events"), """
        SELECT cohort_month, event_month, active_users, cohort_size, active_users / cohort_size AS retention_rate
        FROM (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, strftime(event_timestamp, '%Y-%m') AS event_month,
                count(DISTINCT e.user_id) AS active_users
              FROM app_events e JOIN app_users u ON e.user_id = u.user_id GROUP BY 1, 2) a
        JOIN (SELECT strftime(signup_date, '%Y-%m') AS cohort_month, count(DISTINCT user_id) AS cohort_size
              FROM app_users GROUP BY 1) s USING (cohort_month)"""),
}


def with_views(query: str, *names: str) -> str:
    """``query`` preceded by the views it names and the views those use."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for parent in _SQL[name][0]:
            visit(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({_SQL[n][1]})" for n in needed) + "\n" + query
