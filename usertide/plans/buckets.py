"""Users and events in buckets of users: jobs per user then join and group without a shuffle.

Both are written once as tables bucketed by user, and every later job reads its users' events where they are.  A user
with more than a task's share of the events would make a bucket of its own size; such users are stored apart in plain
tables, with the rows of nobody.  There a task's partial aggregates are what is shuffled, a few rows for each user.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.operators.checks import cast_key_like
from usertide.operators.coverage import heavy_users, known_users
from usertide.plans import cohorts, features
from usertide.session import materialize, new_folder


@dataclass(frozen=True)
class UserBuckets:
    """Bucketed users and events; heavy users' and nobody's in plain tables; the names of the bucketed tables."""

    users: DataFrame
    events: DataFrame
    heavy_users: DataFrame
    heavy_events: DataFrame
    names: tuple[str, str]

    def per_user(self, job: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """The rows of ``job(users, events)``, for a job each of whose rows depends on the rows of one user only."""
        return job(self.users, self.events).unionByName(job(self.heavy_users, self.heavy_events))

    def all_events(self) -> DataFrame:
        return self.events.unionByName(self.heavy_events)

    def forget(self) -> None:
        """Take the tables out of the catalog; their files go with ``session.scratch`` or ``drop_materialized``."""
        for name in self.names:
            self.users.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _bucketed(df: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """A new table of ``df`` with one file for each bucket, in the shared folder."""
    spark, name = df.sparkSession, f"usertide_{uuid.uuid4().hex}"
    # Rows are dealt by the hash that also makes the buckets, so a task writes one file.
    writer = df.repartition(buckets, "user_id").write.bucketBy(buckets, "user_id").sortBy("user_id")
    writer.option("path", new_folder(spark, "buckets")).format("parquet").saveAsTable(name)
    return spark.table(name), name


def store_buckets(users: DataFrame, events: DataFrame) -> UserBuckets:
    """Store users and events by user, in as many buckets as there are shuffle partitions.

    Event user ids are read as the type that users have.  Rows keep all their columns; none is left out.
    """
    events = cast_key_like(events, users, "user_id")
    buckets = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = [x for group in heavy_users(events, known_users(users)) for x in group]
    own = F.col("user_id")
    aside = own.isNull() | own.isin(heavy) if heavy else own.isNull()
    (kept_users, users_name), (kept_events, events_name) = _bucketed(users.filter(~aside), buckets), _bucketed(events.filter(~aside), buckets)
    return UserBuckets(kept_users, kept_events, materialize(users.filter(aside)), materialize(events.filter(aside)), (users_name, events_name))


def user_features(stored: UserBuckets) -> DataFrame:
    """:func:`features.user_features`; the time of the latest event is looked up once for all."""
    newest = stored.all_events().select(F.max("event_timestamp")).scalar()
    return stored.per_user(lambda users, events: features.user_features(users, events, newest))


def behaviour_features(stored: UserBuckets) -> DataFrame:
    """:func:`features.behaviour_features`; the event types are looked up once for all, if events have any."""
    types = features.event_types_of(stored.all_events()) if "event_type" in stored.events.columns else None
    return stored.per_user(lambda users, events: features.behaviour_features(users, events, event_types=types))


def user_retention_metrics(stored: UserBuckets, min_day: int | None = None) -> DataFrame:
    """:func:`cohorts.user_retention_metrics` for users that sign up at midnight, as cleaned users do."""
    return stored.per_user(lambda users, events: cohorts.user_retention_metrics(users, events, min_day, exact_signup_time=False))
