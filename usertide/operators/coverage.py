"""How events and users cover each other.

Events are reduced to one row per user before they meet the user table, so a user holding a large
part of all events costs the join a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.operators.membership import key_filter, possible


def events_per_user(events: DataFrame) -> DataFrame:
    """(user_id, event_rows, event_count): all rows, and rows with an event id; null users form one row."""
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("event_rows"), F.count("event_uuid").alias("event_count")
    )


def known_users(users: DataFrame) -> DataFrame:
    return users.select("user_id").distinct()


def heavy_users(events: DataFrame, known: DataFrame) -> tuple[list, list]:
    """Users with more than one task's share of the events, those among ``known`` and the others.

    Fewer users than tasks can be that heavy, so both lists are short.
    """
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_user = events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.count(F.lit(1))).scalar()
    heavy = per_user.filter(F.col("n") * tasks > total).select("user_id")
    found = heavy.join(known.withColumn("__known", F.lit(True)), "user_id", "left").collect()
    return [r[0] for r in found if r[1]], [r[0] for r in found if not r[1]]


def _split_events(users: DataFrame, events: DataFrame, kind: str, prefilter: bool) -> DataFrame:
    """Events with (``left_semi``) or without (``left_anti``) a known user.

    Events of heavy users and of nobody are told apart by a filter and never shuffled; only the rest joins.  With
    ``prefilter`` that is the part of it that a Bloom filter of the users lets pass.
    """
    known = known_users(users)
    there, absent = heavy_users(events, known)
    own = F.col("user_id")
    alone = [x for group in (there, absent) for x in group]
    rest = events.filter(own.isNotNull() & ~own.isin(alone)) if alone else events.filter(own.isNotNull())
    unknown = None
    if prefilter and (found := key_filter(known, "user_id")):
        told = possible(rest, found, "user_id", "__possible")
        rest, unknown = told.filter("__possible"), told.filter("not __possible").select(*events.columns)
    joined = rest.join(known, "user_id", kind).select(*events.columns)
    if kind == "left_anti":
        joined = joined if unknown is None else joined.union(unknown)
        aside = events.filter(own.isNull() | own.isin(absent)) if absent else events.filter(own.isNull())
        return joined.union(aside)
    return joined.union(events.filter(own.isin(there))) if there else joined


def valid_events(users: DataFrame, events: DataFrame, prefilter: bool = False) -> DataFrame:
    """Events whose user exists.

    ``prefilter`` pays where ``users`` is a selection, so that most events have none of them.
    """
    return _split_events(users, events, "left_semi", prefilter)


def orphan_events(users: DataFrame, events: DataFrame, prefilter: bool = False) -> DataFrame:
    """Events whose user does not exist, a null user included.

    ``prefilter`` pays where most events have no user; it reads the events once more.
    """
    return _split_events(users, events, "left_anti", prefilter)


def users_without_events(users: DataFrame, events: DataFrame) -> DataFrame:
    return users.join(events.select("user_id").distinct(), "user_id", "left_anti")


def coverage_counts(users: DataFrame, events: DataFrame) -> DataFrame:
    """One row: total_events, valid_events, orphan_events, active_users."""
    known = known_users(users).withColumn("_known", F.lit(True))
    matched = events_per_user(events).join(known, "user_id", "left")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("event_rows"))), F.lit(0))

    return matched.agg(
        F.coalesce(F.sum("event_rows"), F.lit(0)).alias("total_events"),
        rows_where(F.col("_known")).alias("valid_events"),
        rows_where(F.col("_known").isNull()).alias("orphan_events"),
        F.count("_known").alias("active_users"),
    )
