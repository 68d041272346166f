"""Bucketed tables join and group without a shuffle of events; Bloom filters keep rows out of the exact join."""

import contextlib
import re

import pytest
from test_scale import hot_events, plan_of, plain_users

from usertide.operators import coverage, membership
from usertide.plans import buckets, cohorts, features


@contextlib.contextmanager
def settings(spark, **values):
    names = {"broadcast": "spark.sql.autoBroadcastJoinThreshold", "aqe": "spark.sql.adaptive.enabled"}
    before = {names[k]: spark.conf.get(names[k], None) for k in values}
    try:
        for k, value in values.items():
            spark.conf.set(names[k], value)
        yield
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def rows(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.fixture(scope="module")
def stored(spark):
    users, events = plain_users(spark), hot_events(spark, 60000)
    found = buckets.store_buckets(users, events)
    yield users, events, found
    found.forget()


def test_buckets_hold_every_row_and_heavy_users_apart(spark, stored):
    users, events, found = stored
    assert rows(found.all_events()) == rows(events) and rows(found.users.unionByName(found.heavy_users)) == rows(users)
    assert {r[0] for r in found.heavy_events.select("user_id").distinct().collect()} - {None} == {0}
    assert found.events.filter("user_id is null or user_id = 0").count() == 0


def test_jobs_per_user_are_the_same_from_buckets(spark, stored):
    users, events, found = stored
    assert rows(buckets.user_features(found)) == rows(features.user_features(users, events))
    assert rows(buckets.user_retention_metrics(found)) == rows(cohorts.user_retention_metrics(users, events))
    assert rows(buckets.user_retention_metrics(found, min_day=0)) == rows(cohorts.user_retention_metrics(users, events, min_day=0))


def test_bucketed_events_are_not_exchanged(spark, stored):
    users, events, found = stored
    with settings(spark, broadcast="-1", aqe="false"):
        for job in (
            lambda u, e: features.user_features(u, e, stored_newest(e)),
            lambda u, e: features.behaviour_features(u, e, event_types=["play", "open"]),
            lambda u, e: cohorts.user_retention_metrics(u, e, exact_signup_time=False),
        ):
            assert "Exchange hashpartitioning" in plan_of(job(users, events))
            assert not re.search(r"(?<!Reused)Exchange (hash|range|round)", plan_of(job(found.users, found.events)))


def stored_newest(events):
    return events.selectExpr("max(event_timestamp)").scalar()


def test_buckets_of_nothing(spark, stored):
    users, events, _ = stored
    for u, e in ((users.limit(0), events), (users, events.limit(0)), (users.limit(0), events.limit(0))):
        found = buckets.store_buckets(u, e)
        assert rows(buckets.user_features(found)) == rows(features.user_features(u, e))
        names = found.names
        found.forget()
        assert not any(spark.catalog.tableExists(n) for n in names)


def test_a_filter_fails_no_key_and_most_others(spark):
    keys = spark.range(0, 200_000, 4).selectExpr("id AS user_id").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    found = membership.key_filter(keys, "user_id")
    told = membership.possible(spark.range(200_000).selectExpr("id AS user_id").union(spark.sql("SELECT CAST(NULL AS BIGINT)")), found, "user_id", "hit")
    assert told.filter("user_id % 4 = 0 and not hit").count() == 0 and told.filter("user_id is null and hit").count() == 0
    assert told.filter("user_id % 4 <> 0 and hit").count() < 150_000 * 0.02
    nothing = membership.key_filter(keys.limit(0), "user_id")
    assert membership.possible(keys, nothing, "user_id", "hit").filter("hit").count() == 0


@pytest.mark.parametrize("most", [membership.MOST_WORDS, 0])
def test_prefiltered_events_are_the_same(spark, monkeypatch, most):
    """With a filter, and without one where there are too many keys."""
    monkeypatch.setattr(membership, "MOST_WORDS", most)
    events = hot_events(spark, 60000)
    for users in (plain_users(spark), plain_users(spark).filter("user_id % 50 = 1"), plain_users(spark).limit(0)):
        with settings(spark, broadcast="-1"):
            assert rows(coverage.valid_events(users, events, prefilter=True)) == rows(coverage.valid_events(users, events))
            assert rows(coverage.orphan_events(users, events, prefilter=True)) == rows(coverage.orphan_events(users, events))


def test_fewer_rows_are_shuffled_behind_a_filter(spark):
    """The plan filters by the broadcast words before the exchange, and few of the others pass."""
    users, events = plain_users(spark).filter("user_id % 50 = 1"), hot_events(spark, 60000)
    with settings(spark, broadcast="-1", aqe="false"):
        plan = plan_of(coverage.valid_events(users, events, prefilter=True))
    exact = plan.index("SortMergeJoin")
    assert exact < plan.index("Exchange hashpartitioning(user_id") < plan.index("BroadcastHashJoin")
    told = membership.possible(events, membership.key_filter(coverage.known_users(users), "user_id"), "user_id", "hit")
    passed = told.filter("hit").count()
    assert coverage.valid_events(users, events).count() <= passed < events.count() * 0.1
