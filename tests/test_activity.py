"""Active-month bitmaps against sets of months, merged loads, and the plan."""

import datetime
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from usertide.catalog.views import Views
from usertide.operators import activity
from usertide.plans import cohorts, features


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id int, event_timestamp timestamp_ntz")


def at(year, month, day=5):
    return datetime.datetime(year, month, day, 12)


ROWS = [(1, at(2024, 1)), (1, at(2024, 1, 9)), (1, at(2024, 3)), (2, at(1969, 12)), (2, at(2030, 12)), (3, at(1970, 1)), (None, at(2024, 1)), (4, None)]


def test_months_of_users(spark):
    got = {r["user_id"]: tuple(r)[1:] for r in activity.active_months(activity.activity_bitmaps(events(spark, ROWS))).collect()}
    day = datetime.date
    assert got == {1: (2, day(2024, 1, 1), day(2024, 3, 1)), 2: (2, day(1969, 12, 1), day(2030, 12, 1)), 3: (1, day(1970, 1, 1), day(1970, 1, 1))}


def test_every_bit_of_a_word(spark):
    months = [(1900 + o // 12, o % 12 + 1) for o in range(60 * 12, 90 * 12)]
    table = activity.activity_bitmaps(events(spark, [(i % 7, at(*m)) for i, m in enumerate(months)]))
    got = {r["month"]: r["active"] for r in activity.months_by_group(table.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert got == {datetime.date(*m, 1): 1 for m in months}


def test_merged_loads_equal_one_load(spark):
    parts = [events(spark, ROWS[:3]), events(spark, ROWS[2:5]), events(spark, ROWS[5:]), events(spark, ROWS[:0])]
    merged = activity.merge_bitmaps(*[activity.activity_bitmaps(p) for p in parts])
    whole = activity.activity_bitmaps(events(spark, ROWS))
    assert sorted(map(tuple, activity.active_months(merged).collect())) == sorted(map(tuple, activity.active_months(whole).collect()))
    assert merged.count() == 3


def test_nothing(spark):
    empty = activity.activity_bitmaps(events(spark, []))
    assert empty.collect() == [] and activity.active_months(empty).collect() == []
    assert activity.months_by_group(empty.withColumn("g", F.lit(1)), ["g"]).collect() == []
    users = spark.createDataFrame([(1, at(2024, 1))], "user_id int, signup_date timestamp_ntz")
    assert cohorts.retention_by_bitmaps(users, events(spark, [])).collect() == []


def test_same_rows_as_by_pairs(spark, sf_dir):
    v = Views(spark, sf_dir)
    for users, some in ((v.users(), v.events()), (v.order_users(), v.order_events())):
        want = sorted(map(tuple, cohorts.retention_cohorts(users, some).collect()))
        assert sorted(map(tuple, cohorts.retention_by_bitmaps(users, some).collect())) == want


def test_repeated_users_of_several_cohorts(spark):
    users = spark.createDataFrame([(1, at(2023, 12)), (1, at(2024, 1)), (1, at(2024, 1, 20)), (9, at(2024, 1)), (3, None)], "user_id int, signup_date timestamp_ntz")
    want = sorted(map(tuple, cohorts.retention_cohorts(users, events(spark, ROWS)).collect()))
    assert sorted(map(tuple, cohorts.retention_by_bitmaps(users, events(spark, ROWS)).collect())) == want and want


def test_one_row_per_user_is_shuffled(spark):
    some = spark.range(60_000).select((F.col("id") % 50).cast("int").alias("user_id"), F.make_timestamp_ntz(2000 + (F.col("id") % 20).cast("int"), (F.col("id") % 12 + 1).cast("int"), F.lit(3), F.lit(0), F.lit(0), F.lit(0)).alias("event_timestamp"))
    table = activity.activity_bitmaps(some)
    assert table.count() == 50
    plan = table._jdf.queryExecution().executedPlan().toString()
    # Partial bit_or below the only exchange.
    assert plan.count("Exchange") == 1 and plan.count("partial_bit_or") >= 1


def test_matrix_long_has_every_cell(spark):
    table = spark.createDataFrame([("2024-01", "2024-01", 0.5), ("2024-02", "2024-03", 1.0)], "cohort_month string, event_month string, retention_rate double")
    got = {(r["cohort_month"], r["event_month"]): r["rate"] for r in cohorts.retention_matrix_long(table).collect()}
    assert got == {("2024-01", "2024-01"): 0.5, ("2024-01", "2024-03"): 0.0, ("2024-02", "2024-01"): 0.0, ("2024-02", "2024-03"): 1.0}


@pytest.mark.parametrize("gone", ["country", "device"])
def test_behaviour_features_without_a_profile_column(spark, sf_dir, gone):
    v = Views(spark, sf_dir)
    got = features.behaviour_features(v.users().drop(gone), v.events())
    assert gone not in got.columns and got.count() == v.users().count()
