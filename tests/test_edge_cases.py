"""Semantics on tiny frames: nulls, ties, bounds, missing columns."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from usertide import schema
from usertide.functions import numeric, time
from usertide.operators import checks, coverage, ranking, stats
from usertide.plans import audits, cleaning, cohorts, evaluation, features, model_data, scoring, segments, training


def ts(text):
    return dt.datetime.fromisoformat(text)


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# --- time

def test_parse_is_lenient_and_utc(spark):
    texts = ["2024-01-01T00:00:00+02:00", "2024-01-05", "nonsense", None, "05/02/2024", "2024-01-01T10:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(time.parse_utc(F.col("t"), ("dd/MM/yyyy",))).collect()]
    assert got == [ts("2023-12-31T22:00"), ts("2024-01-05"), None, None, ts("2024-02-05"), ts("2024-01-01T10:00")]


@pytest.mark.parametrize("end, days", [
    ("2024-01-01T23:00:00", -1), ("2024-01-02T00:00:00", 0), ("2024-01-02T23:59:59.999999", 0),
    ("2024-01-03T00:00:00", 1), ("2023-12-31T00:00:00", -2), ("2023-12-31T00:00:00.000001", -2),
])
def test_whole_days_round_down(spark, end, days):
    df = spark.createDataFrame([(ts("2024-01-02"), ts(end))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(time.whole_days_between(F.col("a"), F.col("b"))).first()[0] == days


# --- scalar functions

def test_ratio_is_zero_when_undefined(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (3, None), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(numeric.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0, 0, 0, 1.5]


def test_bins_are_right_closed_like_pandas_cut(spark):
    edges = numeric.evenly_spaced(0, 1, 11)
    data = [0.0, 0.05, 0.1, 0.1000001, 0.3, 0.95, 1.0, 1.1, -0.1, None]
    df = spark.createDataFrame([(x,) for x in data], "v double")
    got = [r[0] for r in df.select(numeric.right_closed_bin(F.col("v"), edges)).collect()]
    want = pd.cut(pd.Series(data, dtype="float"), bins=edges, include_lowest=True, labels=False)
    assert got == [None if pd.isna(x) else int(x) for x in want]


def test_grid_equals_linspace():
    assert numeric.evenly_spaced(0.01, 0.99, 60) == pytest.approx(list(np.linspace(0.01, 0.99, 60)), abs=1e-15)
    assert numeric.evenly_spaced(2.0, 3.0, 1) == [2.0]


@pytest.mark.parametrize("p, band", [(100.0, "High Risk"), (80.0, "High Risk"), (79.99, "Medium Risk"),
                                     (40.0, "Medium Risk"), (39.99, "Low Risk"), (None, "Low Risk")])
def test_risk_bands(spark, p, band):
    assert spark.createDataFrame([(p,)], "p double").select(numeric.risk_band(F.col("p"))).first()[0] == band


# --- checks

def test_swap_leaves_rows_with_null(spark):
    rows = [(ts("2024-01-02"), ts("2024-01-01")), (None, ts("2024-01-01")), (ts("2024-01-02"), None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert values(checks.swap_inverted(df, "a", "b"), "a", "b") == [
        (ts("2024-01-01"), ts("2024-01-02")), (None, ts("2024-01-01")), (ts("2024-01-02"), None)]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_dedup_does_not_depend_on_row_order(spark, partitions):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "q"), ("b", 0, "p"), ("c", None, None)]
    df = spark.createDataFrame(rows * 3, "k string, t int, v string").repartition(partitions)
    assert sorted(values(checks.keep_latest(df, "k", "t"), "k", "t", "v")) == [
        ("a", 3, "y"), ("b", 0, "p"), ("c", None, None)]
    assert sorted(values(checks.keep_earliest(df, "k", "t"), "k", "t", "v")) == [
        ("a", 1, "x"), ("b", 0, "p"), ("c", None, None)]


def test_unique_key_assertion(spark):
    checks.assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), "k")
    with pytest.raises(ValueError, match="repeated"):
        checks.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_cast_key_failure_is_null(spark):
    users = spark.createDataFrame([(1,)], "user_id bigint")
    got = checks.cast_key_like(spark.createDataFrame([("1",), ("x",)], "user_id string"), users, "user_id")
    assert got.schema["user_id"].dataType.simpleString() == "bigint"
    assert values(got, "user_id") == [(1,), (None,)]


def test_fill_and_align(spark):
    df = spark.createDataFrame([(None, None, None, 2.0)], "n int, s string, t timestamp_ntz, d double")
    assert values(checks.fill_by_type(df), "n", "s", "t", "d") == [(0, "unknown", None, 2.0)]
    assert checks.align_columns(df, ["d", "extra", "n"]).columns == ["d", "extra", "n"]


# --- schema checks

def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a")], "user_id int, Subscription string")
    with pytest.raises(ValueError, match="signup_date"):
        schema.require_columns(df, ["user_id", "signup_date"])
    with pytest.raises(ValueError, match="none of"):
        schema.available_columns(df, ["x", "y"])
    assert schema.available_columns(df, ["x", "user_id"]) == ["user_id"]
    assert schema.first_column_like(df, "sub") == "Subscription"
    assert schema.numeric_columns(df) == ["user_id"] and schema.text_columns(df) == ["Subscription"]


def test_cleaning_without_key_columns_returns_input(spark):
    df = spark.createDataFrame([(1, 0)], "user_id int, churned_30d int")
    clean, report = cleaning.clean_users(df)
    assert clean.columns == df.columns
    assert values(report, "metric") == [("missing_columns:signup_date",), ("missing_columns:last_active_date",)]
    clean, report = cleaning.clean_events(df)
    assert clean is df and report.count() == 3


def test_event_report_without_optional_times(spark):
    df = spark.createDataFrame([("a", 1, "play", "2024-01-01"), ("a", 1, "play", "x")],
                               "event_uuid string, user_id int, event_type string, event_timestamp string")
    clean, report = cleaning.clean_events(df)
    assert values(clean, "event_timestamp") == [(ts("2024-01-01"),)]
    assert dict(values(report, "metric", "value")) == {
        "null_event_uuid": 0, "null_user_id": 0, "null_event_timestamp": 1, "duplicates_removed": 1}


def test_latency_needs_all_times(spark):
    with pytest.raises(ValueError, match="received_at"):
        audits.event_delays(spark.createDataFrame([(1,)], "event_timestamp int"))


# --- statistics

def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(5)
    data = np.round(rng.gamma(2.0, 3.0, 997), 2)
    df = spark.createDataFrame([(float(x), None) for x in data], "v double, empty double").repartition(7)
    rows = {r["metric"]: r for r in stats.describe(df, ["v", "empty"], (0.01, 0.05, 0.5, 0.95, 0.99)).collect()}
    want = pd.Series(data).describe(percentiles=[0.01, 0.05, 0.5, 0.95, 0.99])
    got = rows["v"]
    for mine, theirs in [("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p1", "1%"), ("p5", "5%"),
                         ("p50", "50%"), ("p95", "95%"), ("p99", "99%"), ("max", "max")]:
        assert got[mine] == pytest.approx(want[theirs], rel=1e-9)
    assert rows["empty"]["n"] == 0 and rows["empty"]["mean"] is None


def test_describe_of_one_row_has_no_deviation(spark):
    row = stats.describe(spark.createDataFrame([(4.0,)], "v double"), ["v"]).first()
    assert (row["n"], row["std"], row["p25"], row["max"]) == (1, None, 4.0, 4.0)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "v double")
    row = stats.describe(df, ["v"]).first()
    assert (row["n"], row["mean"], row["max"]) == (2, 2.0, 3.0)


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(6)
    data = np.concatenate([rng.normal(0, 3, 500), rng.integers(-3, 4, 500)])
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    got = stats.histogram(df, ["v"]).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=100)
    assert [r["n"] for r in got] == list(counts)
    assert [r["lower"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_equal_values_is_widened(spark):
    got = stats.histogram(spark.createDataFrame([(0.0,)] * 5, "v double"), ["v"]).orderBy("bin").collect()
    counts, edges = np.histogram([0.0] * 5, bins=100)
    assert [r["n"] for r in got] == list(counts)
    assert (got[0]["lower"], got[-1]["upper"]) == (edges[0], edges[-1])


# --- users and events

def small_world(spark):
    users = spark.createDataFrame(
        [(1, ts("2024-01-01")), (2, ts("2024-01-10")), (3, ts("2024-02-01"))], "user_id int, signup_date timestamp_ntz")
    events = spark.createDataFrame(
        [("a", 1, "play", ts("2024-01-08T23:00")), ("b", 1, "open", ts("2024-01-09T00:00")),
         ("c", 2, "play", ts("2024-01-09T23:00")), ("d", 9, "play", ts("2024-01-09")),
         ("e", None, "play", ts("2024-03-01")), ("f", 2, "play", None)],
        "event_uuid string, user_id int, event_type string, event_timestamp timestamp_ntz")
    return users, events


def test_early_activity_bounds(spark):
    users, events = small_world(spark)
    got = {r["user_id"]: (r["events_D7"], r["events_D30"], r["churn_30d"])
           for r in cohorts.user_retention_metrics(users, events, exact_signup_time=False).collect()}
    # 2024-01-08T23:00 still belongs to day 7 of user 1; midnight after it is day 8.
    assert got == {1: (1, 2, 0), 2: (1, 1, 0), 3: (0, 0, 1)}
    strict = {r["user_id"]: r["churn_30d"] for r in cohorts.user_retention_metrics(users, events, min_day=0).collect()}
    assert strict == {1: 0, 2: 1, 3: 1}
    exact = {r["user_id"]: (r["events_D7"], r["events_D30"], r["churn_30d"])
             for r in cohorts.user_retention_metrics(users, events).collect()}
    assert exact == got


def test_signup_time_of_day_is_refused_or_handled(spark):
    users, events = small_world(spark)
    later = users.withColumn("signup_date", F.col("signup_date") + F.expr("INTERVAL 1 HOUR"))
    with pytest.raises(Exception, match="midnight"):
        cohorts.user_retention_metrics(later, events, exact_signup_time=False).collect()
    exact = {r["user_id"]: (r["events_D7"], r["events_D30"])
             for r in cohorts.user_retention_metrics(later, events).collect()}
    assert exact == {1: (2, 2), 2: (1, 1), 3: (0, 0)}


def test_observed_only_leaves_uncovered_users(spark):
    users, events = small_world(spark)
    got = cohorts.user_retention_metrics(users, events, observed_only=True)
    assert values(got, "user_id") == [(2,)]


def test_cohorts_ignore_orphans_and_missing_times(spark):
    users, events = small_world(spark)
    got = values(cohorts.retention_cohorts(users, events), "cohort_month", "event_month", "active_users", "cohort_size",
                 "retention_rate")
    assert got == [("2024-01", "2024-01", 2, 2, 1.0)]


def test_features_of_users_without_events(spark):
    users, events = small_world(spark)
    got = {r["user_id"]: (r["event_count"], r["recency_days"], r["unique_event_types"])
           for r in features.user_features(users, events).collect()}
    # The newest event belongs to nobody, and still sets the reference date.
    assert got == {1: (2, 52, 2), 2: (2, 51, 1), 3: (0, 9999, 0)}


def test_coverage(spark):
    users, events = small_world(spark)
    assert coverage.coverage_counts(users, events).first().asDict() == {
        "total_events": 6, "valid_events": 4, "orphan_events": 2, "active_users": 2}
    assert sorted(values(coverage.orphan_events(users, events), "event_uuid")) == [("d",), ("e",)]
    assert sorted(values(coverage.valid_events(users, events), "event_uuid")) == [("a",), ("b",), ("c",), ("f",)]
    assert values(coverage.users_without_events(users, events), "user_id") == [(3,)]


def test_activity_without_sessions_and_with_unknown_types(spark):
    users, events = small_world(spark)
    profile = users.selectExpr("*", "signup_date AS last_active_date", "'x' AS country", "'y' AS device",
                               "'z' AS language", "cast(null as string) AS subscription_type")
    got = features.behaviour_features(profile, events)
    assert "sessions" not in got.columns and {"ev_open", "ev_play", "ratio_ev_play_ev_open"} <= set(got.columns)
    assert "ratio_ev_pause_ev_play" not in got.columns
    rows = {r["user_id"]: r for r in got.collect()}
    assert (rows[1]["ev_play"], rows[1]["ratio_ev_play_ev_open"], rows[1]["engagement_score"]) == (1, 1.0, 7.0)
    assert (rows[3]["ev_play"], rows[3]["active_days"], rows[3]["subscription_type"]) == (0, 0, "unknown")


def test_activity_without_types_counts_events(spark):
    _, events = small_world(spark)
    got = features.activity(events.drop("event_type"))
    assert sorted(values(got, "user_id", "ev_count", "active_days")) == [(1, 2, 2), (2, 2, 1), (9, 1, 1)]


def test_cardinality_of_absent_columns_is_empty(spark):
    users, events = small_world(spark)
    assert audits.domain_cardinality(users, events.drop("event_type")).count() == 0


def test_fused_sessions_equal_two_level_grouping(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, None), (3, "c"), (1, None)]
    events = spark.createDataFrame(
        [(str(i), u, "play", ts("2024-01-01"), s) for i, (u, s) in enumerate(rows)],
        "event_uuid string, user_id int, event_type string, event_timestamp timestamp_ntz, session_id string")
    fused = features.activity(events).select("user_id", "sessions", "avg_events_per_session").filter("sessions > 0")
    assert sorted(fused.collect()) == sorted(features.session_sizes(events).collect()) == [(1, 2, 1.5), (3, 1, 1.0)]


# --- scores

def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_auc_of_tied_scores_is_a_half(spark):
    assert evaluation.roc_auc(scored(spark, [(0, 0.5), (1, 0.5), (1, 0.5)])).first()[0] == 0.5
    assert evaluation.roc_auc(scored(spark, [(0, 0.1), (1, 0.9)])).first()[0] == 1.0


def test_auc_needs_both_classes(spark):
    assert evaluation.roc_auc(scored(spark, [(1, 0.5), (1, 0.6)])).first()[0] is None


def test_roc_drops_points_on_straight_runs(spark):
    rows = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]
    got = sorted(values(evaluation.roc_points(scored(spark, rows)), "threshold", "fpr", "tpr"), reverse=True)
    assert got == [(float("inf"), 0, 0), (0.9, 0, 0.25), (0.7, 0, 0.75), (0.5, 1, 0.75), (0.4, 1, 1)]


def test_pr_ends_without_threshold(spark):
    got = values(evaluation.pr_points(scored(spark, [(0, 0.2), (1, 0.4)])), "recall", "precision", "threshold")
    assert sorted(got, key=str) == sorted([(1.0, 0.5, 0.2), (1.0, 1.0, 0.4), (0.0, 1.0, None)], key=str)


def test_threshold_rule_and_fallback(spark):
    rows = scored(spark, [(0, 0.1), (0, 0.2), (1, 0.3), (0, 0.4), (1, 0.5)])
    assert evaluation.pick_threshold(rows, 0.6, 0.15).first()[0] == 0.1
    assert evaluation.pick_threshold(rows, 0.6, 0.6).first()[0] == 0.3
    # Unreachable minima: best F1 is 0.8 at 0.3.
    assert evaluation.pick_threshold(rows, 1.1, 0.0).first()[0] == 0.3
    # Equal F1 at 0.2 and 0.3: the smaller score.
    tied = scored(spark, [(1, 0.2), (0, 0.2), (1, 0.3), (1, 0.1), (0, 0.1)])
    best = {r["threshold"]: 2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"])
            for r in evaluation.precision_recall_at_scores(tied).collect()}
    assert evaluation.pick_threshold(tied, best_f1=True).first()[0] == min(
        t for t, f in best.items() if f == max(best.values()))


def test_metrics_are_zero_when_undefined(spark):
    row = evaluation.add_class_metrics(evaluation.confusion_matrix(scored(spark, [(1, 0.1), (1, 0.2)]), 0.9)).first()
    assert (row["precision_pos"], row["recall_pos"], row["f1_pos"], row["recall_neg"]) == (0, 0, 0, 0)


def test_rows_without_a_score_are_not_evaluated(spark):
    rows = scored(spark, [(1, None), (0, float("nan")), (1, 0.5), (0, 0.99)])
    got = {round(r["threshold"], 2): (r["tn"], r["fp"], r["fn"], r["tp"], r["auc"])
           for r in evaluation.threshold_sweep(rows, 3).collect()}
    assert got == {0.01: (0, 1, 0, 1, 0.0), 0.5: (0, 1, 0, 1, 0.0), 0.99: (0, 1, 1, 0, 0.0)}
    at = evaluation.evaluate_at(rows, 0.99).first()
    assert (at["tn"], at["fp"], at["fn"], at["tp"], at["threshold"]) == (0, 1, 1, 0, 0.99)
    assert tuple(evaluation.confusion_matrix(rows, 0.99).first()) == (0, 1, 1, 0)


def test_calibration_keeps_empty_bins(spark):
    got = scoring.calibration_table(scored(spark, [(1, 0.05), (0, 0.1), (1, 0.11), (1, 1.0)])).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    assert (got[0]["mean_outcome"], got[2]["mean_outcome"]) == (0.5, None)


def test_missing_score_is_lowest_segment(spark):
    rows = spark.createDataFrame([(1, None), (2, 0.1), (3, 0.9), (None, 0.9)], "user_id int, score double")
    got = {(r["user_id"], r["risk_segment"]) for r in scoring.risk_segments(rows).collect()}
    assert got == {(1, "Low Risk"), (2, "Low Risk"), (3, "High Risk"), (None, "High Risk")}
    summary = {r["risk_segment"]: (r["user_count"], r["pct"]) for r in scoring.segment_summary(rows).collect()}
    assert summary == {"Low Risk": (2, 50.0), "High Risk": (1, 25.0)}


def test_percentile_equals_pandas_rank(spark):
    rng = np.random.default_rng(7)
    data = np.round(rng.beta(2, 5, 800), 2)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(data)], "user_id int, score double")
    got = {r["user_id"]: r["churn_percentile"] for r in scoring.risk_segments(df).collect()}
    want = pd.Series(data).rank(pct=True) * 100
    assert [got[i] for i in range(800)] == pytest.approx(list(want))


def test_top_scores_break_ties_by_id(spark):
    rows = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 1.0), (4, 0.5)], "user_id int, score double")
    assert values(scoring.top_scores(rows, 2), "user_id") == [(1,), (2,)]


# --- model table

def test_null_category_gives_zeros_and_first_level_is_dropped(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "c string")
    columns = model_data.dummy_columns(model_data.fit_levels(df, ["c"]))
    got = df.select(*[c.alias(n) for n, c in columns.items()])
    assert got.columns == ["c_b", "c_c"]
    assert [tuple(r) for r in got.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 3.0)], "k int, v double")
    columns = model_data.scaled_columns(model_data.fit_scaler(df, ["k", "v"]))
    assert [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()] == [(0, -1), (0, 1)]


def test_join_label_drops_dates_unless_compat(spark):
    feats = spark.createDataFrame([(1, ts("2024-01-01"), ts("2024-01-02"), 3)],
                                  "user_id int, signup_date timestamp_ntz, last_active_date timestamp_ntz, views int")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "user_id int, churn_30d int")
    assert model_data.join_label(feats, labels).columns == ["user_id", "views", "churn_30d"]
    compat = model_data.join_label(feats, labels, compat=True)
    assert values(compat, "signup_date") == [("2024-01-01",)]
    with pytest.raises(ValueError, match="repeated"):
        model_data.join_label(feats, labels.unionByName(labels))


def test_nearest_centroid_takes_lowest_index_on_ties(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "v double")
    assert values(segments.nearest_centroid(df, ["v"], [[0.0], [2.0]]), "cluster") == [(0,), (0,), (1,)]


def test_range_of_values_outside_cuts(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (9.0,)], "v double")
    assert [r["_range"] for r in ranking.add_range(df, "v", [0.0, 1.0], "_range").collect()] == [0, 1, 1, 2, 2]


def test_time_without_a_date_is_no_timestamp(spark):
    texts = ["12:34:56", "T1:2", "99999", "2024", "2024-3", "2024-03-05", "2024-03-05T01:02:03Z", "2024-03-05 01:02:03+02:00", "x2024-03-05", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [None if r[0] is None else r[0].isoformat() for r in df.select(time.parse_utc(F.col("t"))).collect()]
    assert got == [None, None, None, "2024-01-01T00:00:00", "2024-03-01T00:00:00", "2024-03-05T00:00:00", "2024-03-05T01:02:03", "2024-03-04T23:02:03", None, None]


def test_top_scores_put_missing_scores_last(spark):
    df = spark.createDataFrame([(1, 0.9), (2, float("nan")), (3, 0.1), (4, None)], "user_id int, score double")
    assert [r["user_id"] for r in scoring.top_scores(df, 3).collect()] == [1, 3, 2]


def test_columns_of_common_names(spark):
    rows = [(i, i % 5 / 5, i, "x", 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id int, score double, n int, _salt string, `a.b` double")
    got = scoring.risk_segments(df.withColumn("n_total", F.lit(1)).withColumn("churn_percentile", F.lit("old"))).toPandas()
    assert sorted(got.n) == list(range(10)) and sorted(set(got.churn_percentile.round(9))) == [15.0, 35.0, 55.0, 75.0, 95.0]


@pytest.mark.parametrize("name", ["weight", "x0", "features", "prediction", "a.b", "odd`name", "probability"])
def test_a_models_column_names_do_not_matter(spark, name):
    rows = [(i, float(i % 7), "ab"[i % 2], int(i % 3 == 0), "train" if i % 4 else "test") for i in range(80)]
    plain = spark.createDataFrame(rows, "user_id int, value double, kind string, churn_30d int, split string")
    results = []
    for column in ("value", name):
        data = plain.withColumnRenamed("value", column)
        trained = training.train_churn_models(data, only=("logreg",))
        model = trained.models["logreg"]
        results.append((sorted(r["importance"] for r in model.importances().collect()), [r["score"] for r in model.score(data).orderBy("user_id").collect()]))
    assert results[0][0] == pytest.approx(results[1][0]) and results[0][1] == pytest.approx(results[1][1])


def test_scores_and_labels_may_be_missing(spark):
    rows = [(i / 20, float(i % 3 == 0)) for i in range(20)] + [(None, 1.0), (0.5, None), (float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "score double, churn_30d double")
    assert training.calibrate_platt(df).transform(df).count() == 21
    assert training.calibrate_isotonic(df).transform(df.dropna()).filter("calibrated is null").count() == 0


def test_all_event_types_become_columns(spark):
    events = spark.createDataFrame([("1", 1, "like"), ("2", 1, "play"), ("3", 2, "a.b")], "event_uuid string, user_id int, event_type string")
    assert features.pivot_event_counts(events).columns == ["user_id", "ev_a.b", "ev_like", "ev_play"]
    long = features.event_counts_long(events)
    assert {tuple(r) for r in long.collect()} == {(1, "like", 1), (1, "play", 1), (2, "a.b", 1)}


@pytest.mark.parametrize("labels", [3, 150])
def test_split_takes_any_number_of_labels(spark, labels):
    df = spark.range(3000).select("id", F.when(F.col("id") % labels > 0, F.col("id") % labels).alias("y"))
    got = model_data.stratified_split(df, "y", "id", 0.25).groupBy("y").agg(F.count_if(F.col("split") == "test").alias("t"), F.count(F.lit(1)).alias("n"))
    assert all(r["t"] == int(r["n"] * 0.25 + 0.5) for r in got.collect())
