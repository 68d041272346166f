"""Skew, partitioning and plan shape."""

import math
import re

import numpy as np
import pandas as pd
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from usertide.catalog import ORACLES, QUERIES
from usertide.catalog.views import Views
from usertide.operators import checks, coverage, ranking
from usertide.plans import cohorts, evaluation, features, model_data, scoring, silhouettes


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_events(spark, n=9000):
    """A third of the events belong to user 0, another part to no user."""
    i = F.col("id")
    user = F.when(i % 3 == 0, 0).when(i % 11 == 0, None).otherwise(i % 50)
    return spark.range(n).select(
        i.cast("string").alias("event_uuid"),
        user.alias("user_id"),
        F.concat(F.lit("t"), i % 4).alias("event_type"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(i % 2000).cast("int"))).alias(
            "event_timestamp"),
    ).repartition(16)


def plain_users(spark):
    return spark.range(40).select(
        F.col("id").alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 40).cast("int"))).alias(
            "signup_date"),
    )


def test_hot_user_counts_equal_pandas(spark):
    users, events = plain_users(spark), hot_events(spark)
    u, e = users.toPandas(), events.toPandas()
    merged = e.merge(u, on="user_id", how="inner")
    days = (merged.event_timestamp - merged.signup_date).dt.days
    want = merged[days <= 7].groupby("user_id").size().reindex(u.user_id, fill_value=0)
    got = cohorts.user_retention_metrics(users, events).toPandas().set_index("user_id").sort_index()
    assert list(got.events_D7) == list(want)
    counted = features.user_features(users, events).toPandas().set_index("user_id").sort_index()
    assert list(counted.event_count) == list(e.groupby("user_id").event_uuid.count().reindex(u.user_id, fill_value=0))
    assert coverage.coverage_counts(users, events).first()["valid_events"] == len(merged)


def test_hot_score_percentiles(spark):
    """A third of the rows share one score; ranged and salted ranks agree with pandas."""
    rng = np.random.default_rng(3)
    data = rng.random(3000)
    data[::3] = 0.5
    rows = [(i, float(x)) for i, x in enumerate(data)] + [(-i, None) for i in range(1, 50)]
    df = spark.createDataFrame(rows, "user_id int, score double").repartition(9)
    got = scoring.risk_segments(df).toPandas().set_index("user_id").churn_percentile
    want = pd.Series(data).rank(pct=True) * 100
    assert [got[i] for i in range(3000)] == pytest.approx(list(want))
    assert got[-1] != got[-1] and len(got) == len(rows)


def test_a_million_distinct_scores(spark):
    """AUC, percentiles and quantiles of many distinct scores, a third of the rows on one of them."""
    n = 1_500_000
    score = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(2**50)) / 2.0**50)
    rows = spark.range(n).select(F.col("id").alias("row_id"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3).cast("int").alias("label"), score.alias("score"))
    data = rows.toPandas()
    ranks = data.score.rank()
    positive = int(data.label.sum())
    auc = (ranks[data.label == 1].sum() - positive * (positive + 1) / 2) / (positive * (n - positive))
    assert evaluation.roc_auc(rows).first()[0] == pytest.approx(auc, abs=1e-12)
    got = scoring.score_distribution(rows).first()
    assert got["n"] == n and [got[f"p{q}"] for q in (10, 25, 50, 75, 90)] == [round(data.score.quantile(q / 100), 3) for q in (10, 25, 50, 75, 90)]
    placed = scoring.risk_segments(rows).filter("row_id % 1009 = 0").toPandas().set_index("row_id").churn_percentile.sort_index()
    assert list(placed) == pytest.approx(list((ranks / n * 100)[placed.index]))


def test_ranges_hold_even_shares(spark):
    df = spark.range(4000).select(F.col("id").cast("double").alias("v"))
    table = ranking.value_table(df, "v", {"n": F.count(F.lit(1))})
    sizes = [r["count"] for r in table.groupBy(ranking.RANGE).count().collect()]
    assert len(sizes) == ranking.parallelism(df) and max(sizes) < 2 * 4000 / len(sizes)


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_results_do_not_depend_on_partitions(spark, sf_dir, partitions):
    rows = Views(spark, sf_dir).scored().repartition(partitions)
    auc = evaluation.roc_auc(rows).first()[0]
    stretched = rows.withColumn("score", F.exp("score") * 3 - 1)
    assert auc == pytest.approx(evaluation.roc_auc(stretched).first()[0], abs=1e-12)
    split = model_data.stratified_split(rows, "label", "row_id")
    got = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    for label in (0, 1):
        total = got[(label, "test")] + got[(label, "train")]
        assert got[(label, "test")] == round(0.2 * total)
    digest = split.filter("split = 'test'").agg(F.sum(F.xxhash64("row_id").cast("decimal(38,0)"))).first()[0]
    again = model_data.stratified_split(rows.repartition(3), "label", "row_id").filter("split = 'test'")
    assert again.agg(F.sum(F.xxhash64("row_id").cast("decimal(38,0)"))).first()[0] == digest


@pytest.mark.parametrize("share, count", [(0.0, 0), (1.0, 7), (0.5, 4)])
def test_split_extremes(spark, share, count):
    df = spark.range(7).select("id", F.lit(1).alias("y"))
    assert model_data.stratified_split(df, "y", "id", share).filter("split = 'test'").count() == count


def test_sweep_cells_add_up(spark, sf_dir):
    rows = Views(spark, sf_dir).scored()
    total = rows.count()
    for r in evaluation.threshold_sweep(rows, 20).collect():
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == total


def test_segments_partition_the_users(spark, sf_dir):
    rows = Views(spark, sf_dir).scored()
    summary = scoring.segment_summary(rows, id_col="row_id").collect()
    assert sum(r["user_count"] for r in summary) == rows.count()


def test_user_features_aggregate_the_events_once(spark, tmp_path):
    """One full read; the second scan is limited to events without a user."""
    hot_events(spark).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    plan = plan_of(features.user_features(plain_users(spark), events)).split("+- == Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    full = plan_of(features.user_features(plain_users(spark), events))
    assert "ReusedExchange" in full
    assert len([line for line in scans if "IsNull(user_id)" not in line]) <= 1


def test_dedup_trims_copies_before_the_shuffle(spark, sf_dir):
    v = Views(spark, sf_dir)
    plan = plan_of(checks.keep_latest(v.order_events(), "user_id", "event_timestamp"))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plan)


def test_hot_users_and_nobody_stay_out_of_the_join(spark):
    """A third of the events on one user and many on none: neither reaches the shuffle, with no help from skew joins."""
    users, events = plain_users(spark), hot_events(spark, 60000)
    known, unknown = coverage.heavy_users(events, coverage.known_users(users))
    assert known == [0] and unknown == []
    u, e = users.toPandas(), events.toPandas()
    matched = e.user_id.isin(u.user_id)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        valid, orphan = coverage.valid_events(users, events), coverage.orphan_events(users, events)
        assert set(valid.toPandas().event_uuid) == set(e.event_uuid[matched]) and valid.count() == matched.sum()
        assert set(orphan.toPandas().event_uuid) == set(e.event_uuid[~matched]) and orphan.columns == events.columns
        nobody = coverage.orphan_events(users.limit(0), events)
        assert nobody.count() == len(e) and coverage.heavy_users(events, users.limit(0).select("user_id"))[1] == [0]
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_audit_reads_event_ids_alone_and_expands_no_events(spark, sf_dir):
    """Besides the stored pass per user and category only the event ids are read, and no row is multiplied."""
    plan = plan_of(QUERIES["quality_audit"](spark, sf_dir)).split("+- == Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "events.parquet" in line]
    assert len(scans) == 1 and "ReadSchema: struct<event_id:bigint>" in scans[0]


def test_silhouettes_meet_the_sample_once_for_all_clusterings(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(90, 3)).round(3).tolist()
    points[4][1] = points[77][2] = None
    rows = [(i, *p, i % 3, None if i == 8 else int(i > 60)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "user_id long, x double, y double, z double, a int, b int").repartition(3)
    monkeypatch.setattr(silhouettes, "BLOCK", 200)  # a few rows at a time
    monkeypatch.setattr(silhouettes, "HELD", 0)  # sums leave the task after every block
    found = silhouettes.euclidean_silhouettes(df, ["x", "y", "z"], ["a", "b"], rows=90)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "cross" not in plan.lower()
    got = {r["clustering"]: r for r in found.collect()}
    kept = [r for r in rows if r[5] is not None]
    for name, at in (("a", 4), ("b", 5)):
        values = []
        for s in kept:
            sums = {}
            for r in kept:
                d, n, known = sums.get(r[at], (0.0, 0, False))
                near = math.dist(s[1:4], r[1:4]) if None not in (*s[1:4], *r[1:4]) else None
                sums[r[at]] = (d + (near or 0.0), n + 1, known or near is not None)
            inside = sums[s[at]][0] / (sums[s[at]][1] - 1)
            others = [d / n for c, (d, n, known) in sums.items() if c != s[at] and known]
            values.append((min(others) - inside) / max(min(others), inside) if others else None)
        values = [v for v in values if v is not None]
        assert got[name]["n_rows"] == got[name]["n_sampled"] == 89
        assert got[name]["silhouette"] == pytest.approx(sum(values) / len(values), abs=1e-12)
