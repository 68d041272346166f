"""The checks of fitted models: they pass for the fits, and notice models that are not what they should be."""

import dataclasses

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from usertide.catalog.views import Views
from usertide.operators import moments
from usertide.plans import certificates, model_data, segments, silhouettes, training


@pytest.fixture(scope="module")
def data(spark):
    v = Views(spark, "/root/testdata/sf0.01")
    return model_data.prepare_model_data(v.features(), v.metrics()).cache()


@pytest.fixture(scope="module")
def found(spark):
    return segments.segment_users(Views(spark, "/root/testdata/sf0.01").features(), ks=range(2, 5))


@pytest.fixture(scope="module")
def forest(data, tmp_path_factory):
    train = data.filter("split = 'train'")
    model = training.fit_forest(train, model_data.fit_encoding(train), trees=7, depth=6)
    path = str(tmp_path_factory.mktemp("forest"))
    model.save(path)
    return model, path


def gradients(model, train):
    return {r["feature"]: r for r in certificates.logistic_gradient(model, train).collect()}


def test_gradient_equals_numpy_and_vanishes_only_at_the_fit(data):
    train = data.filter("split = 'train'")
    model = training.fit_logistic(train, model_data.fit_encoding(train))
    early = training.fit_logistic(train, model_data.fit_encoding(train), max_iter=3)
    encoding = model_data.fit_encoding(train)
    table = encoding.apply(train).toPandas()
    x, y = table[encoding.features].to_numpy(float), table.churn_30d.to_numpy(float)
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    for fit, bound in ((model, 1e-4), (early, None)):
        got, b = gradients(fit, train), fit.pipeline.stages[-1]
        p = 1 / (1 + np.exp(-(x @ b.coefficients.toArray() + b.intercept)))
        want = x.T @ (w * (p - y)) / w.sum() + b.coefficients.toArray() / w.sum()
        assert [got[f]["gradient"] for f in encoding.features] == pytest.approx(list(want), abs=1e-9)
        assert [got[f]["gradient_at_zero"] for f in encoding.features] == pytest.approx(list(x.T @ (w * (0.5 - y)) / w.sum()), abs=1e-9)
        assert got["(intercept)"]["gradient"] == pytest.approx((w * (p - y)).sum() / w.sum(), abs=1e-9)
        largest = max(abs(r["gradient"]) for r in got.values())
        assert largest < bound if bound else largest > 1e-4


def test_gradient_leaves_out_unlabelled_rows(data):
    train = data.filter("split = 'train'")
    model = training.fit_logistic(train, model_data.fit_encoding(train))
    more = train.unionByName(train.limit(50).withColumn("churn_30d", F.lit(None).cast("int")))
    assert {f: r["gradient"] for f, r in gradients(model, more).items()} == pytest.approx({f: r["gradient"] for f, r in gradients(model, train).items()})


def test_different_scores_are_counted(data):
    train = data.filter("split = 'train'")
    model = training.fit_logistic(train, model_data.fit_encoding(train))
    other = training.fit_logistic(train, model_data.fit_encoding(train), max_iter=2)
    assert certificates.logistic_score_check(model, data).first()["n_different"] == 0
    mixed = dataclasses.replace(model, pipeline=type(model.pipeline)([*model.pipeline.stages[:-1], Renamed(other, model)]))
    assert certificates.logistic_score_check(mixed, data).first()["n_different"] == data.count()


class Renamed:
    """Scores of one model under the coefficients of another."""

    def __init__(self, scores, claims):
        self.scores, self.coefficients, self.intercept = scores.pipeline.stages[-1], claims.pipeline.stages[-1].coefficients, claims.pipeline.stages[-1].intercept

    def transform(self, df):
        return self.scores.transform(df)


def test_walked_scores_are_the_forest_s(spark, data, forest):
    model, path = forest
    both = certificates.forest_check(model, path, data).collect()
    assert len(both) == data.count()
    assert [r["walked"] for r in both] == pytest.approx([r["score"] for r in both], abs=1e-9)
    nodes = certificates.forest_nodes(spark, path)
    assert certificates.depth_of(nodes) == max(t.depth for t in model.pipeline.stages[-1].trees)
    assert nodes.filter("left = node").count() + nodes.filter("left <> node").count() == sum(t.numNodes for t in model.pipeline.stages[-1].trees)


def test_walk_without_broadcast_and_a_changed_tree(spark, data, forest, monkeypatch):
    model, path = forest
    rows = certificates.assembled(model, data)
    nodes = certificates.forest_nodes(spark, path)
    want = {r["user_id"]: r["score"] for r in certificates.walk_forest(rows, nodes).collect()}
    monkeypatch.setattr(certificates, "BROADCAST_NODES", 0)
    assert {r["user_id"]: r["score"] for r in certificates.walk_forest(rows, nodes).collect()} == pytest.approx(want)
    flipped = nodes.withColumn("share", F.when(F.col("tree") == 0, 1 - F.col("share")).otherwise(F.col("share")))
    got = {r["user_id"]: r["score"] for r in certificates.walk_forest(rows, flipped).collect()}
    assert sum(abs(got[i] - want[i]) > 1e-6 for i in want) > len(want) / 2


def test_node_importances_are_the_forest_s(spark, forest):
    model, path = forest
    got = {r["feature"]: r["importance"] for r in certificates.node_importances(certificates.forest_nodes(spark, path), model.features).collect()}
    assert got == pytest.approx({r["feature"]: r["importance"] for r in model.importances().collect()})


def test_a_tree_of_one_leaf(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 0, None, None, 0.25, 4.0, 0.0)], "tree int, node int, left int, right int, feature int, threshold double, share double, weight double, gain double")
    rows = spark.createDataFrame([(1, [1.0]), (2, [5.0])], "user_id int, features array<double>")
    assert {r["user_id"]: r["score"] for r in certificates.walk_forest(rows, nodes).collect()} == {1: 0.25, 2: 0.25}
    assert certificates.depth_of(nodes) == 0


def test_kmeans_check_holds_for_the_fits(found):
    for r in certificates.kmeans_check(found).collect():
        assert (r["n_strays"], r["n_clusters"], r["centred"], r["agrees"], r["split"]) == (0, r["k"], True, True, True)


def test_kmeans_check_notices_other_assignments(found):
    moved = found.labelled.withColumn("_c3", F.when(F.col("user_id") % 10 == 0, (F.col("_c3") + 1) % 3).otherwise(F.col("_c3")))
    rows = {r["k"]: r for r in certificates.kmeans_check(dataclasses.replace(found, labelled=moved)).collect()}
    assert rows[3]["n_strays"] > 0 and not rows[3]["centred"] and not rows[3]["agrees"]
    assert rows[2]["n_strays"] == 0 and rows[2]["centred"]


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == other].mean() for other in set(labels) - {c})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


def points(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) + rng.integers(0, 3, n)[:, None] * 2, 3)
    a, b = rng.integers(0, 3, n), np.where(np.arange(n) == 7, 4, rng.integers(0, 2, n))
    rows = [(i, *map(float, r), int(p), int(q)) for i, (r, p, q) in enumerate(zip(x, a, b))]
    return x, a, b, spark.createDataFrame(rows, "user_id int, u double, v double, w double, a int, b int")


def test_silhouettes_equal_all_pairs(spark):
    x, a, b, df = points(spark, 300)
    got = {r["clustering"]: r for r in silhouettes.euclidean_silhouettes(df, ["u", "v", "w"], ["a", "b"]).collect()}
    for name, labels in (("a", a), ("b", b)):
        assert got[name]["silhouette"] == pytest.approx(brute_silhouette(x, labels).mean())
        assert (got[name]["n_rows"], got[name]["n_sampled"], got[name]["standard_error"]) == (300, 300, 0.0)


def test_sampled_silhouettes_are_within_their_error(spark):
    x, a, _, df = points(spark, 900)
    whole = brute_silhouette(x, a)
    ids = [r["user_id"] for r in silhouettes.hash_sample(df, "user_id", 200, 42).collect()]
    got = silhouettes.euclidean_silhouettes(df.repartition(7), ["u", "v", "w"], ["a"], rows=200).first()
    assert got["silhouette"] == pytest.approx(whole[ids].mean()) and got["n_sampled"] == 200
    assert got["standard_error"] == pytest.approx(whole[ids].std(ddof=1) / np.sqrt(200) * np.sqrt(1 - 200 / 900))
    assert abs(got["silhouette"] - whole.mean()) < 4 * got["standard_error"]


def test_silhouettes_of_odd_tables(spark):
    _, _, _, df = points(spark, 20)
    one = silhouettes.euclidean_silhouettes(df.withColumn("a", F.lit(0)), ["u"], ["a"]).first()
    assert one["silhouette"] is None and one["n_sampled"] == 20
    assert silhouettes.euclidean_silhouettes(df.limit(0), ["u"], ["a"]).collect() == []
    same = silhouettes.euclidean_silhouettes(df.withColumn("u", F.lit(1.0)), ["u"], ["a"]).first()
    assert same["silhouette"] == 0.0
    nulls = df.withColumn("a", F.when(F.col("user_id") >= 4, F.col("a")))
    assert silhouettes.euclidean_silhouettes(nulls, ["u"], ["a"]).first()["n_rows"] == 16


def test_choices_use_the_silhouettes_of_all_users(spark):
    rng = np.random.default_rng(11)
    x = rng.gamma(1.0, 4.0, size=(1300, 2)).round(2) + rng.integers(0, 3, 1300)[:, None] * [30, 5]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "user_id long, views double, credits_spent double")
    found = segments.segment_users(df, ks=(2, 3, 4))
    rows = found.labelled.toPandas()
    for r in found.choices.collect():
        whole = brute_silhouette(rows[["_z0", "_z1"]].to_numpy(), rows[f"_c{r['k']}"].to_numpy())
        assert r["silhouette"] == pytest.approx(whole.mean(), abs=1e-9) and r["standard_error"] == 0.0


def test_all_pairs_equal_the_sums_of_a_whole_sample(spark, monkeypatch):
    """Rows that come twice, rows far from all others and close to each other, missing coordinates and clusters, a cluster of one."""
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(150, 3)).round(3), 2, axis=0)
    x[:40] = 3e6 + x[:40] * 1e-6
    rows = [(i // 2, *map(float, r), i % 3 - 1, 7 if i == 30 else int(i > 60), 0 if i > 90 else None, 1) for i, r in enumerate(x)]
    rows = [(r[0], None if i % 41 == 3 else r[1], *r[2:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "user_id int, u double, v double, w double, a int, b int, c int, d int").repartition(5)
    names = ("a", "b", "d")
    wanted = {r["clustering"]: r for r in silhouettes.euclidean_silhouettes(df, ["u", "v", "w"], names, rows=1000).collect()}
    for own, tile in ((silhouettes.OWN_ROWS, silhouettes.TILE), (7, 25)):  # several groups and tiles
        monkeypatch.setattr(silhouettes, "OWN_ROWS", own)
        monkeypatch.setattr(silhouettes, "TILE", tile)
        got = {r["clustering"]: r for r in silhouettes.euclidean_silhouettes(df, ["u", "v", "w"], names, rows=None).collect()}
        assert set(got) == set(names) and got["d"]["silhouette"] is wanted["d"]["silhouette"] is None
        for name in ("a", "b"):
            assert (got[name]["n_rows"], got[name]["n_sampled"], got[name]["standard_error"]) == (300, 300, 0.0)
            assert got[name]["silhouette"] == pytest.approx(wanted[name]["silhouette"], abs=1e-9)
    assert silhouettes.euclidean_silhouettes(df, ["u"], ["c"], rows=None).first()["n_rows"] == 209
    assert silhouettes.euclidean_silhouettes(df.limit(0), ["u"], ["a"], rows=None).collect() == []
    same = silhouettes.euclidean_silhouettes(df.withColumn("u", F.lit(1.0)), ["u"], ["a"], rows=None).first()
    assert same["silhouette"] == 0.0


def test_both_distances_choose_a_tried_k(spark, sf_dir):
    features = Views(spark, sf_dir).features()
    for distance in ("euclidean", "squared"):
        got = segments.segment_users(features, ks=(2, 3), distance=distance)
        rows = {r["k"]: r for r in got.choices.collect()}
        assert set(rows) == {2, 3} and rows[got.k]["silhouette"] == max(r["silhouette"] for r in rows.values())
    with pytest.raises(ValueError, match="distance"):
        segments.segment_users(features, ks=(2,), distance="other")


def test_moments_and_axes_equal_numpy(spark):
    x, _, _, df = points(spark, 400)
    got = moments.second_moments(df.withColumn("same", F.lit(5)), ["u", "v", "w", "same"])
    assert got.means[:3] == pytest.approx(x.mean(0)) and got.n == 400 and got.scales[3] == 1.0
    assert got.covariance[:3, :3] == pytest.approx(np.cov(x.T, bias=True)) and not got.correlation[3].any()
    values, axes = moments.principal_axes(got.correlation, 2)
    z = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    assert values == pytest.approx(s[:2] ** 2 / 400)
    assert np.abs(axes[:, :3] @ vt[:2].T) == pytest.approx(np.eye(2), abs=1e-6)
    assert all(a.max() >= -a.min() for a in axes)
    empty = moments.second_moments(df.limit(0), ["u", "v"])
    assert empty.n == 0 and not empty.covariance.any()


def test_pca_of_one_column_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (2, 0, None), (3, 1, 4.0)], "user_id int, cluster int, value double")
    rows = {r["user_id"]: r for r in segments.cluster_pca(df).collect()}
    assert [rows[i]["pca1"] for i in (1, 2, 3)] == pytest.approx([0.0, -1.2247449, 1.2247449]) and rows[1]["pca2"] == 0.0


def test_platt_equals_an_unpenalised_fit(spark, sf_dir):
    scored = Views(spark, sf_dir).scored().withColumn("label", F.col("label").cast("double"))
    curve = training.calibrate_platt(scored, "label")
    fit = LogisticRegression(labelCol="label", maxIter=500, tol=1e-12).fit(VectorAssembler(inputCols=["score"], outputCol="features").transform(scored))
    assert (curve.slope, curve.intercept) == pytest.approx((fit.coefficients[0], fit.intercept), rel=1e-4)
    assert curve.steps < 20


def test_platt_of_parted_and_constant_scores(spark):
    parted = spark.createDataFrame([(i / 10, float(i > 5)) for i in range(10)], "score double, churn_30d double")
    got = [r["probability"] for r in training.calibrate_platt(parted, max_steps=8).transform(parted).orderBy("score").collect()]
    assert got == sorted(got) and got[0] < 0.1 and got[-1] > 0.9
    same = spark.createDataFrame([(0.5, float(i < 3)) for i in range(10)], "score double, churn_30d double")
    curve = training.calibrate_platt(same)
    assert np.isfinite(curve.slope) and np.isfinite(curve.intercept)
    assert training.calibrate_platt(same.limit(0)).transform(same).count() == 10
