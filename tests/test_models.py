"""Model fits against small independent solutions, storage and calibration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from usertide.catalog.views import Views
from usertide.plans import model_data, segments, training


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    v = Views(spark, "/root/testdata/sf0.01")
    return model_data.prepare_model_data(v.features(), v.metrics()).cache()


@pytest.fixture(scope="module")
def trained(data):
    return training.train_churn_models(data, trees=10, depth=5)


def newton_logistic(x, y, weight, penalty_scale=1.0, steps=60):
    """Minimise sum(weight x log-loss) + |b|^2 / 2, intercept free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([penalty_scale] * x.shape[1] + [0.0])
    beta = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = x1.T @ (weight * (p - y)) + ridge @ beta
        hessian = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + ridge
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_equals_newton(trained, data):
    train = data.filter("split = 'train'")
    encoding = model_data.fit_encoding(train)
    table = encoding.apply(train).toPandas()
    y = table.churn_30d.to_numpy(dtype=float)
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    want = newton_logistic(table[encoding.features].to_numpy(dtype=float), y, weight)
    model = trained.models["logreg"]
    assert model.features == encoding.features
    got = model.pipeline.stages[-1].coefficients.toArray()
    assert got == pytest.approx(want[:-1], abs=2e-3)
    importances = model.importances().collect()
    sizes = [abs(r["importance"]) for r in importances]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) == len(encoding.features)


def test_scores_follow_from_coefficients(trained, data):
    model = trained.models["logreg"]
    encoding = model_data.fit_encoding(data.filter("split = 'train'"))
    test = data.filter("split = 'test'")
    table = encoding.apply(test).toPandas().set_index("user_id").sort_index()
    fitted = model.pipeline.stages[-1]
    margin = table[encoding.features].to_numpy(dtype=float) @ fitted.coefficients.toArray() + fitted.intercept
    got = model.score(test).toPandas().set_index("user_id").sort_index().score
    assert list(got) == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-9)


def test_comparison_has_one_row_per_model(trained):
    rows = {r["model"]: r for r in trained.comparison.collect()}
    assert set(rows) == {"logreg", "random_forest"}
    for name, row in rows.items():
        assert 0 <= row["auc"] <= 1 and row["recall"] >= 0.6 and row["precision"] >= 0.15
        assert row["threshold"] == trained.models[name].threshold


def test_forest_importances_add_to_one(trained):
    total = trained.models["random_forest"].importances().agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)


def test_stored_model_scores_the_same(spark, trained, data, tmp_path):
    model = trained.models["logreg"]
    model.save(str(tmp_path / "m"))
    loaded = training.load_model(spark, str(tmp_path / "m"))
    assert (loaded.threshold, loaded.features, loaded.name) == (model.threshold, model.features, model.name)
    a, top = training.score_users(model, data, "2024-02-01T00:00:00", topn=5)
    b, _ = training.score_users(loaded, data, "2024-02-01T00:00:00", topn=0)
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.columns == ["user_id", "proba_churn", "pred_churn", "threshold_used", "model_file", "scored_at_utc"]
    assert top.count() == 5


def test_absent_columns_count_as_zero(trained, data):
    model = trained.models["logreg"]
    filled = data.withColumn("views", F.lit(0)).withColumn("country", F.lit(None).cast("string"))
    want = model.score(filled).select("user_id", "score").collect()
    got = model.score(data.drop("views", "country")).select("user_id", "score").collect()
    assert sorted(got) == sorted(want)


def test_folder_without_column_lists_is_no_model(spark, trained, tmp_path):
    trained.models["logreg"].save(str(tmp_path / "m"))
    spark.createDataFrame([('{"name": "x"}',)], "value string").write.mode("overwrite").text(str(tmp_path / "m/metadata"))
    with pytest.raises(ValueError, match="no stored model"):
        training.load_model(spark, str(tmp_path / "m"))


def test_scoring_needs_the_id(trained, data):
    with pytest.raises(ValueError, match="user_id"):
        training.score_users(trained.models["logreg"], data.drop("user_id"), "x")


def test_odd_level_names_survive_storage(spark, tmp_path):
    rows = [(i, ["it's", "a\\b", "plain", 'q"x'][i % 4], float(i % 7), int(i % 3 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id int, kind string, v double, churn_30d int")
    model = training.fit_logistic(df, model_data.fit_encoding(df))
    model.save(str(tmp_path / "odd"))
    again = training.load_model(spark, str(tmp_path / "odd"))
    assert sorted(model.score(df).collect()) == sorted(again.score(df).collect())


def test_isotonic_is_monotone_and_platt_is_a_probability(spark, sf_dir):
    scored = Views(spark, sf_dir).scored().withColumn("label", F.col("label").cast("double"))
    curve = training.calibrate_isotonic(scored, "label").transform(scored).orderBy("score").toPandas()
    assert (np.diff(curve.calibrated) >= -1e-12).all()
    platt = training.calibrate_platt(scored, "label").transform(scored)
    row = platt.select(F.min("probability"), F.max("probability")).first()
    assert 0 < row[0] <= row[1] < 1


def test_segments(spark, sf_dir):
    v = Views(spark, "/root/testdata/sf0.01")
    found = segments.segment_users(v.features(), ks=range(2, 5))
    choices = found.choices.orderBy("k").collect()
    inertia = [r["inertia"] for r in choices]
    assert inertia == sorted(inertia, reverse=True)
    best = max(choices, key=lambda r: (r["silhouette"], -r["k"]))
    assert found.k == best["k"]
    sizes = {r["cluster"]: r["count"] for r in found.users.groupBy("cluster").count().collect()}
    assert set(sizes) == set(range(found.k)) and sum(sizes.values()) == v.users().count()
    means = [r["m"] for r in found.users.groupBy("cluster").agg(F.avg("credits_purchased").alias("m"))
             .orderBy("cluster").collect()]
    assert means == sorted(means, reverse=True)
    points = segments.cluster_pca(found.users).toPandas()
    assert abs(np.corrcoef(points.pca1, points.pca2)[0, 1]) < 1e-6
    assert points.pca1.var() >= points.pca2.var()
    assert abs(points.pca1.mean()) < 1e-9


def test_segments_need_a_variable(spark):
    with pytest.raises(ValueError, match="none of"):
        segments.segment_users(spark.createDataFrame([(1, 2)], "user_id int, other int"))


def test_forest_rows_keep_their_nodes_and_trees_stay_the_same(spark, monkeypatch):
    rows = [(i, i % 7 * 0.5, i * 37 % 101 / 10.0, "ab"[i % 2], int(i * 29 % 13 > 6)) for i in range(400)]
    train = spark.createDataFrame(rows, "user_id long, x double, y double, kind string, churn_30d int").repartition(3, "user_id").cache()
    encoding = model_data.fit_encoding(train)
    kept = training.fit_forest(train, encoding, trees=7, depth=30).pipeline.stages[-1]
    assert kept.getCacheNodeIds()
    plain = training.RandomForestClassifier
    monkeypatch.setattr(training, "RandomForestClassifier", lambda **k: plain(**k | {"cacheNodeIds": False}))
    walked = training.fit_forest(train, encoding, trees=7, depth=30).pipeline.stages[-1]
    trees = lambda m: m.toDebugString.split("\n")[1:]
    assert trees(kept) == trees(walked) and len(trees(kept)) > 100
