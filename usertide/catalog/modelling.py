"""Queries for the model table, training, scoring and segments, and for sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from usertide import schema
from usertide.catalog.registry import query, rounded
from usertide.plans import certificates, cleaning, evaluation, model_data, segments, silhouettes, training
from usertide.session import materialize, new_folder
from usertide.sources import tables

FEATURES = ("credits_purchased", "credits_spent", "views", "avg_watch_time_sec", "sessions_7d", "event_count",
            "recency_days", "unique_event_types")
CATEGORIES = ("country", "device", "language", "subscription_type")

MODEL_ROWS = """
SELECT f.* EXCLUDE (signup_date, last_active_date), m.churn_30d FROM features f JOIN metrics m ON f.user_id = m.user_id
"""

SPLIT = f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY churn_30d
    ORDER BY ('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|42'), 1, 12))::BIGINT, user_id)
  <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY churn_30d)) THEN 'test' ELSE 'train' END AS split
FROM ({MODEL_ROWS})
"""


def _rows(v):
    return model_data.join_label(v.features(), v.metrics())


def _prepared(v):
    return model_data.prepare_model_data(v.features(), v.metrics())


@query("model_data", f"""
SELECT user_id, country, device, language, subscription_type, credits_purchased, credits_spent, views,
  round(avg_watch_time_sec, 6) AS avg_watch_time_sec, sessions_7d, event_count, recency_days, unique_event_types,
  churn_30d, split FROM ({SPLIT})
""", ("features", "metrics"))
def _(v):
    return rounded(_prepared(v))


@query("stratified_split", f"SELECT user_id, churn_30d, split FROM ({SPLIT})", ("features", "metrics"))
def _(v):
    return model_data.stratified_split(v.metrics().select("user_id", "churn_30d"))


@query("order_stratified_split", """
SELECT row_id, label, CASE WHEN row_number() OVER (PARTITION BY label
    ORDER BY ('0x' || substr(md5(CAST(row_id AS VARCHAR) || '|7'), 1, 12))::BIGINT, row_id)
  <= round(0.3::DOUBLE * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM scored
""", ("scored",))
def _(v):
    rows = v.scored().select("row_id", "label")
    return model_data.stratified_split(rows, "label", "row_id", test_share=0.3, seed=7)


# Encoded rows in long form, as SQL can't name columns after levels: numbers scaled by the training rows, and a 0/1 row per level of
# a category but the first of the training rows.
def _wide(numbers: str) -> str:
    return f"""
numbers AS (SELECT user_id, churn_30d, split, unnest([{", ".join(f"{{'feature': '{c}', 'x': CAST({c} AS DOUBLE)}}" for c in FEATURES)}], recursive := true) FROM {numbers}),
texts AS (SELECT user_id, churn_30d, split, unnest([{", ".join(f"{{'kind': '{c}', 'level': CAST({c} AS VARCHAR)}}" for c in CATEGORIES)}], recursive := true) FROM {numbers})"""


ENCODED = f"""
rows_ AS ({SPLIT}),{_wide("rows_")},
scale AS (SELECT feature, avg(x) AS mean, coalesce(nullif(stddev_pop(x), 0), 1) AS sd FROM numbers WHERE split = 'train' GROUP BY feature),
levels AS (SELECT kind, level FROM (SELECT kind, level, row_number() OVER (PARTITION BY kind ORDER BY level) AS place
  FROM (SELECT DISTINCT kind, level FROM texts WHERE split = 'train' AND level IS NOT NULL)) WHERE place > 1),
encoded AS (
  SELECT user_id, churn_30d, split, n.feature, (x - mean) / sd AS value FROM numbers n JOIN scale s ON n.feature = s.feature
  UNION ALL
  SELECT user_id, churn_30d, split, l.kind || '_' || l.level, CASE WHEN t.level = l.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  FROM texts t JOIN levels l ON t.kind = l.kind)
"""


def _encoded(part: str) -> str:
    return f"SELECT * FROM (WITH {ENCODED} SELECT user_id, churn_30d, feature, round(value, 6) + 0.0 AS value FROM encoded WHERE split = '{part}')"


def _long(df, keys):
    """All other columns of a wide table as rows (keys..., feature, value)."""
    names = [c for c in df.columns if c not in keys]
    entries = [F.struct(F.lit(c).alias("feature"), (F.round(F.col(schema.quoted(c)).cast("double"), 6) + 0.0).alias("value")) for c in names]
    return df.select(*keys, F.inline(F.array(*entries)))


@query("encoded_train", _encoded("train"), ("features", "metrics"))
def _(v):
    return _long(model_data.encoded_tables(_prepared(v))[0], ["user_id", "churn_30d"])


@query("encoded_test", _encoded("test"), ("features", "metrics"))
def _(v):
    return _long(model_data.encoded_tables(_prepared(v))[1], ["user_id", "churn_30d"])


@query("class_weights", """
SELECT churn_30d, count(*) AS n, round((SELECT count(*) FROM metrics) / (2.0::DOUBLE * count(*)), 6) AS weight
FROM metrics GROUP BY churn_30d
""", ("metrics",))
def _(v):
    return rounded(model_data.class_weights(v.metrics()))


@query("one_hot", f"""
SELECT * FROM (WITH t AS (SELECT user_id, unnest([{", ".join(f"{{'kind': '{c}', 'level': {c}}}" for c in CATEGORIES)}], recursive := true) FROM app_users),
l AS (SELECT kind, level, row_number() OVER (PARTITION BY kind ORDER BY level) AS place FROM (SELECT DISTINCT kind, level FROM t))
SELECT user_id, l.kind || '_' || l.level AS feature, CASE WHEN t.level = l.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM t JOIN l ON t.kind = l.kind AND place > 1)
""", ("app_users",))
def _(v):
    users = v.users()
    columns = model_data.dummy_columns(model_data.fit_levels(users, list(CATEGORIES)))
    return _long(users.select("user_id", *[c.alias(name) for name, c in columns.items()]), ["user_id"])


@query("standardized", "SELECT user_id, " + ", ".join(
    f"""round(({c} - (SELECT avg({c}) FROM features)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1
      ELSE stddev_pop({c}) END FROM features), 6) + 0.0 AS {c}""" for c in FEATURES) + " FROM features", ("features",))
def _(v):
    rows = v.features()
    columns = model_data.scaled_columns(model_data.fit_scaler(rows, FEATURES))
    return rounded(rows.select("user_id", *[c.alias(name) for name, c in columns.items()]))


@query("logistic_coefficients")
def _(v):
    return training.train_churn_models(_prepared(v), only=("logreg",)).models["logreg"].importances()


@query("forest_importances")
def _(v):
    trained = training.train_churn_models(_prepared(v), only=("random_forest",))
    return trained.models["random_forest"].importances()


@query("model_comparison")
def _(v):
    return training.train_churn_models(_prepared(v)).comparison


@query("score_users")
def _(v):
    """Train, store, load and score every user of the model table."""
    data = _prepared(v)
    folder = new_folder(v.spark, "model")
    training.train_churn_models(data, only=("logreg",)).models["logreg"].save(folder)
    model = training.load_model(v.spark, folder)
    return training.score_users(model, data.drop("split"), "2024-02-01T00:00:00")[0]


@query("logistic_gradient", f"""
SELECT * FROM (WITH {ENCODED},
w AS (SELECT churn_30d AS y, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE)) AS weight
  FROM rows_ WHERE split = 'train' GROUP BY churn_30d),
total AS (SELECT sum(n * weight) AS t FROM w)
SELECT feature, round(sum(weight * (0.5::DOUBLE - y) * value) / max(t), 6) + 0.0 AS gradient_at_zero, 0.0::DOUBLE AS gradient
FROM encoded JOIN w ON churn_30d = y, total WHERE split = 'train' GROUP BY feature
UNION ALL SELECT '(intercept)', round(sum(n * weight * (0.5::DOUBLE - y)) / max(t), 6) + 0.0, 0.0::DOUBLE FROM w, total)
""", ("features", "metrics"))
def _(v):
    """The gradient of the fitted model's loss vanishes; that at zero is known from the rows alone."""
    data = materialize(_prepared(v))
    model = training.train_churn_models(data, only=("logreg",)).models["logreg"]
    found = certificates.logistic_gradient(model, data.filter("split = 'train'"))
    small = F.round("gradient", 4) + 0.0
    return found.select("feature", (F.round("gradient_at_zero", 6) + 0.0).alias("gradient_at_zero"), small.alias("gradient"))


@query("logistic_score_check", f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM ({MODEL_ROWS})", ("features", "metrics"))
def _(v):
    data = materialize(_prepared(v))
    model = training.train_churn_models(data, only=("logreg",)).models["logreg"]
    return certificates.logistic_score_check(model, data)


def _forest(v, trees=20, depth=8):
    """A stored forest, its path and the prepared rows."""
    data = materialize(_prepared(v))
    train = data.filter("split = 'train'")
    model = training.fit_forest(train, model_data.fit_encoding(train), trees=trees, depth=depth)
    path = new_folder(v.spark, "forest")
    model.save(path)
    return data, model, path


@query("forest_score_check", f"""
SELECT split, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_outside FROM ({SPLIT}) GROUP BY split
""", ("features", "metrics"))
def _(v):
    """Scores of all users, from MLlib and from the stored trees walked by joins."""
    data, model, path = _forest(v)
    both = certificates.forest_check(model, path, data).join(data.select("user_id", "split"), "user_id")
    far = F.coalesce(F.abs(F.col("score") - F.col("walked")) > certificates.SAME_SCORE, F.lit(True))
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(far).alias("n_different"), F.count_if(~F.col("walked").between(0, 1)).alias("n_outside")
    )


@query("forest_importance_check", f"""
SELECT * FROM (WITH {ENCODED} SELECT DISTINCT feature, 0.0::DOUBLE AS difference, 1.0::DOUBLE AS total FROM encoded)
""", ("features", "metrics"))
def _(v):
    """Importances from the stored trees against MLlib's; together they are 1."""
    _, model, path = _forest(v)
    walked = certificates.node_importances(certificates.forest_nodes(v.spark, path), model.features)
    both = materialize(walked.join(model.importances().withColumnRenamed("importance", "given"), "feature"))
    total = both.agg(F.sum("importance")).first()[0]
    return both.select("feature", (F.round(F.abs(F.col("importance") - F.col("given")), 9) + 0.0).alias("difference"), F.lit(round(total, 9)).alias("total"))


@query("forest_evaluation_check", f"""
SELECT count(*) FILTER (split = 'test') AS support, CAST(0.0 AS DOUBLE) AS auc_difference, TRUE AS same_cells, TRUE AS better_than_chance FROM ({SPLIT})
""", ("features", "metrics"))
def _(v):
    """AUC and confusion counts of the test rows, from walked scores by a plain pair count and by the ranking operators."""
    data, model, path = _forest(v)
    test = data.filter("split = 'test'")
    walked = certificates.walk_forest(certificates.assembled(model, test), certificates.forest_nodes(v.spark, path))
    scored = materialize(walked.join(test.select("user_id", F.col("churn_30d").alias("label")), "user_id"))
    given = materialize(model.score(test).select("user_id", F.col("churn_30d").alias("label"), F.round("score", 12).alias("score")))
    plain = scored.withColumn("score", F.round("score", 12))
    cut = 0.5
    a, b = evaluation.evaluate_at(plain, cut).first(), evaluation.evaluate_at(given, cut).first()
    cells = ("tn", "fp", "fn", "tp")
    row = (sum(a[c] for c in cells), round(abs(a["auc"] - b["auc"]), 9), all(a[c] == b[c] for c in cells), a["auc"] > 0.5)
    return v.spark.createDataFrame([row], "support long, auc_difference double, same_cells boolean, better_than_chance boolean")


@query("calibrated_scores", """
SELECT * FROM (WITH RECURSIVE p AS (SELECT score AS x, sum(label)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM scored GROUP BY score),
fit(step, a, b) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT step + 1, a - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01), b - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01)
  FROM (SELECT step, a, b, sum(e) AS g0, sum(e * x) AS g1, sum(h) AS h00, sum(h * x) AS h01, sum(h * x * x) AS h11
    FROM (SELECT step, a, b, x, n / (1 + exp(-(a * x + b))) - pos AS e, n / (1 + exp(-(a * x + b))) / (1 + exp(a * x + b)) AS h
      FROM fit, p WHERE step < 25) GROUP BY step, a, b))
SELECT row_id, score, round(1 / (1 + exp(-(a * score + b))), 6) AS platt FROM scored, fit WHERE step = 25)
""", ("scored",))
def _(v):
    """The logistic calibration curve at every score; the twin is a Newton solve over the same scores."""
    scored = v.scored().withColumn("label", F.col("label").cast("double"))
    curve = training.calibrate_platt(scored, "label")
    return curve.transform(scored).select("row_id", "score", F.round("probability", 6).alias("platt"))


@query("isotonic_scores", """
SELECT * FROM (WITH p AS (SELECT score, sum(label) AS s, count(*) AS n FROM scored GROUP BY score),
c AS (SELECT score, row_number() OVER (ORDER BY score) AS i, sum(s) OVER (ORDER BY score) AS cs,
  sum(n) OVER (ORDER BY score) AS cn, s, n FROM p),
m AS (SELECT a.i AS j, b.i AS k, CAST(b.cs - a.cs + a.s AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
  FROM c a JOIN c b ON a.i <= b.i),
lowest AS (SELECT j, k AS i, min(mean) OVER (PARTITION BY j ORDER BY k DESC) AS low FROM m),
fit AS (SELECT i, max(low) AS isotonic FROM lowest GROUP BY i)
SELECT row_id, round(isotonic, 6) AS isotonic FROM scored JOIN c ON scored.score = c.score JOIN fit ON fit.i = c.i)
""", ("scored",))
def _(v):
    """The isotonic curve at the scores it was fitted on; the twin is the min-max formula."""
    scored = v.scored().withColumn("label", F.col("label").cast("double"))
    curve = training.calibrate_isotonic(scored, "label")
    return rounded(curve.transform(scored).select("row_id", F.col("calibrated").alias("isotonic")))


# Centroids for the queries below: the mean user of each subscription type, in alphabetical order.
CENTROID_COLUMNS = ("credits_purchased", "credits_spent", "views")
MEANS = "SELECT subscription_type, " + ", ".join(f"avg({c}) AS {c}" for c in CENTROID_COLUMNS) + \
    " FROM features GROUP BY subscription_type"
ASSIGNED = f"""
SELECT f.*, (SELECT CAST(arg_min(i, (d, i)) AS INTEGER) FROM (
    SELECT row_number() OVER (ORDER BY m.subscription_type) - 1 AS i,
      {" + ".join(f"(f.{c} - m.{c}) ** 2" for c in CENTROID_COLUMNS)} AS d FROM ({MEANS}) m)) AS cluster
FROM features f
"""


def _assigned(v):
    rows = v.features()
    # One row per subscription type.
    means = rows.groupBy("subscription_type").agg(*[F.avg(c).alias(c) for c in CENTROID_COLUMNS]).collect()
    centroids = [[m[c] for c in CENTROID_COLUMNS] for m in sorted(means, key=lambda m: m["subscription_type"])]
    return segments.nearest_centroid(rows, CENTROID_COLUMNS, centroids)


@query("nearest_centroid", f"SELECT user_id, cluster FROM ({ASSIGNED})", ("features",))
def _(v):
    return _assigned(v).select("user_id", "cluster")


@query("cluster_summary", "SELECT cluster, " + ", ".join(f"round(avg({c}), 2) AS {c}" for c in segments.VARIABLES) +
       f""", count(*) AS user_count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM features), 2) AS pct_total
FROM ({ASSIGNED}) GROUP BY cluster""", ("features",))
def _(v):
    return segments.cluster_summary(_assigned(v), segments.VARIABLES)


@query("cluster_boxplots", f"""
SELECT * FROM (
WITH r AS (SELECT cluster, name AS metric, value FROM (UNPIVOT (SELECT cluster, {", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in segments.PROFILE_VARIABLES)} FROM ({ASSIGNED}))
    ON {", ".join(segments.PROFILE_VARIABLES)} INTO NAME name VALUE value)),
q AS (SELECT cluster, metric, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
    quantile_cont(value, 0.75) AS p75 FROM r GROUP BY 1, 2),
j AS (SELECT r.cluster, r.metric, value, p25, p50, p75,
    value BETWEEN p25 - (p75 - p25) * 1.5::DOUBLE AND p75 + (p75 - p25) * 1.5::DOUBLE AS inside
  FROM r JOIN q ON r.cluster = q.cluster AND r.metric = q.metric)
SELECT cluster, metric, count(*) AS n, round(max(p25), 6) AS p25, round(max(p50), 6) AS p50, round(max(p75), 6) AS p75,
  round(min(value) FILTER (inside), 6) AS whisker_low, round(max(value) FILTER (inside), 6) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY 1, 2)
""", ("features",))
def _(v):
    # The clusters are read several times, so they are stored like any finished segmentation.
    return rounded(segments.cluster_boxplots(materialize(_assigned(v))))


@query("kmeans_choices")
def _(v):
    return segments.segment_users(v.features()).choices


@query("user_clusters")
def _(v):
    return segments.segment_users(v.features()).users.select("user_id", "cluster")


VARYING = " + ".join(f"CASE WHEN stddev_pop({c}) > 0 THEN 1 ELSE 0 END" for c in segments.VARIABLES)


@query("kmeans_check", f"""
SELECT CAST(k AS INTEGER) AS k, n_users, CAST(k AS INTEGER) AS n_clusters, CAST(0 AS BIGINT) AS n_strays, TRUE AS centred, TRUE AS agrees,
  round(CAST(n_users * varying AS DOUBLE), 3) AS total, TRUE AS split
FROM (SELECT count(*) AS n_users, {VARYING} AS varying FROM features), range(2, 10) AS tried(k)
""", ("features",))
def _(v):
    """Lloyd's conditions for every tried k, over all users."""
    found = certificates.kmeans_check(segments.segment_users(v.features()))
    return found.drop("inertia").withColumn("total", F.round("total", 3))


# Silhouettes of the given assignment, with the same sampled users: the smallest hashes.
SILHOUETTE = f"""
SELECT * FROM (WITH a AS (SELECT user_id, cluster, {", ".join(f"{c}::DOUBLE AS {c}" for c in CENTROID_COLUMNS)} FROM ({ASSIGNED})),
s AS (SELECT * FROM a ORDER BY ('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|42'), 1, 12))::BIGINT, user_id LIMIT {silhouettes.SAMPLED_ROWS}),
d AS (SELECT s.user_id, s.cluster AS own, a.cluster AS other, count(*) AS n,
    sum(sqrt({" + ".join(f"(s.{c} - a.{c}) ** 2" for c in CENTROID_COLUMNS)})) AS total FROM s, a GROUP BY 1, 2, 3),
e AS (SELECT user_id, max(total / greatest(n - 1, 1)) FILTER (own = other) AS inside, max(n) FILTER (own = other) AS n,
    min(total / n) FILTER (own <> other) AS outside FROM d GROUP BY user_id),
f AS (SELECT CASE WHEN n = 1 THEN 0.0::DOUBLE ELSE (outside - inside) / greatest(outside, inside) END AS s FROM e)
SELECT 'cluster' AS clustering, (SELECT count(*) FROM a) AS n_rows, count(*) AS n_sampled, round(avg(s), 6) AS silhouette,
  round(stddev_samp(s) / sqrt(count(*)) * sqrt(greatest(0.0::DOUBLE, 1 - count(*) / (SELECT count(*) FROM a)::DOUBLE)), 6) + 0.0 AS standard_error FROM f)
"""


@query("euclidean_silhouette", SILHOUETTE, ("features",))
def _(v):
    return rounded(silhouettes.euclidean_silhouettes(_assigned(v), CENTROID_COLUMNS, ["cluster"]))


# Principal components by repeated squaring: a symmetric matrix multiplied by itself tends to its first component.
_Z = ", ".join(f"(coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / coalesce(nullif(stddev_pop(coalesce({c}, 0)) OVER (), 0), 1)" for c in FEATURES)
_SQUARED = """list_transform(a, lambda r: list_transform(a, lambda q: list_dot_product(r, q)
    / list_sum(list_transform(a, lambda z: list_dot_product(z, z)))))"""


def _component(matrix: str, squares: str) -> str:
    """Recursive squares of a matrix and its first unit vector, pointing to its largest entry."""
    return f"""
{squares}(step, a) AS (SELECT 0, c FROM {matrix} UNION ALL SELECT step + 1, {_SQUARED} FROM {squares} WHERE step < 40),
{squares}_row AS (SELECT r FROM (SELECT unnest(a) AS r FROM {squares} WHERE step = 40) ORDER BY list_dot_product(r, r) DESC LIMIT 1),
{squares}_axis AS (SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r)) * CASE WHEN list_max(r) >= -list_min(r) THEN 1 ELSE -1 END) AS axis
  FROM {squares}_row)"""


@query("cluster_pca", f"""
SELECT * FROM (WITH RECURSIVE z AS (SELECT user_id, cluster, [{_Z}]::DOUBLE[] AS z FROM ({ASSIGNED})),
m AS (SELECT [{", ".join("[" + ", ".join(f"avg(z[{i}] * z[{j}])" for j in range(1, 9)) + "]" for i in range(1, 9))}]::DOUBLE[][] AS c FROM z),
{_component("m", "first")},
rest AS (SELECT list_transform(range(1, 9), lambda i: list_transform(range(1, 9), lambda j: c[i][j] - axis[i] * axis[j]
    * list_dot_product(axis, list_transform(c, lambda r: list_dot_product(r, axis))))) AS c FROM m, first_axis),
{_component("rest", "second")}
SELECT user_id, cluster, round(list_dot_product(z, f.axis), 4) + 0.0 AS pca1, round(list_dot_product(z, s.axis), 4) + 0.0 AS pca2
FROM z, first_axis f, second_axis s)
""", ("features",))
def _(v):
    found = segments.cluster_pca(materialize(_assigned(v)))
    return found.select("user_id", "cluster", *[(F.round(c, 4) + 0.0).alias(c) for c in ("pca1", "pca2")])


@query("csv_round_trip_users", """
SELECT CAST(user_id AS VARCHAR) AS user_id, TRY_CAST(signup_date AS TIMESTAMP) AS signup_date,
  TRY_CAST(last_active_date AS TIMESTAMP) AS last_active_date, country, CAST(churned_30d AS VARCHAR) AS churned_30d
FROM raw_users
""", ("raw_users",))
def _(v):
    path = new_folder(v.spark, "users-csv")
    tables.write_csv(v.raw_users(), path)
    return tables.read_csv(v.spark, path, schema.USERS)


@query("csv_round_trip_events", """
SELECT event_uuid, CAST(user_id AS VARCHAR) AS user_id, event_type, event_timestamp, created_at, received_at, session_id
FROM app_events
""", ("app_events",))
def _(v):
    path = new_folder(v.spark, "events-csv")
    tables.write_csv(v.events(), path)
    return tables.read_csv(v.spark, path, schema.EVENTS)


@query("label_scan", "SELECT label, count(*) AS n FROM scored GROUP BY label", ("scored",))
def _(v):
    path = new_folder(v.spark, "labels-csv")
    tables.write_csv(v.scored().select("label"), path)
    return tables.read_labels(v.spark, path).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("clean_and_report_tables", """
SELECT * FROM (WITH r AS (SELECT user_id, TRY_CAST(signup_date AS TIMESTAMP) AS s, TRY_CAST(last_active_date AS TIMESTAMP) AS l
  FROM raw_users)
SELECT 'rows' AS metric, count(DISTINCT user_id) AS value FROM r
UNION ALL SELECT 'duplicates_removed', count(user_id) - count(DISTINCT user_id) FROM r
UNION ALL SELECT 'dropped_missing_user_id', count(*) FILTER (user_id IS NULL) FROM r
UNION ALL SELECT 'null_user_id', count(*) FILTER (user_id IS NULL) FROM r
UNION ALL SELECT 'null_signup_date', count(*) FILTER (s IS NULL) FROM r
UNION ALL SELECT 'null_last_active_date', count(*) FILTER (l IS NULL) FROM r
UNION ALL SELECT 'temporal_inconsistencies', count(*) FILTER (CAST(s AS DATE) > CAST(l AS DATE)) FROM r)
""", ("raw_users",))
def _(v):
    """Write the clean users with their report, read both back."""
    base = new_folder(v.spark, "clean")
    written = tables.cleaned_to(cleaning.clean_users, v.raw_users(), base, "users")
    report = tables.read_report(v.spark, f"{base}/users_qa")
    rows = written.agg(F.lit("rows").alias("metric"), F.count(F.lit(1)).alias("value"))
    return rows.unionByName(report)
