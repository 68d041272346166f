"""Churn models: fit, choose a threshold, evaluate, store, score, calibrate."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.operators.ranking import present
from usertide.plans.evaluation import compare_models, evaluate_at, pick_threshold
from usertide.plans.model_data import Encoding, class_weights, fit_encoding
from usertide.plans.scoring import label_scores, top_scores
from usertide.schema import quoted, require_columns
from usertide.session import materialize

LABEL = "churn_30d"
# Columns that describe the outcome and must not reach a model.
OUTCOME_COLUMNS = ("churn_30d", "events_D7", "events_D30")
DEFAULT_THRESHOLD = 0.5
# Beginning of the columns that pipelines add; model columns can have any other name.
OWN = "__model_"
OWN_COLUMNS = {
    "featuresCol": f"{OWN}features",
    "weightCol": f"{OWN}weight",
    "predictionCol": f"{OWN}prediction",
    "probabilityCol": f"{OWN}probability",
    "rawPredictionCol": f"{OWN}raw",
}


@dataclass(frozen=True)
class ChurnModel:
    """A fitted pipeline from raw model columns to a probability, with its threshold, features and inputs."""

    name: str
    pipeline: PipelineModel
    features: list[str]
    numbers: list[str]
    categories: list[str]
    threshold: float = DEFAULT_THRESHOLD

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score``, the probability of churn.

        A model column that ``df`` lacks counts as 0, or as no known category.  ``score`` replaces a column
        of that name.
        """
        absent = {c: F.lit(0) for c in self.numbers if c not in df.columns}
        absent |= {c: F.lit(None).cast("string") for c in self.categories if c not in df.columns}
        scored = self.pipeline.transform(df.withColumns(absent) if absent else df)
        kept = [F.col(quoted(c)) for c in df.columns if c != "score"]
        return scored.select(*kept, F.element_at(vector_to_array(f"{OWN}probability"), 2).alias("score"))

    def importances(self) -> DataFrame:
        """(feature, importance), by absolute value descending: coefficients, or Gini shares of a forest."""
        fitted = self.pipeline.stages[-1]
        values = fitted.coefficients if hasattr(fitted, "coefficients") else fitted.featureImportances
        spark = SparkSession.getActiveSession()
        rows = [(name, float(value)) for name, value in zip(self.features, values.toArray())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.abs("importance").desc(), "feature"
        )

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        metadata = json.dumps({k: v for k, v in vars(self).items() if k != "pipeline"})
        spark.createDataFrame([(metadata,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata"
        )


def load_model(spark: SparkSession, path: str) -> ChurnModel:
    """Read a stored model; the threshold falls back to 0.5, a missing list of columns is an error."""
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    missing = {"features", "numbers", "categories"} - set(metadata)
    if missing:
        raise ValueError(f"{path} is no stored model: no {', '.join(sorted(missing))}")
    return ChurnModel(pipeline=PipelineModel.load(f"{path}/pipeline"), **{"name": "model", **metadata})


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _encoder_stages(encoding: Encoding) -> list:
    """Encoding as pipeline stages, so it is stored with the model."""
    terms = [f"(CAST({quoted(c)} AS DOUBLE) - ({mean!r}D)) / {std!r}D" for c, (mean, std) in encoding.scaler.items()]
    terms += [
        f"CASE WHEN {quoted(c)} = {_quoted(level)} THEN 1.0D ELSE 0.0D END"
        for c, levels in encoding.levels.items()
        for level in levels[1:]
    ]
    names = [f"{OWN}x{i}" for i in range(len(terms))]
    statement = "SELECT *, " + ", ".join(f"{t} AS {n}" for t, n in zip(terms, names)) + " FROM __THIS__"
    return [SQLTransformer(statement=statement), VectorAssembler(inputCols=names, outputCol=f"{OWN}features")]


def _weighted(train: DataFrame, label: str) -> tuple[DataFrame, float]:
    """Labelled training rows with balanced class weights, and the sum of the weights; there are few labels."""
    train = train.filter(F.col(label).isNotNull())
    rows = class_weights(train, label).collect()
    weight = F.lit(None).cast("double")
    for row in rows:
        weight = F.when(F.col(label) == row[label], row["weight"]).otherwise(weight)
    return train.withColumn(f"{OWN}weight", weight), sum(r["n"] * r["weight"] for r in rows)


def _fit(name: str, train: DataFrame, encoding: Encoding, classifier: Estimator) -> ChurnModel:
    pipeline = Pipeline(stages=[*_encoder_stages(encoding), classifier]).fit(train)
    return ChurnModel(name, pipeline, encoding.features, list(encoding.scaler), list(encoding.levels))


def fit_logistic(
    train: DataFrame, encoding: Encoding, label: str = LABEL, strength: float = 1.0, max_iter: int = 1000
) -> ChurnModel:
    """Balanced logistic regression with an L2 penalty; ``strength`` is the weight of the data against it."""
    weighted, total = _weighted(train, label)
    classifier = LogisticRegression(
        labelCol=label,
        **OWN_COLUMNS,
        regParam=1.0 / (strength * total),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
    )
    return _fit("logreg", weighted, encoding, classifier)


def fit_forest(
    train: DataFrame, encoding: Encoding, label: str = LABEL, trees: int = 400, depth: int = 30, seed: int = 42
) -> ChurnModel:
    """Balanced random forest; 30 is the greatest depth that MLlib allows."""
    weighted, _ = _weighted(train, label)
    classifier = RandomForestClassifier(
        labelCol=label,
        **OWN_COLUMNS,
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        seed=seed,
        # Rows keep their node of each tree between levels instead of walking every tree from its root again.
        cacheNodeIds=True,
    )
    return _fit("random_forest", weighted, encoding, classifier)


@dataclass(frozen=True)
class Trained:
    models: dict[str, ChurnModel]
    test_scores: dict[str, DataFrame]
    comparison: DataFrame


def with_threshold(
    model: ChurnModel, scored: DataFrame, label: str = LABEL, min_recall: float = 0.60, min_precision: float = 0.15
) -> ChurnModel:
    """The model with the threshold its test scores ask for."""
    chosen = pick_threshold(scored, min_recall, min_precision, label).first()["threshold"]
    return replace(model, threshold=DEFAULT_THRESHOLD if chosen is None else chosen)


def train_churn_models(
    data: DataFrame,
    label: str = LABEL,
    trees: int = 400,
    depth: int = 30,
    seed: int = 42,
    compat: bool = False,
    only: tuple[str, ...] = ("logreg", "random_forest"),
) -> Trained:
    """Fit the models on the 'train' rows of a prepared table and evaluate them on its 'test' rows.

    Scaling is fitted on the training rows; ``compat`` fits it on all rows.
    """
    require_columns(data, ["user_id", label, "split"], "model data")
    stored = materialize(data, spread_by="user_id")
    train, test = stored.filter("split = 'train'"), stored.filter("split = 'test'")
    encoding = fit_encoding(stored if compat else train)
    fits = {
        "logreg": lambda: fit_logistic(train, encoding, label),
        "random_forest": lambda: fit_forest(train, encoding, label, trees, depth, seed),
    }
    models, test_scores, results = {}, {}, {}
    for name in only:
        model = fits[name]()
        # Several passes read the test scores; the model runs over them once.
        scored = materialize(model.score(test).select("user_id", label, "score"))
        models[name] = with_threshold(model, scored, label)
        test_scores[name] = scored
        results[name] = evaluate_at(scored, models[name].threshold, label)
    return Trained(models, test_scores, compare_models(results))


def score_users(
    model: ChurnModel, data: DataFrame, scored_at: str, id_col: str = "user_id", topn: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Scores, predicted labels and scoring details per user, and the ``topn`` highest (0 = none)."""
    require_columns(data, [id_col], "data")
    scored = model.score(data.drop(*OUTCOME_COLUMNS)).select(id_col, F.col("score").alias("proba_churn"))
    labelled = label_scores(scored, model.threshold, model.name, scored_at, "proba_churn")
    return labelled, top_scores(labelled, topn, "proba_churn", id_col)


@dataclass(frozen=True)
class PlattCurve:
    """The logistic curve 1 / (1 + exp(-(slope x score + intercept)))."""

    slope: float
    intercept: float
    score: str
    steps: int

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability``, which replaces a column of that name; rows without a score are left out."""
        margin = F.lit(self.slope) * F.col(quoted(self.score)) + F.lit(self.intercept)
        return df.filter(present(F.col(quoted(self.score))).isNotNull()).withColumn("probability", 1 / (1 + F.exp(-margin)))


def calibrate_platt(scored: DataFrame, label: str = LABEL, score: str = "score", max_steps: int = 50) -> PlattCurve:
    """Logistic curve from score to probability by Newton steps on the two parameters.

    The rows are reduced once to a stored row per distinct score; every step is one aggregate of six sums over those.
    A step that doesn't lower the loss is halved.  Rows without a score or label don't count.  Scores that part the
    labels perfectly have no best curve: the steps then end at ``max_steps`` or where the curve is flat.
    """
    known = scored.filter(present(F.col(quoted(score))).isNotNull() & F.col(quoted(label)).isNotNull())
    rows = known.groupBy(F.col(quoted(score)).cast("double").alias("x"))
    points = materialize(rows.agg(F.sum(F.col(quoted(label)).cast("double")).alias("pos"), F.count(F.lit(1)).alias("n")))

    def sums(slope: float, intercept: float):
        margin = F.lit(slope) * F.col("x") + F.lit(intercept)
        p = 1 / (1 + F.exp(-margin))
        # log(1 + exp(m)) without overflow.
        loss = F.col("n") * (F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))) - F.col("pos") * margin
        off, bend = F.col("n") * p - F.col("pos"), F.col("n") * p * (1 - p)
        terms = {"loss": loss, "g0": off, "g1": off * F.col("x"), "h00": bend, "h01": bend * F.col("x"), "h11": bend * F.col("x") ** 2}
        return points.agg(*[F.coalesce(F.sum(t), F.lit(0.0)).alias(name) for name, t in terms.items()]).first()

    slope = intercept = 0.0
    now, steps = sums(slope, intercept), 0
    while steps < max_steps:
        steps += 1
        determinant = now["h00"] * now["h11"] - now["h01"] ** 2
        if determinant <= 1e-12 * max(1e-300, now["h00"] * now["h11"]):
            break
        move_1 = (now["h00"] * now["g1"] - now["h01"] * now["g0"]) / determinant
        move_0 = (now["h11"] * now["g0"] - now["h01"] * now["g1"]) / determinant
        share = 1.0
        while (then := sums(slope - share * move_1, intercept - share * move_0))["loss"] > now["loss"] + 1e-9 * abs(now["loss"]) and share > 1e-6:
            share /= 2
        slope, intercept, now = slope - share * move_1, intercept - share * move_0, then
        if max(abs(move_0), abs(move_1)) <= 1e-10 * max(1.0, abs(slope), abs(intercept)):
            break
    return PlattCurve(slope, intercept, score, steps)


def calibrate_isotonic(scored: DataFrame, label: str = LABEL, score: str = "score"):
    """Non-decreasing step curve from score to probability; ``transform`` adds ``calibrated``.

    Fitted on one weighted row per distinct score, which gives the same curve as the single rows.
    """
    known = scored.filter(present(F.col(score)).isNotNull() & F.col(label).isNotNull())
    points = known.groupBy(score).agg(F.avg(label).alias("_rate"), F.count(F.lit(1)).cast("double").alias("_n"))
    return IsotonicRegression(
        featuresCol=score, labelCol="_rate", weightCol="_n", predictionCol="calibrated"
    ).fit(points)
