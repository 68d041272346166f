"""Checks that a fitted model is what its method promises, from the rows themselves and apart from the fit.

A fit differs from machine to machine in its last digits, but the conditions it must meet do not: the gradient
of a penalised likelihood vanishes, a k-means centroid is the mean of the users nearest to it, a forest's score is what its
stored trees say.  Each check is one or two passes over all rows and returns a handful of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.operators.moments import second_moments
from usertide.plans.segments import TOTAL_SHIFT, Segments, scaled_names, squared_distance
from usertide.plans.training import LABEL, OWN, ChurnModel, _weighted
from usertide.schema import quoted
from usertide.session import materialize

#: Scores further apart than this count as different.
SAME_SCORE = 1e-9


def _margin(model: ChurnModel) -> Column:
    """x . b + intercept from the assembled features of a logistic model."""
    fitted = model.pipeline.stages[-1]
    weights = F.array(*[F.lit(float(b)) for b in fitted.coefficients])
    products = F.zip_with(vector_to_array(f"{OWN}features"), weights, lambda x, b: x * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x) + F.lit(float(fitted.intercept))


def logistic_gradient(model: ChurnModel, train: DataFrame, label: str = LABEL) -> DataFrame:
    """(feature, coefficient, gradient_at_zero, gradient) of the penalised mean log-loss over the training rows.

    The gradient is taken at coefficients of 0 and at the fitted ones, where it vanishes if the fit is the optimum: the loss is
    strictly convex, so there is only one.  Both are weighted sums of the feature vectors, with the weights of the fit, in one
    aggregate that is combined per task.  ``(intercept)`` has no penalty.  Rows without a label don't count.
    """
    weighted, total = _weighted(train, label)
    fitted = model.pipeline.stages[-1]
    rows = model.pipeline.transform(weighted)
    weight, y = F.col(f"{OWN}weight"), F.col(quoted(label)).cast("double")
    p = 1 / (1 + F.exp(-_margin(model)))
    vector, add_up = F.col(f"{OWN}features"), Summarizer.metrics("sum")
    shares = {"y": weight * y, "half": weight * 0.5, "p": weight * p}
    row = rows.agg(
        *[vector_to_array(add_up.summary(vector, s).getField("sum")).alias(f"x_{name}") for name, s in shares.items()],
        *[F.sum(s).alias(name) for name, s in shares.items()],
    ).first()
    penalty = fitted.getRegParam()
    table = [("(intercept)", float(fitted.intercept), (row["half"] - row["y"]) / total, (row["p"] - row["y"]) / total)]
    for name, b, x_y, x_half, x_p in zip(model.features, fitted.coefficients, row["x_y"], row["x_half"], row["x_p"]):
        table.append((name, float(b), (x_half - x_y) / total, (x_p - x_y) / total + penalty * float(b)))
    return train.sparkSession.createDataFrame(table, "feature string, coefficient double, gradient_at_zero double, gradient double")


def logistic_score_check(model: ChurnModel, df: DataFrame) -> DataFrame:
    """One row (n_rows, n_different): scores that are not 1 / (1 + exp(-(x . b + intercept)))."""
    scored = model.pipeline.transform(df)
    p = F.element_at(vector_to_array(f"{OWN}probability"), 2)
    far = F.abs(p - 1 / (1 + F.exp(-_margin(model)))) > SAME_SCORE
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(far | p.isNull()).alias("n_different"))


def kmeans_check(found: Segments, tolerance: float = 1e-6) -> DataFrame:
    """Lloyd's conditions over all users, a row per k.

    (k, n_users, n_clusters in use, n_strays: users that the model does not put to their nearest centroid, centred: every
    centroid is the mean of its users up to the shift at which fits stop, inertia, agrees: ``inertia`` equals that of the choices,
    total: squares around the overall mean, and split: they are those within clusters and between cluster means).  All k are
    checked in one pass; what leaves a task is a row per k and cluster.
    """
    names = scaled_names(found.columns)
    rows = VectorAssembler(inputCols=names, outputCol="_vector").transform(found.labelled)
    entries = []
    for k, model in found.models.items():
        rows = model.copy().setFeaturesCol("_vector").setPredictionCol(f"_p{k}").transform(rows)
        centers = [list(map(float, c)) for c in model.clusterCenters()]
        nearest = reduce(lambda out, jc: F.when(F.col(f"_c{k}") == jc[0], squared_distance(names, jc[1])).otherwise(out), enumerate(centers), F.lit(None).cast("double"))
        entries.append(F.struct(F.lit(k).alias("k"), F.col(f"_c{k}").alias("c"), nearest.alias("d"), (F.col(f"_p{k}") != F.col(f"_c{k}")).alias("stray")))
    each = rows.select(*names, F.explode(F.array(*entries)).alias("e"))
    clusters = each.groupBy(F.col("e.k").alias("k"), F.col("e.c").alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("e.d").alias("cost"), F.count_if("e.stray").alias("strays"), *[F.avg(z).alias(z) for z in names]
    )
    moments = second_moments(found.labelled, names)
    total = float(moments.n * moments.covariance.trace())
    inertia = {r["k"]: r["inertia"] for r in found.choices.collect()}
    by_k: dict[int, list] = {k: [] for k in found.models}
    for row in clusters.collect():  # a row per k and cluster
        by_k[row["k"]].append(row)
    out = []
    for k, members in by_k.items():
        centers = found.models[k].clusterCenters()
        shifts = [sum((r[z] - float(x)) ** 2 for z, x in zip(names, centers[r["c"]])) for r in members]
        cost = sum(r["cost"] for r in members)
        within = cost - sum(r["n"] * s for r, s in zip(members, shifts))
        between = sum(r["n"] * sum((r[z] - float(m)) ** 2 for z, m in zip(names, moments.means)) for r in members)
        n, strays = sum(r["n"] for r in members), sum(r["strays"] for r in members)
        centred = sum(shifts) <= TOTAL_SHIFT + tolerance
        agrees, split = (abs(a - b) <= tolerance * max(1.0, abs(b)) for a, b in ((cost, inertia[k]), (within + between, total)))
        out.append((k, n, len(members), strays, centred, cost, agrees, total, split))
    schema = "k int, n_users long, n_clusters int, n_strays long, centred boolean, inertia double, agrees boolean, total double, split boolean"
    return found.labelled.sparkSession.createDataFrame(out, schema)


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The trees of a model stored by :meth:`ChurnModel.save`, a row per node.

    (tree, node, left, right, feature, threshold, share: of class 1 among the node's weights, weight, gain).  A leaf is
    its own child on both sides.
    """
    stage = spark.read.text(f"{path}/pipeline/stages/*/metadata").filter(F.col("value").contains("RandomForestClassificationModel"))
    folder = stage.select(F.input_file_name().alias("file")).first()["file"].split("/metadata/")[0]
    node, stats = F.col("nodeData"), F.col("nodeData.impurityStats")
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    leaf = node["leftChild"] < 0
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(leaf, node["id"]).otherwise(node["leftChild"]).alias("left"),
        F.when(leaf, node["id"]).otherwise(node["rightChild"]).alias("right"),
        F.when(~leaf, node["split"]["featureIndex"]).alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.coalesce(F.try_divide(F.get(stats, F.lit(1)), weight), F.lit(0.0)).alias("share"),
        weight.alias("weight"),
        F.when(leaf, 0.0).otherwise(node["gain"]).alias("gain"),
    )


#: Nodes (some 60 bytes each) that are broadcast at most; more are joined without a hint.
BROADCAST_NODES = 2_000_000


def walk_forest(rows: DataFrame, nodes: DataFrame, id_col: str = "user_id", features_col: str = "features", levels: int | None = None) -> DataFrame:
    """(id, score): the mean share of class 1 over the leaves that the trees of a node table lead a row to.

    ``features_col`` is an array in the order of the model's features.  Every row enters every tree at its root and
    each level is a join with the node table, until no row moves.  ``levels`` is the depth of the deepest tree where it
    is known; otherwise it is counted from the node table.
    """
    nodes = materialize(nodes)
    levels = depth_of(nodes) if levels is None else levels
    small = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    trees = nodes.agg(F.count_distinct("tree").alias("n")).first()["n"]
    entered = rows.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(features_col)).alias("x"))
    at = entered.select("id", "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(levels):
        left = F.col("feature").isNull() | (F.get("x", F.col("feature")) <= F.col("threshold"))
        at = at.join(small.select("tree", "node", "left", "right", "feature", "threshold"), ["tree", "node"]).select(
            "id", "x", "tree", F.when(left, F.col("left")).otherwise(F.col("right")).alias("node")
        )
    leaves = at.join(small.select("tree", "node", "share"), ["tree", "node"])
    return leaves.groupBy("id").agg(F.avg("share").alias("score")).withColumnRenamed("id", id_col)


def depth_of(nodes: DataFrame) -> int:
    """The number of levels below the roots, by joins from each level to the next."""
    inner = nodes.filter("left <> node")
    steps = materialize(inner.select("tree", "node", F.explode(F.array("left", "right")).alias("child")))
    level, depth = steps.filter("node = 0").select("tree", F.col("child").alias("node")), 0
    while not level.isEmpty():
        depth += 1
        level = materialize(level.join(steps, ["tree", "node"]).select("tree", F.col("child").alias("node")))
    return depth


def node_importances(nodes: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): gains weighted by node weights, as shares per tree, averaged and as shares of all."""
    gains = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    totals = gains.groupBy("tree").agg(F.sum("g").alias("t")).filter("t > 0")
    shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    every = shares.agg(F.sum("s").alias("all"))
    names = gains.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")
    # One row of a single sum.
    found = shares.crossJoin(F.broadcast(every)).select("feature", (F.col("s") / F.col("all")).alias("importance"))
    return names.join(found, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))


def assembled(model: ChurnModel, df: DataFrame, id_col: str = "user_id") -> DataFrame:
    """(id, features): the array of features that the model's classifier sees."""
    rows = df
    for stage in model.pipeline.stages[:-1]:
        rows = stage.transform(rows)
    return rows.select(id_col, vector_to_array(f"{OWN}features").alias("features"))


def forest_check(model: ChurnModel, path: str, df: DataFrame, id_col: str = "user_id") -> DataFrame:
    """(id, score, walked): the model's score and the one that its stored trees give by joins alone."""
    nodes = forest_nodes(df.sparkSession, path)
    walked = walk_forest(assembled(model, df, id_col), nodes, id_col).withColumnRenamed("score", "walked")
    return model.score(df).select(id_col, "score").join(walked, id_col, "left")
