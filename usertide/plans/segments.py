"""User segments: choice of k, clusters, their profile and a two-dimensional view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import sqrt
from operator import add

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usertide.functions.numeric import share_of
from usertide.operators.moments import principal_axes, second_moments
from usertide.operators.stats import boxplot_stats
from usertide.plans.model_data import fit_scaler, scaled_columns
from usertide.plans.silhouettes import euclidean_silhouettes
from usertide.schema import available_columns, numeric_columns, require_columns
from usertide.session import materialize

# Fits stop once the squared moves of all centroids add up to this or less (variables have variance 1).
# Spark bounds the move of each centroid, hence the square root of an equal share.
TOTAL_SHIFT = 1e-4

# The variables clusters are built from, and those drawn per cluster.
VARIABLES = (
    "event_count", "recency_days", "unique_event_types", "credits_purchased", "credits_spent", "views",
    "avg_watch_time_sec", "sessions_7d",
)
PROFILE_VARIABLES = ("event_count", "credits_purchased", "credits_spent", "views", "avg_watch_time_sec")


@dataclass(frozen=True)
class Segments:
    """Users with ``cluster``; (k, inertia, silhouette, standard_error) per tried k; the chosen k and its model.

    ``labelled`` has the standardised variables ``_z0``, ... and, for every tried k, the number of the nearest
    centroid in ``_c<k>``; ``models`` has the fit of every k.
    """

    users: DataFrame
    choices: DataFrame
    k: int
    model: KMeansModel
    columns: list[str]
    labelled: DataFrame
    models: dict[int, KMeansModel]


def scaled_names(columns: Sequence[str]) -> list[str]:
    return [f"_z{i}" for i in range(len(columns))]


def squared_distance(names: Sequence[str], centroid: Sequence[float]) -> Column:
    return reduce(add, [(F.col(c).cast("double") - F.lit(float(x))) ** 2 for c, x in zip(names, centroid)])


def inertias(labelled: DataFrame, names: Sequence[str], centers: dict[int, list[list[float]]]) -> dict[int, float]:
    """Per k the summed squared distances of all rows to their nearest centroid, in one pass."""
    lowest = [F.sum(F.least(*[squared_distance(names, c) for c in centers[k]])).alias(f"k{k}") for k in centers]
    row = labelled.agg(*lowest).first()
    return {k: row[f"k{k}"] for k in centers}


def segment_users(
    features: DataFrame,
    ks: Sequence[int] = range(2, 10),
    seed: int = 42,
    id_col: str = "user_id",
    distance: str = "euclidean",
) -> Segments:
    """k-means over the available variables with the k of the best silhouette (the smallest on a tie).

    Silhouettes use plain distances from all users to all users; ``distance='squared'`` uses
    squared distances from all users to cluster means instead.  Clusters are numbered by falling mean of
    ``credits_purchased`` (or of the first variable), so the numbers mean the same from run to run.
    """
    if distance not in ("euclidean", "squared"):
        raise ValueError(f"distance must be euclidean or squared, not {distance}")
    require_columns(features, [id_col], "features")
    columns = available_columns(features, VARIABLES)
    order_by = "credits_purchased" if "credits_purchased" in columns else columns[0]
    stored = materialize(features.na.fill(0, columns), spread_by=id_col)
    scaled, names = scaled_columns(fit_scaler(stored, columns)), scaled_names(columns)
    wide = stored.select(*stored.columns, *[scaled[c].alias(n) for c, n in zip(columns, names)])
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(wide)
    # Every iteration of every fit reads the vectors; a lost part is rebuilt from the stored table.
    kept = vectors.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="prediction", metricName="silhouette")
    models, found = {}, {}
    try:
        for k in ks:
            models[k] = KMeans(k=k, seed=seed, maxIter=300, tol=sqrt(TOTAL_SHIFT / k)).fit(kept)
            if distance == "squared":
                found[k] = (judge.evaluate(models[k].transform(kept)), None)
    finally:
        kept.unpersist()
    centers = {k: [list(map(float, c)) for c in models[k].clusterCenters()] for k in models}
    labelled = wide
    for k in models:
        labelled = nearest_centroid(labelled, names, centers[k], f"_c{k}")
    labelled = materialize(labelled)
    if distance == "euclidean":
        clusterings = [f"_c{k}" for k in models]
        rows = euclidean_silhouettes(labelled, names, clusterings, id_col, rows=None).collect()
        found = {int(r["clustering"][2:]): (r["silhouette"], r["standard_error"]) for r in rows}
    cost = inertias(labelled, names, centers)
    tried = [(k, cost[k], *found.get(k, (None, None))) for k in models]
    k = max(tried, key=lambda t: (t[2] is not None, t[2] or 0.0, -t[0]))[0]
    means = labelled.groupBy(f"_c{k}").agg(F.avg(order_by).alias("m")).collect()
    numbers = {r[f"_c{k}"]: i for i, r in enumerate(sorted(means, key=lambda r: (-r["m"], r[f"_c{k}"])))}
    renumber = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col(f"_c{k}")]
    choices = features.sparkSession.createDataFrame(tried, "k int, inertia double, silhouette double, standard_error double")
    users = labelled.select(*stored.columns, renumber.alias("cluster"))
    return Segments(users, choices, k, models[k], columns, labelled, models)


def nearest_centroid(
    df: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]], name: str = "cluster"
) -> DataFrame:
    """Add the index of the closest centroid (squared Euclidean, the lowest index on a tie)."""
    distances = [squared_distance(columns, centroid) for centroid in centroids]
    pairs = [F.struct(d.alias("distance"), F.lit(i).alias("cluster")) for i, d in enumerate(distances)]
    nearest = F.array_min(F.array(*pairs))["cluster"]
    return df.withColumn(name, nearest)


def cluster_summary(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Means (2 digits), user count and percentage of all users per cluster, by cluster."""
    counts = df.groupBy(cluster).agg(
        *[F.round(F.avg(c), 2).alias(c) for c in columns], F.count(F.lit(1)).alias("user_count")
    )
    # One row per cluster reaches this window.
    total = F.sum("user_count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct_total", share_of(F.col("user_count"), total)).orderBy(cluster)


def cluster_boxplots(df: DataFrame, columns: Sequence[str] = PROFILE_VARIABLES, cluster: str = "cluster") -> DataFrame:
    return boxplot_stats(df, columns, cluster)


def cluster_pca(df: DataFrame, id_col: str = "user_id", cluster: str = "cluster") -> DataFrame:
    """(id, cluster, pca1, pca2) over all standardised numeric columns but the id and the cluster.

    The components come from one aggregate of second moments.  Each points so that its largest loading is positive.
    A single numeric column gives a second component of 0.
    """
    columns = numeric_columns(df, (id_col, cluster))
    filled = df.na.fill(0, columns)
    moments = second_moments(filled, columns)
    _, axes = principal_axes(moments.correlation, 2)
    points = [reduce(add, [z * F.lit(float(w)) for z, w in zip(moments.scaled(), axis)]) for axis in axes]
    points += [F.lit(0.0)] * (2 - len(points))
    return filled.select(id_col, cluster, *[p.alias(f"pca{i + 1}") for i, p in enumerate(points)])
