"""Approximate nearest neighbours with balanced posting lists.

A bounded sample is bisected into equally large clusters whose means are the centroids.  Every vector goes to
the list of its nearest centroid and, when it lies near a boundary, to those of a few more; both vectors and
queries find centroids by best-first search in an in-memory neighbour graph.  A query reads the lists whose
centroid is not much further than its nearest one (distance-ratio pruning), and the candidates' inner
products are computed exactly.  Largest inner product becomes smallest distance by one more dimension.

Lists are read in blocks of bounded size, as are the queries that a list serves, so a dense region costs more
tasks and not larger ones.  Equal vectors share one entry that keeps the ids that can be among the nearest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usertide.llm.near_duplicates import runs
from usertide.session import materialize

#: Vectors the centroids are fitted on at most, chosen by a hash of the id, and sample vectors per centroid.
SAMPLE = 20_000
PER_CENTROID = 100
#: Lists a vector is in at most, and how much further than the nearest centroid they may be.
COPIES = 2
SPREAD = 1.05
#: How much further than its nearest centroid those of the lists a query reads may be.
REACH = 1.14
#: Lists a query reads at least.
LEAST_LISTS = 4
NEIGHBOURS = 16
BLOCK = 2048


def bisected(x: np.ndarray, most: int, seed: int = 7) -> np.ndarray:
    """Means of balanced clusters: each is cut in half along its two-means axis until small enough."""
    random, out, todo = np.random.default_rng(seed), [], [x]
    while todo:
        part = todo.pop()
        if len(part) <= most or not np.ptp(part, axis=0).any():
            out.append(part.mean(axis=0))
            continue
        a, b = part[random.choice(len(part), 2, replace=False)]
        for _ in range(8):
            near_a = ((part - a) ** 2).sum(axis=1) <= ((part - b) ** 2).sum(axis=1)
            if near_a.all() or not near_a.any():
                break
            a, b = part[near_a].mean(axis=0), part[~near_a].mean(axis=0)
        axis = part @ (b - a)
        order = np.argsort(axis, kind="stable")
        middle = len(part) // 2
        todo += [part[order[:middle]], part[order[middle:]]]
    return np.array(out)


class Graph:
    """Centroids as a neighbour graph that is searched best first."""

    def __init__(self, points: np.ndarray, neighbours: int = NEIGHBOURS) -> None:
        self.points = points
        self.square = (points**2).sum(axis=1)
        near, links = min(neighbours, len(points) - 1), []
        for i in range(len(points)):
            d = self.square - 2 * points @ points[i]
            d[i] = -np.inf
            links.append(np.argsort(d, kind="stable")[1 : near + 1])
        both: list[set[int]] = [set(x.tolist()) for x in links]
        for i, x in enumerate(links):
            for j in x.tolist():
                both[j].add(i)
        # A ring keeps the graph connected.
        for i in range(len(points)):
            both[i] |= {(i + 1) % len(points), (i - 1) % len(points)} - {i}
        self.links = [np.array(sorted(s), np.int64) for s in both]

    def search(self, v: np.ndarray, ratio: float, least: int, width: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """Centroids within ``ratio`` times the nearest one's distance, and distances; at least ``least``.

        The search goes on while its frontier is within the ratio, or among the ``width`` nearest so far.
        """
        base = float(v @ v)
        far = lambda at: np.sqrt(np.maximum(self.square[at] - 2 * (self.points[at] @ v) + base, 0))
        seen = np.zeros(len(self.points), bool)
        start = np.array([0])
        seen[start] = True
        d = far(start)
        frontier, found = [(float(d[0]), 0)], [(float(d[0]), 0)]
        nearest, best = [-float(d[0])], float(d[0])
        while frontier:
            distance, at = heapq.heappop(frontier)
            if distance > best * ratio and len(nearest) >= width and distance > -nearest[0]:
                break
            new = self.links[at][~seen[self.links[at]]]
            seen[new] = True
            for x, i in zip(far(new).tolist(), new.tolist(), strict=True):
                heapq.heappush(frontier, (x, i))
                found.append((x, i))
                best = min(best, x)
                heapq.heappush(nearest, -x)
                if len(nearest) > max(width, least):
                    heapq.heappop(nearest)
        found.sort()
        kept = [f for k, f in enumerate(found) if k < least or f[0] <= found[0][0] * ratio]
        return np.array([i for _, i in kept], np.int64), np.array([x for x, _ in kept])


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more dimension, all of one length: nearest then means largest inner product."""
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def query_point(x: np.ndarray, longest: float) -> np.ndarray:
    return np.concatenate([x * (longest / np.sqrt((x**2).sum())), [0.0]])


def list_copies(graph: Graph, point: np.ndarray, copies: int = COPIES, spread: float = SPREAD) -> np.ndarray:
    """The lists of a vector: its nearest, and near ones unless a chosen centroid lies closer to them."""
    at, distance = graph.search(point, spread, 1)
    chosen: list[int] = []
    for i, d in zip(at.tolist(), distance.tolist(), strict=True):
        if len(chosen) == copies:
            break
        if all(((graph.points[i] - graph.points[j]) ** 2).sum() > d * d * 0.25 for j in chosen):
            chosen.append(i)
    return np.array(chosen or at[:1].tolist(), np.int64)


def nearest_in_block(q: np.ndarray, x: np.ndarray, ids: list[list[int]], k: int) -> Iterator[tuple[int, list[int], list[float]]]:
    """For each query the best ``k`` ids of a block by (inner product, id), with products in a fixed order of addition."""
    least = np.array([i[0] for i in ids])
    rough = q @ x.T
    for row in range(len(q)):
        s = rough[row]
        at = np.arange(len(s))
        if len(s) > k:
            edge = np.partition(s, len(s) - k)[len(s) - k]
            at = np.flatnonzero(s >= edge - 1e-9 * max(1.0, abs(float(edge))))
        exact = (x[at] * q[row]).sum(axis=1)
        order = np.lexsort((least[at], -exact))[:k]
        pairs = sorted(((-float(exact[o]), i) for o in order for i in ids[at[o]]))[:k]
        yield row, [i for _, i in pairs], [-s for s, _ in pairs]


def usable(vec: Column) -> Column:
    """Whether a vector has numbers only, and not zeros only."""
    sound = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(sound, F.lit(False)) & F.coalesce(F.exists(vec, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy().astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest_vectors(
    embeddings: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    reach: float = REACH,
    sample: int = SAMPLE,
    per_centroid: int = PER_CENTROID,
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product for each query row.

    ``is_query`` marks the queries among the rows; a query isn't its own neighbour, ties go to smaller ids.
    Null and empty vectors, those of zeros only, and those holding null or non-finite numbers take no part,
    nor do rows without an id; of vectors of several lengths only the commonest length does (the longer one
    at a tie).  Of rows that repeat an id, one counts.  Fewer candidates than ``k`` give all that were found.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("ask"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("top")).orderBy(F.desc("n"), F.desc("size")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    rows = materialize(rows.where(F.size("v") == sizes["size"]).dropDuplicates(["id"]))
    longest = float(np.sqrt(sizes["top"]))
    # One entry per distinct vector with the ids that may be among the k nearest, one more for the query itself.
    first = rows.select("id", "v", F.row_number().over(Window.partitionBy("v").orderBy("id")).alias("at")).where(F.col("at") <= k + 1)
    entries = materialize(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("entry", F.col("ids")[0]))
    asked = rows.where("ask").select("id", "v")
    asking = materialize(asked.groupBy("v").agg(F.min("id").alias("q")))
    fitted = entries.orderBy(F.xxhash64("entry"), "entry").limit(sample).select("v").toPandas()["v"]
    points = lifted(np.stack(fitted.to_list()).astype(np.float64), longest)
    shared = spark.sparkContext.broadcast(Graph(bisected(points, per_centroid)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            lists = [list_copies(graph, p).tolist() for p in lifted(matrix(batch.column("v")), longest)]
            yield batch.append_column("lists", pa.array(lists, pa.list_(pa.int64())))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            lists = [graph.search(query_point(x, longest), reach, LEAST_LISTS)[0].tolist() for x in matrix(batch.column("v"))]
            yield batch.append_column("lists", pa.array(lists, pa.list_(pa.int64())))

    kind = rows.schema["v"].dataType.simpleString()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = materialize(entries.repartition(tasks).mapInArrow(place, f"v {kind}, ids array<long>, entry long, lists array<long>").select("v", "ids", "entry", F.explode("lists").alias("list")))
    probes = materialize(asking.repartition(tasks).mapInArrow(choose, f"v {kind}, q long, lists array<long>").select("v", "q", F.explode("lists").alias("list")))
    chunks = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("chunks"))
    parts = probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    both = F.broadcast(chunks.join(parts, "list"))  # a row per centroid
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    left = probes.join(both, "list").select("list", own("q", "parts").alias("part"), upto("chunks").alias("chunk"), F.lit(0).alias("side"), "v", F.array("q").alias("ids"))
    right = postings.join(both, "list").select("list", upto("parts").alias("part"), own("entry", "chunks").alias("chunk"), F.lit(1).alias("side"), "v", "ids")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["list", "part", "chunk"]):
            cut = int(np.searchsorted(block.column("side").to_numpy(), 1))
            if cut == 0 or cut == block.num_rows:
                continue
            x, ids = matrix(block.column("v").combine_chunks()), block.column("ids").to_pylist()
            q, vec, score = [], [], []
            for row, found, products in nearest_in_block(x[:cut], x[cut:], ids[cut:], k + 1):
                q += [ids[row][0]] * len(found)
                vec += found
                score += products
            yield pa.RecordBatch.from_pydict({"q": pa.array(q, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    dealt = left.union(right).repartition(tasks, "list", "part", "chunk").sortWithinPartitions("list", "part", "chunk", "side")
    found = dealt.mapInArrow(compare, "q long, vec_id long, score double").groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).drop("at")
    askers = asked.join(asking, "v").select(F.col("id").alias("query_id"), "q")
    own_best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = askers.join(top, "q").where("query_id <> vec_id").withColumn("rank", F.row_number().over(own_best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
