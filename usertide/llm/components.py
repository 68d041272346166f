"""Connected components of an edge table, by contraction.

Every node points to the neighbour with the smallest hashed rank and then to where that one points; the
edges are rewritten to those targets.  A star of any size vanishes in one round, long chains shrink by a
constant factor.  Only grouped minima and joins are used: the edges of a hub are pre-aggregated before the shuffle,
and the joins can be split by the adaptive skew join.  Each round is stored as a table in the shared
folder, so the lineage stays short and a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usertide.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``node, component`` for every node with an edge to another; ``component`` is the smallest node reachable.

    Edges may repeat, point either way or be loops; loops and edges with a null end are ignored.  Node
    values can be of any type with an order.  No edges give no rows.
    """
    kind = edges.schema[a].dataType
    pairs = edges.select(F.col(a).alias("a"), F.col(b).cast(kind).alias("b")).where("a is not null and b is not null")
    live = materialize(pairs.where("a <> b").distinct())
    maps = []
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seed = F.lit(len(maps))
        nearest = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", seed)).alias("to"))
        own, other = F.xxhash64("a", seed), F.xxhash64("to", seed)
        near = nearest.select(F.col("a").alias("node"), F.when(other < own, F.col("to")).otherwise(F.col("a")).alias("to"))
        step = materialize(near.join(near.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to")))
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = live.join(left, "a").join(right, "b").where("x <> y")
        live = materialize(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        maps.append(step)
    if not maps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # From the last and smallest map back to the first, which has every node of an edge.
    label = maps[-1]
    for step in reversed(maps[:-1]):
        later = label.select(F.col("node").alias("to"), F.col("to").alias("last"))
        label = step.join(later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    label = materialize(label)
    smallest = label.groupBy("to").agg(F.min("node").alias("component"))
    return label.join(smallest, "to").select("node", "component")
