"""Silhouettes with plain Euclidean distances, of all rows or of a sample, to all rows."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from usertide.plans.model_data import split_key
from usertide.schema import quoted
from usertide.session import materialize

#: Distances that a task computes at once, and sums that it holds before it passes them on.
BLOCK, HELD = 1_000_000, 4_000_000
#: Rows whose silhouettes are averaged at most; all rows where there are no more.
SAMPLED_ROWS = 1000
#: Where all rows are averaged: rows that a task finds the silhouettes of at most, about, and distances that it computes at once.
OWN_ROWS, TILE = 32_768, 65_536
#: Squared distances below this share of the squared lengths come from differences: products have too few digits left there.
NEAR = 1e-6


def hash_sample(df: DataFrame, id_col: str, rows: int, seed: int) -> DataFrame:
    """The ``rows`` rows of smallest hashed id, repeatable and independent of how the rows are stored."""
    return df.orderBy(split_key(quoted(id_col), seed), quoted(id_col)).limit(rows)


def distance_sums(known: DataFrame, sample: list[Row], width: int) -> DataFrame:
    """Per task the distances from each sampled row to the rows of each cluster: (pos, s, own, other, d, n).

    The first ``width`` columns are coordinates, the others cluster numbers of one clustering each.  ``s`` numbers the
    sampled rows, ``pos`` the clusterings; ``d`` adds up the distances and ``n`` counts the rows.  Distances of a row with a
    null coordinate are null and don't add.  A block of rows meets the whole sample at once, and its distances serve
    every clustering.
    """
    shared = known.sparkSession.sparkContext.broadcast([tuple(r) for r in sample])
    block, held, clusterings = BLOCK, HELD, len(known.columns) - width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(values: list[list]) -> tuple[np.ndarray, np.ndarray]:
            whole = np.array([all(v is not None for v in r) for r in values], bool)
            return np.array([r if fit else [0.0] * width for r, fit in zip(values, whole)], float).reshape(-1, width), whole

        s_x, s_whole = table([r[:width] for r in shared.value])
        size = len(s_x)
        own = [np.array([r[width + i] for r in shared.value], np.int32) for i in range(clusterings)]
        totals: dict[tuple[int, int], list] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (pos, other), (d, fit, n) in totals.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(size, pos, np.int32)), pa.array(np.arange(size, dtype=np.int64)), pa.array(own[pos]), pa.array(np.full(size, other, np.int32)),
                    pa.array(d, mask=~s_whole if fit else np.ones(size, bool)), pa.array(np.full(size, n, np.int64)),
                ], ["pos", "s", "own", "other", "d", "n"])
            totals.clear()

        for batch in batches if size else ():
            step = max(1, block // size)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                parts = [part.column(i) for i in range(width)]
                whole = np.all([c.is_valid().to_numpy(zero_copy_only=False) for c in parts], axis=0)
                distance = np.zeros((part.num_rows, size))
                for i, c in enumerate(parts):
                    distance += (c.to_numpy(zero_copy_only=False)[:, None] - s_x[:, i]) ** 2
                np.sqrt(distance, out=distance)
                distance[~whole] = 0.0
                for pos in range(clusterings):
                    found, code = np.unique(part.column(width + pos).to_numpy(), return_inverse=True)
                    order = np.argsort(code, kind="stable")
                    first = np.searchsorted(code[order], np.arange(len(found)))
                    added = np.add.reduceat(distance[order], first, axis=0)
                    fits = np.bincount(code, whole, len(found)).astype(int).tolist()
                    for other, d, fit, n in zip(found.tolist(), added, fits, np.bincount(code).tolist()):
                        total = totals.setdefault((pos, other), [np.zeros(size), 0, 0])
                        total[0] += d
                        total[1] += fit
                        total[2] += n
                if len(totals) * size > held:
                    yield from flushed()
        yield from flushed()

    return known.mapInArrow(run, "pos int, s long, own int, other int, d double, n long")


def sampled_pairs(known: DataFrame, coordinates: Sequence[str], clusters: Sequence[str], rows: int, seed: int) -> DataFrame:
    """Per sampled row and clustering the mean distances to all rows: (pos, s, n_own, inside, outside, n_rows)."""
    sample = hash_sample(known, "id", rows, seed).select(*coordinates, *clusters).collect()
    met = distance_sums(known.select(*coordinates, *clusters), sample, len(coordinates))
    sums = met.groupBy("pos", "s", "own", "other").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    mine = F.col("own") == F.col("other")
    return sums.groupBy("pos", "s").agg(
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
        F.max(F.when(mine, F.col("d") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("inside"),
        F.min(F.when(~mine, F.col("d") / F.col("n"))).alias("outside"),
        F.sum("n").alias("n_rows"),
    )


def all_pairs(known: DataFrame, width: int) -> DataFrame:
    """Per row and clustering the mean distances to all rows: (pos, n_own, inside, outside, n_rows).

    The first ``width`` columns are coordinates, the next ones cluster numbers of one clustering each, the last one a number
    that is different for every row.  Rows are dealt into groups by that number.  A task holds the rows of one group and is sent all rows, in the order of
    their clusters; they pass by batch after batch, so it holds sums per own row and cluster alone.  The work is rows x rows,
    the shuffle rows x groups, and the result a line per row and clustering, which is then averaged where it is.  Distances of a row
    with a null coordinate are null and don't add, as in :func:`distance_sums`.
    """
    coordinates, clusters, number = known.columns[:width], known.columns[width:-1], known.columns[-1]
    tasks = known.sparkSession.sparkContext.defaultParallelism
    groups = tasks * max(1, -(-known.count() // (tasks * OWN_ROWS)))
    tile, near = TILE, NEAR
    most = math.isqrt(tile)
    home = F.pmod(F.xxhash64(number), F.lit(groups)).cast("int")
    # Each row once as a row of its group (-1), then as one that every group meets.
    at = known.select("*", F.explode(F.sequence(F.lit(-1), F.lit(groups - 1))).alias("to"))
    dealt = at.select(*coordinates, *clusters, F.when(F.col("to") < 0, home).otherwise(F.col("to")).alias("to"), (F.col("to") >= 0).cast("int").alias("guest"))
    dealt = dealt.repartitionById(groups, "to").sortWithinPartitions("to", "guest", *clusters)

    def read(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = [pa.chunked_array([part.column(i) for part in parts]) for i in range(width + len(clusters))]
        whole = np.all([c.is_valid().to_numpy() for c in columns[:width]], axis=0)
        x = np.column_stack([c.fill_null(0.0).to_numpy() for c in columns[:width]])
        return x, whole, np.column_stack([c.to_numpy() for c in columns[width:]])

    class Group:
        """Own rows, the sums of their distances to each cluster met, and how many rows these have, in all and without nulls."""

        def __init__(self, parts: list[pa.RecordBatch]):
            self.x, self.whole, self.codes = read(parts)
            lengths = (self.x**2).sum(1)
            self.lengths, self.longest = lengths, lengths.max()
            self.right = np.ascontiguousarray(np.column_stack([-2 * self.x, np.ones(len(lengths)), lengths]).T)
            self.sums, self.n, self.fit = defaultdict(lambda: np.zeros(len(lengths))), defaultdict(int), defaultdict(int)
            self.room = np.empty(tile)

        def meet(self, part: pa.RecordBatch) -> None:
            x, whole, codes = read([part])
            for pos in range(len(clusters)):
                found, code = np.unique(codes[:, pos], return_inverse=True)
                for other, n, fit in zip(found.tolist(), np.bincount(code).tolist(), np.bincount(code, whole).astype(int).tolist()):
                    self.n[pos, other] += n
                    self.fit[pos, other] += fit
            x, codes = x[whole], codes[whole]
            # Rows come in the order of their clusters: those alike in all clusterings are added up together.
            first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(axis=1))[: len(x)]).tolist()
            for a, b in zip(first, [*first[1:], len(x)]):
                for start in range(a, b, most):
                    added = self.distances_to(x[start : min(start + most, b)])
                    for key in enumerate(codes[a].tolist()):
                        self.sums[key] += added

        def distances_to(self, x: np.ndarray) -> np.ndarray:
            """Per own row the sum of its distances to some rows."""
            lengths, total = (x**2).sum(1), np.empty(len(self.x))
            left = np.column_stack([x, lengths, np.ones(len(x))])
            limit, step = near * (lengths.max() + self.longest), tile // len(x)
            for a in range(0, len(total), step):
                b = min(a + step, len(total))
                d = np.matmul(left, self.right[:, a:b], out=self.room[: len(x) * (b - a)].reshape(len(x), b - a))
                if d.min() < limit:
                    close = d < near * lengths[:, None] + near * self.lengths[a:b]
                    if np.count_nonzero(close) * 8 < close.size:
                        i, j = close.nonzero()
                        d[i, j] = ((x[i] - self.x[a + j]) ** 2).sum(1)
                    else:
                        d = sum((x[:, c, None] - self.x[a:b, c]) ** 2 for c in range(width))
                np.sqrt(d, out=d).sum(axis=0, out=total[a:b])
            return total

        def means(self) -> Iterator[pa.RecordBatch]:
            every = np.arange(len(self.x))
            for pos in range(len(clusters)):
                found = sorted(other for p, other in self.n if p == pos)
                n, fit = (np.array([c[pos, other] for other in found]) for c in (self.n, self.fit))
                d, own = np.array([self.sums[pos, other] for other in found]), np.searchsorted(found, self.codes[:, pos])
                inside = d[own, every] / np.maximum(n[own] - 1, 1)
                d = np.where(fit[:, None] > 0, d / n[:, None], np.inf)
                d[own, every] = np.inf
                met = self.whole & (np.count_nonzero(fit) > (fit[own] > 0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(every), pos, np.int32)), pa.array(n[own]), pa.array(inside, mask=~self.whole),
                    pa.array(d.min(axis=0), mask=~met), pa.array(np.full(len(every), n.sum())),
                ], ["pos", "n_own", "inside", "outside", "n_rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, group = None, [], None
        for batch in batches:
            to, guest = (batch.column(width + len(clusters) + i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(to) != 0) | (np.diff(guest) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()] if len(to) else (), [*cuts.tolist(), len(to)]):
                if to[a] != current:
                    if group:
                        yield from group.means()
                    current, own, group = to[a], [], None
                if not guest[a]:
                    own.append(batch.slice(a, b - a))
                elif own:
                    group = group or Group(own)
                    group.meet(batch.slice(a, b - a))
        if group:
            yield from group.means()

    return dealt.mapInArrow(run, "pos int, n_own long, inside double, outside double, n_rows long")


def euclidean_silhouettes(
    df: DataFrame,
    columns: Sequence[str],
    clusterings: Sequence[str],
    id_col: str = "user_id",
    rows: int | None = SAMPLED_ROWS,
    seed: int = 42,
) -> DataFrame:
    """Mean silhouette of each clustering: (clustering, n_rows, n_sampled, silhouette, standard_error).

    ``clusterings`` names columns of cluster numbers.  A row's
    silhouette is exact: its distances go to all rows.  With ``rows=None`` the mean is taken over all rows, by :func:`all_pairs`.
    Otherwise it is taken over a sample of ``rows`` rows by
    hashed id, which is a stated, bounded query set; it is exact where the table has no more rows, and
    ``standard_error`` says how far it may be off otherwise (0 for all rows, null for a single one).  Every row
    meets the broadcast sample once for all clusterings, and only sums per sampled row and
    cluster leave a task, so the work is rows x sample.  A row alone in its cluster counts 0; rows with a null
    cluster are left out; a clustering with fewer than two clusters in use has no silhouette.
    """
    names = list(clusterings)
    kept = [F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    labels = [F.col(quoted(c)).cast("int").alias(f"c{i}") for i, c in enumerate(names)]
    known = df.select(F.col(quoted(id_col)).alias("id"), *kept, *labels).dropna(subset=[f"c{i}" for i in range(len(names))])
    coordinates, clusters = [f"x{i}" for i in range(len(columns))], [f"c{i}" for i in range(len(names))]
    if rows is None:
        numbered = known.select(*coordinates, *clusters, F.monotonically_increasing_id().alias("number"))
        each = all_pairs(materialize(numbered, spread_by="number"), len(columns))
    else:
        each = sampled_pairs(materialize(known, spread_by="id"), coordinates, clusters, rows, seed)
    share = F.coalesce(F.try_divide(F.col("outside") - F.col("inside"), F.greatest("inside", "outside")), F.lit(0.0))
    value = F.when(F.col("outside").isNull(), F.lit(None).cast("double")).when(F.col("n_own") == 1, 0.0).otherwise(share)
    found = each.withColumn("value", value).groupBy("pos").agg(
        F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_sampled"), F.avg("value").alias("silhouette"), F.stddev_samp("value").alias("spread")
    )
    rest = F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("n_sampled") / F.col("n_rows")))
    return found.select(
        F.get(F.array(*[F.lit(name) for name in names]), F.col("pos")).alias("clustering"),
        "n_rows",
        "n_sampled",
        "silhouette",
        (F.col("spread") / F.sqrt("n_sampled") * rest).alias("standard_error"),
    )
