"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star edges.

A document's distinct word shingles are hashed once.  The top bits of a hash choose one of ``BINS`` bins
and each bin keeps its smallest hash; an empty bin copies from the bin that a fixed random probe sequence
reaches first, which keeps every bin an unbiased sample (optimal densification).  ``BANDS`` bands of four
bins give bucket keys: two documents of similarity 0.8 share none of them with probability 5e-8.

Texts with equal shingle sets form one class and only its smallest document goes on.  Within a bucket all
members link to the smallest one, so candidate edges grow with the members and not with their pairs.
The links are confirmed on full shingle sets in two passes:

1. every member against the star centre it shares most buckets with;
2. where a bucket still holds several components, members outside its largest component against the
   members of the others, block by block: pairs that set sizes and agreement of signatures don't rule out
   are compared on their full sets within the block, so that only links leave it.

So no pair that shares a bucket is left out unless it is connected already.  A pair that shares several
buckets is looked at in the first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.llm.components import components
from usertide.session import materialize

WORDS = 4
PERCENT = 80
BINS = 128
BANDS = 32
BLOCK = 1024
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles; fewer words form one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - size + 1 + k])
    return np.unique(h)


@cache
def probes(bins: int) -> np.ndarray:
    """Fixed random probe sequences: row a holds the bin that each empty bin tries at attempt a."""
    grid = np.arange(bins * 2048, dtype=np.uint64).reshape(2048, bins)
    return (mixed(grid + np.uint64(0x5851F42D4C957F2D)) % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The densified one-permutation sketch of a non-empty sorted hash set."""
    at, first = np.unique(hashes >> np.uint64(64 - bins.bit_length() + 1), return_index=True)
    sketch, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    sketch[at], full[at] = hashes[first], True
    table, empty = probes(bins), np.flatnonzero(~full)
    for start, end in ((0, 32), (32, 2048)):
        if len(empty):
            hit = full[table[start:end][:, empty]]
            done = hit.any(axis=0)
            chosen = table[start + hit.argmax(axis=0)[done], empty[done]]
            sketch[empty[done]] = sketch[chosen]
            empty = empty[~done]
    sketch[empty] = sketch[at[0]]
    return sketch


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sketch.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows ``id, n, set_key, bands, sketch``; ``set_key`` is a digest of the whole set, null when empty."""
    kind = docs.schema["id"].dataType
    schema = pa.schema([("n", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("text"):
                h = shingles(text.as_py(), words)
                if len(h):
                    s = signature(h)
                    rows.append((len(h), xxhash.xxh128_digest(h.tobytes()), band_keys(s), (s & np.uint64(255)).astype(np.uint8).tobytes()))
                else:
                    rows.append((0, None, None, None))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *schema.names])

    out = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    return docs.select("id", "text").mapInArrow(run, out)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """Rows ``id, hashes``: the whole shingle sets as packed 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array((shingles(t.as_py(), words).tobytes() for t in batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed], ["id", "hashes"])

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("hashes", T.BinaryType())]))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs ``a, b`` those whose full shingle sets are similar enough.

    The sets meet by joins that the adaptive skew join can split; nothing is grouped by a star's centre.
    """
    left = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hashes_b"))
    right = sets.select(F.col("id").alias("a"), F.col("hashes").alias("hashes_a"))
    both = pairs.select("a", "b").join(left, "b").join(right, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
                keep.append(similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(run, pairs.select("a", "b").schema).distinct()


def in_blocks(members: DataFrame, labels: DataFrame, details: DataFrame) -> DataFrame:
    """The rows ``key, id`` of buckets that hold several components, dealt into blocks, with their ``details``.

    A bucket's members outside its largest component (``side`` 0) meet all its members (``side`` 1) in
    blocks of about ``BLOCK`` rows, dealt by a hash of the id, so no task holds a whole bucket.
    """
    labels = labels.select(F.col("node").alias("id"), "component")
    members = members.select("key", "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n_part"))
    buckets = (
        sizes.groupBy("key")
        .agg(F.sum("n_part").alias("total"), F.max("n_part").alias("most"), F.max_by("component", "n_part").alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("key", "main", F.ceil((F.col("total") - F.col("most")) / BLOCK).alias("few"), F.ceil(F.col("total") / BLOCK).alias("all"))
    )
    rows = members.join(buckets, "key").withColumn("h", F.xxhash64("id")).join(details, "id")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod("h", n)
    carried = ["component", *details.columns]
    outside = rows.where("component <> main").select("key", own("few").alias("i"), upto("all").alias("j"), F.lit(0).alias("side"), *carried)
    everyone = rows.select("key", upto("few").alias("i"), own("all").alias("j"), F.lit(1).alias("side"), *carried)
    return outside.union(everyone).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")


def candidates(block: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each outside row of a block the rows it may be linked with, the likeliest first.

    Left out are rows of its own component, sets too different in size, signatures that agree in fewer bins
    than six standard deviations under the expected number at the threshold, and pairs whose first shared
    bucket is another one.
    """
    share = percent / 100
    least = BINS * share - 6 * (BINS * share * (1 - share)) ** 0.5
    cut = int(np.searchsorted(block.column("side").to_numpy(), 1))
    key = block.column("key")[0].as_py()
    part, n = block.column("component").to_numpy(), block.column("n").to_numpy()
    sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
    bands = block.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    for x in range(cut):
        at = cut + np.flatnonzero((part[cut:] != part[x]) & (100 * np.minimum(n[x], n[cut:]) >= percent * np.maximum(n[x], n[cut:])))
        agree = (sketch[at] == sketch[x]).view(np.uint8).sum(axis=1, dtype=np.uint8)
        at, agree = at[agree >= least], agree[agree >= least]
        first = bands[x][(bands[at] == bands[x]).argmax(axis=1)] == key
        yield x, at[first][np.argsort(-agree[first].astype(int), kind="stable")]


def paired(block: pa.Table, found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Rows of a block and their partners as pairs of ids, the smaller one first."""
    ids, kind = block.column("id").to_numpy(), block.schema.field("id").type
    a = np.concatenate([np.minimum(ids[at], ids[x]) for x, at in found] or [ids[:0]])
    b = np.concatenate([np.maximum(ids[at], ids[x]) for x, at in found] or [ids[:0]])
    return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])


def rest_links(members: DataFrame, labels: DataFrame, reps: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of different components, one for each row and component it is linked with.

    First the rows with any candidate are marked; then only those meet again, with their full sets.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["key", "i", "j"]):
            held = np.zeros(block.num_rows, bool)
            for x, at in candidates(block, percent):
                held[at] = True
                held[x] |= len(at) > 0
            yield from block.select(["key", "id"]).filter(pa.array(held)).to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["key", "i", "j"]):
            part, hashes, found = block.column("component").to_numpy(), block.column("hashes"), []
            sets = [np.frombuffer(h.as_buffer(), np.uint64) for h in hashes]
            for x, at in candidates(block, percent):
                linked: dict[int, int] = {}
                for y in at.tolist():
                    if part[y] not in linked and similar(sets[x], sets[y], percent):
                        linked[part[y]] = y
                found.append((x, np.array(list(linked.values()), np.int64)))
            yield paired(block, found)

    details = reps.select("id", "n", "sketch", "bands")
    marked = materialize(in_blocks(members, labels, details).mapInArrow(mark, members.select("key", "id").schema).distinct())
    return in_blocks(marked, labels, details.join(full, "id")).mapInArrow(compare, pair_schema(members)).distinct()


def pair_schema(members: DataFrame) -> T.StructType:
    return members.select(F.col("id").alias("a"), F.col("id").alias("b")).schema


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` % of their union; empty sets share nothing."""
    if not len(x) or not len(y):
        return False
    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut sorted batches into tables of equal keys; one run at a time is held."""
    held: list[pa.RecordBatch] = []
    last: list | None = None
    for batch in batches:
        values = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(max(batch.num_rows - 1, 0), bool)
        for v in values:
            new |= v[1:] != v[:-1]
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            if start == end:
                continue
            key = [v[start] for v in values]
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` % Jaccard similarity;
    ``kept`` marks that document.  Null, empty and white-space texts have no shingles, link with nothing
    and are kept.  A null id takes no part in links: its component is null and it is kept.  Repeated rows
    get the same result each; ids should not repeat with another text, as such texts may share links.
    Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = materialize(sketched(docs, words))
    whole = sets.where("set_key is not null and id is not null")
    classes = materialize(whole.groupBy("set_key").agg(F.min("id").alias("id"), F.max("id").alias("last")))
    # One row per class: the smallest document stands for all texts with the same set.
    reps = materialize(whole.join(classes.select("set_key", "id"), ["set_key", "id"]).dropDuplicates(["set_key", "id"]).drop("set_key"))
    bands = reps.select("id", F.explode("bands").alias("key"))
    stars = bands.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a <> last").select("key", "a")
    members = materialize(bands.join(stars, "key").select("key", "a", "id"))
    full = materialize(full_sets(docs.join(members.select("id").distinct(), "id"), words))
    votes = members.where("a <> id").groupBy("a", F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("b").agg(F.min_by("a", F.struct(-F.col("n"), "a")).alias("a"))
    label = materialize(components(confirmed(best, full, percent)))
    known = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
    label = materialize(components(known.union(rest_links(members, label, reps, full, percent))))
    moved = (
        classes.join(label.select(F.col("node").alias("id"), "component"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .where("component <> last or id <> last")
        .select("set_key", "component")
    )
    out = sets.select("id", "n", "set_key").join(moved, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
