"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Test texts are cut into windows of consecutive words.  For all windows of one length a shift table says,
for the last two words of the current position, how far the search may jump because no window can end
earlier; at shift 0 the suffix hash selects a bucket of windows, their first words select within it, and a
direct comparison confirms.  In clean text most positions are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
#: A document is contaminated if 1 in ``SHARE`` of its words or more is hit.
SHARE = 20
#: Windows per block; each block is broadcast by itself and searched over all documents.
BLOCK = 200_000
#: Lower-cases A-Z, keeps digits, a-z and all non-ASCII bytes, and makes the rest spaces.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

HITS = "struct<n_words: long, spans: array<struct<start: int, end: int>>, items: array<string>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()


def windows_of(text: str | None, window: int = WINDOW) -> set[bytes]:
    """The windows of a test text, words joined by spaces; a text of fewer words is one window."""
    words = words_of(text)
    if not words:
        return set()
    size = min(window, len(words))
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


class WuManber:
    """Finds the occurrences of equally long word sequences."""

    def __init__(self, size: int, patterns: dict[bytes, list[str]]) -> None:
        self.size, self.block = size, min(2, size)
        self.far = size - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[list[bytes], list[str]]]]] = {}
        for text, items in patterns.items():
            words = text.split(b" ")
            for end in range(self.block, size + 1):
                key = tuple(words[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.far), size - end)
            bucket = self.buckets.setdefault(tuple(words[-self.block :]), {})
            bucket.setdefault(tuple(words[: self.block]), []).append((words, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """Start, end and items of each occurrence."""
        size, block, far, shift = self.size, self.block, self.far, self.shift
        end, n = size, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            jump = shift.get(key, far)
            if jump:
                end += jump
                continue
            first = tuple(words[end - size : end - size + block])
            for pattern, items in self.buckets[key].get(first, ()):
                if words[end - size : end] == pattern:
                    yield end - size, end, items
            end += 1


def matchers(patterns: dict[bytes, list[str]]) -> list[WuManber]:
    by_size: dict[int, dict[bytes, list[str]]] = {}
    for text, items in patterns.items():
        by_size.setdefault(text.count(b" ") + 1, {})[text] = items
    return [WuManber(size, found) for size, found in sorted(by_size.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def found(text: str | None, search: list[WuManber], before: dict | None = None) -> dict:
    """The words, hit spans and items of a text, added to those that earlier blocks found."""
    words = words_of(text)
    spans = [(s["start"], s["end"]) for s in before["spans"]] if before else []
    items = set(before["items"]) if before else set()
    for matcher in search:
        for start, end, names in matcher.search(words):
            spans.append((start, end))
            items.update(names)
    return {"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in merged(spans)], "items": sorted(items)}


def window_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block: int) -> Iterator[dict[bytes, list[str]]]:
    """The distinct windows with their items, in blocks of a bounded number of windows; at least one block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, w) for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True) for w in windows_of(t, window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item", "window"])

    named = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item is not null")
    windows = named.mapInArrow(cut, "item string, window binary").distinct()
    total = windows.select("window").distinct().count()
    blocks = max(1, -(-total // block))
    for k in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        rows: dict[bytes, list[str]] = {}
        for r in own.toLocalIterator():
            rows.setdefault(bytes(r["window"]), []).append(r["item"])
        yield rows


def search_udf(docs: DataFrame, patterns: dict[bytes, list[str]]) -> Callable:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    kind = pa.struct(
        [("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))]
    )

    @F.arrow_udf(HITS)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tables = matchers(shared.value)
        for texts, before in batches:
            yield pa.array([found(t.as_py(), tables, b.as_py()) for t, b in zip(texts, before, strict=True)], kind)

    return search


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``spans`` (hit word ranges), ``items``, ``n_hit``, ``n_items``, ``contaminated``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters.  Null and wordless
    texts have no words and are clean.  Test texts that are null or wordless, and rows without an item id,
    give no windows; an empty test table leaves all documents clean.  Items that share a window are all
    listed, once each.  Added columns replace columns of the same name.  Documents are not shuffled.
    """
    rows = docs.withColumn("__hits", F.lit(None).cast(HITS))
    for patterns in window_blocks(items, item_id, item_text, window, block):
        rows = rows.withColumn("__hits", search_udf(docs, patterns)(F.col(text_col), F.col("__hits")))
    hit = F.col("__hits")
    rows = (
        rows.withColumn("n_words", hit["n_words"])
        .withColumn("spans", hit["spans"])
        .withColumn("items", hit["items"])
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )
    return rows.drop("__hits")
