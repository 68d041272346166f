"""Byte-level BPE encoding and decoding.

A word starts as its bytes.  Ranked merges join the adjacent pair of lowest rank, the leftmost first, until no
pair has a rank.  ``encode_by_functions`` folds them with higher-order functions over a literal rank map, cut
into small maps by a hash, for the distinct words of each text.  Its interpreted fold takes some hundred
microseconds a word, too long for a corpus (README has figures), so ``encode`` lets Spark cut the texts into
words and makes the same merges in Arrow batches, once for each distinct word that a task meets.
Ids are decoded by concatenating their binary pieces.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Bytes of distinct words and their packed ids that a task remembers at most, with what an entry costs besides.
REMEMBERED, ENTRY = 64_000_000, 200
#: Texts handled at once.
SLICE = 500
NONE = 2**31 - 1
OWN = "__bpe"


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 piece and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def buckets_for(n: int) -> int:
    return max(1, n // 8)


def literal_map(entries: dict[str, object], kind: str) -> tuple[Column, int]:
    """A literal array of small maps, and their number; a key is in the map that its crc32 selects."""
    size = buckets_for(len(entries))
    maps: list[dict] = [{} for _ in range(size)]
    for key, value in entries.items():
        maps[zlib.crc32(key.encode("utf-8")) % size][key] = value
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), f"array<map<string, {kind}>>"), size


def looked_up(table: tuple[Column, int], key: Column) -> Column:
    maps, size = table
    return F.try_element_at(F.get(maps, F.pmod(F.crc32(key.cast("binary")), F.lit(size)).cast("int")), key)


def let(value: Column, body: object) -> Column:
    """``body(value)`` with the value computed once per evaluation; a large literal so stands once in a plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def latin(word: Column) -> Column:
    """The UTF-8 bytes of a string, each as one character."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def folded(word: Column, ranks: tuple[Column, int]) -> Column:
    """The ids of one word, given as one character per byte."""
    rank = lambda piece: F.coalesce(looked_up(ranks, piece), F.lit(NONE))

    def merged(acc: Column, i: Column, piece: Column) -> Column:
        # Position i (from 1) and its right neighbour become one piece; the ranks beside it are looked up.
        p, r = acc["p"], acc["r"]
        left = F.when(i > 1, F.array(rank(F.concat(F.get(p, i - 2), piece)))).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.concat(F.slice(p, F.lit(1), i - 1), F.array(piece), F.slice(p, i + 2, F.size(p))).alias("p"),
            F.concat(F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0))), left, F.array(rank(F.concat(piece, F.get(p, i + 1)))), F.slice(r, i + 2, F.size(r))).alias("r"),
        )

    def step(acc: Column, _: Column) -> Column:
        def at_lowest(low: Column) -> Column:
            where = F.array_position(acc["r"], low).cast("int")
            return let(where, lambda i: let(F.concat(F.get(acc["p"], i - 1), F.get(acc["p"], i)), lambda piece: merged(acc, i, piece)))

        return let(F.array_min(acc["r"]), lambda low: F.when(low == NONE, acc).otherwise(at_lowest(low)))

    chars = F.split(word, "")
    # The last position has no right neighbour: its rank is that of nothing.
    start = let(chars, lambda c: F.struct(c.alias("p"), F.transform(c, lambda x, i: rank(F.concat(x, F.get(c, i + 1)))).alias("r")))
    pieces = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1))), start, step, lambda acc: acc["p"])
    return let(looked_up(ranks, word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(pieces, lambda x: looked_up(ranks, x))))


def words_in(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))


def encode_by_functions(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``encode`` with higher-order functions only; its time is quadratic in the length of a word."""
    maps, size = literal_map({piece.decode("latin-1"): rank for piece, rank in ranks.items()}, "int")
    words = words_in(F.coalesce(F.col(text_col), F.lit("")), pattern)
    known = lambda m: F.map_from_arrays(F.array_distinct(words), F.transform(F.array_distinct(words), lambda w: folded(latin(w), (m, size))))
    ids = let(maps, lambda m: let(known(m), lambda k: F.flatten(F.transform(words, lambda w: F.try_element_at(k, w)))))
    return docs.withColumn(ids_col, ids)


def merged_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: ranked merges, leftmost lowest first."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 100:
        return long_merged_ids(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        low, at = NONE, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], NONE)
            if rank < low:
                low, at = rank, i
        if at < 0:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def long_merged_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap of pairs, in n log n time."""
    n = len(word)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    live = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (rank := ranks.get(word[i : end[after[i]]])) is not None:
            heapq.heappush(heap, (rank, i, end[i], end[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, last = heapq.heappop(heap)
        if not live[i] or end[i] != middle or after[i] >= n or end[after[i]] != last:
            continue
        gone = after[i]
        live[gone] = False
        end[i], after[i] = last, after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if live[i]]


class Memo(dict):
    """Packed ids by word; it starts anew once it holds more than its share of bytes."""

    held = 0

    def of(self, word: str, ranks: dict[bytes, int]) -> bytes:
        if (ids := self.get(word)) is None:
            data = word.encode("utf-8", "surrogatepass")
            ids = np.array(merged_ids(data, ranks), "<i4").tobytes()
            self.held += len(data) + len(ids) + ENTRY
            if self.held > REMEMBERED:
                self.clear()
                self.held = len(data) + len(ids) + ENTRY
            self[word] = ids
        return ids


def ids_of(words: pa.ListArray, ranks: dict[bytes, int], known: Memo) -> pa.ListArray:
    """The ids of texts given as lists of words; ``known`` remembers words, up to a bound."""
    coded = words.flatten().dictionary_encode()
    found = [known.of(word, ranks) for word in coded.dictionary.to_pylist()]
    size = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), "<i4")
    start = np.cumsum(size) - size
    code = coded.indices.to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size[code])])
    at = np.arange(ends[-1]) + np.repeat(start[code] - ends[:-1], size[code])
    return pa.ListArray.from_arrays(pa.array(ends[words.offsets.to_numpy() - words.offsets[0].as_py()].astype(np.int32)), pa.array(flat[at]))


def sliced(arrays: Iterator[pa.Array], make: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> Iterator[pa.Array]:
    """Applies ``make`` to some rows at a time, so that its working memory stays small; memory that is free again goes back."""
    for array in arrays:
        yield pa.concat_arrays([make(array.slice(i, SLICE)) for i in range(0, len(array), SLICE)] or [pa.array([], kind)])
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` with the token ids of ``text_col``, an array of integers, in ``ids_col``.

    Null and empty texts have no ids.  Every match of ``pattern`` is encoded by itself, without special
    tokens, in texts and words of any length.  Rows may repeat.  ``ids_col`` replaces a column of that name.
    Documents aren't shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("array<int>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Memo()
        return sliced(batches, lambda words: ids_of(words, shared.value, known), pa.list_(pa.int32()))

    return docs.withColumn(ids_col, coded(words_in(F.coalesce(F.col(text_col), F.lit("")), pattern)))


def binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that follow each other in one buffer."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def packed_ids(lists: pa.ListArray) -> pa.Array:
    ends = lists.offsets.to_numpy().astype(np.int64)
    return binary(lists.flatten().to_numpy().astype("<u4"), (ends - ends[0]) * 4)


@F.arrow_udf(BinaryType())
def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Ids as little-endian unsigned 32-bit integers; no ids give empty bytes."""
    return sliced(batches, packed_ids, pa.binary())


def piece_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The piece of every id; ids without one have empty pieces."""
    table = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    return table


def joined_pieces(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The pieces of each list of ids, concatenated."""
    found = pieces.take(lists.flatten())
    ends = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1) if len(found) else np.zeros(1, np.int32)
    data = np.frombuffer(found.buffers()[2] or b"", np.uint8) if len(found) else np.empty(0, np.uint8)
    at = lists.offsets.to_numpy().astype(np.int64)
    return binary(data, ends[at - at[0]])


def decode(docs: DataFrame, ranks: dict[bytes, int], *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All columns of ``docs`` with the bytes of the ids in ``bytes_col``: their binary pieces, concatenated.

    No ids give empty bytes; a null array gives empty bytes too.  ``bytes_col`` replaces a column of that name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(piece_table(ranks))

    @F.arrow_udf("binary")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = pa.array(shared.value, pa.binary())
        return sliced(batches, lambda lists: joined_pieces(lists, pieces), pa.binary())

    return docs.withColumn(bytes_col, joined(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``decode`` after ``encode`` in one pass: a task has one Python worker, not one for each, and ids aren't sent twice."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, pieces = Memo(), pa.array(piece_table(shared.value), pa.binary())

        def both(words: pa.ListArray) -> pa.StructArray:
            ids = ids_of(words, shared.value, known)
            return pa.StructArray.from_arrays([ids, joined_pieces(ids, pieces)], fields=list(kind))

        return sliced(batches, both, kind)

    found = docs.withColumn(OWN, coded(words_in(F.coalesce(F.col(text_col), F.lit("")), pattern)))
    return found.withColumns({ids_col: F.col(f"{OWN}.ids"), bytes_col: F.col(f"{OWN}.decoded")}).drop(OWN)
