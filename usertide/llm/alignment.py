"""Alignment of two tokenizers' tokens by lockstep merging.

Both tokenizers cut the same bytes.  One state vector holds, for every text of a slice, where it stands in its A
and its B tokens.  A step compares the ends of all current tokens at once and advances the side that ends first, or both;
where both end together it emits a cut, with the links between the A and B tokens since the last one, and
texts that are finished leave the vector.  Long texts take several places in it: they are entered at
ends that both sides share, so the number of steps doesn't grow with the longest text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usertide.llm.words import least_count
from usertide.session import materialize

#: Characters, and texts, that are encoded and aligned at once (one text at least).
SLICE_CHARS, SLICE_TEXTS = 1_000_000, 1000
#: A tokens after which a long text is entered anew, and tokens tried there for a shared end.
LANE, TRIED = 512, 32
#: Links expanded at once.
LINKS = 2_000_000
#: Id pairs whose counts are broadcast at most; the others are joined.
HOT = 500_000
#: An id pair is one number, A id x SPAN + B id.
SPAN = 2**32
OWN = "__align_row"
#: Characters of words whose tokens a process remembers before it starts anew, and new words that are encoded as one text.
KNOWN_CHARS, JOINED = 3_000_000, 200
#: A single space between other characters: where no token of either tokenizer reaches across, if ``Tokenizers.by_words`` holds.
BORDER = re.compile(r"(?<=\S) (?=\S)")

LINK = pa.struct([("pair", pa.int64()), ("times", pa.int32())])
RESULT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<struct<pair: long, times: int>>"
SPANS = "a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the decimal texts of their ids with what follows them."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        # A task has one core; the library would start a thread for each of the machine's.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_file.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = byte_letters()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        a_bytes = [bytes(letters[c] for c in names[i]) if i in names and all(c in letters for c in names[i]) else b"" for i in range(max(names) + 1)]
        size = self.b.get_piece_size()
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(map(self.b.id_to_piece, range(size)))]
        self.bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in (a_bytes, b_bytes))
        # Twice the id, and one more for the last token of its group.
        self.b_from = 2 * len(a_bytes)
        self.texts = pa.array([f"{i}{c}" for i in range(len(a_bytes)) for c in ",|"] + [f"{i}{c}" for i in range(size) for c in ",;"], pa.binary())
        self.by_words = separate_words(json.loads(a_file), b_file)
        self.forget()

    def lists(self, texts: list[str]) -> tuple[list, list]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all texts, and where each text's begin and the last one's end.

        Where words are encoded alike in any text, each distinct one is encoded once and remembered, up to a bound.
        The sign of a space, U+2581, is no part of such words.
        """
        if not self.by_words or any("▁" in t for t in texts):
            return [flattened(side) for side in self.lists(texts)]
        cut = [BORDER.split(t) for t in texts]
        if self.held > KNOWN_CHARS:
            self.forget()
        known, before = self.known, len(self.known)
        code = np.fromiter((known.setdefault(w, len(known)) for words in cut for w in words), np.int64)
        self.learn(list(islice(known, before, None)))
        text_at = np.cumsum([0, *map(len, cut)])
        out = []
        for ids, at in self.tokens:
            size = np.diff(at)[code]
            ends = np.concatenate([[0], np.cumsum(size)])
            out.append((ids[np.arange(ends[-1]) + np.repeat(at[code] - ends[:-1], size)].astype(np.int64), ends[text_at]))
        return out

    def forget(self) -> None:
        self.known, self.held = {}, 0
        self.tokens = [(np.zeros(0, np.int32), np.zeros(1, np.int64)) for _ in range(2)]

    def learn(self, words: list[str]) -> None:
        """Adds the tokens of new words, which are encoded as texts of many words and told apart by their bytes."""
        ends = np.cumsum(np.fromiter((len(w.encode("utf-8")) + 1 for w in words), np.int64, len(words)))
        found = self.lists(list(joined(words)))
        for side, (lists, sizes) in enumerate(zip(found, self.sizes)):
            ids = flattened(lists)[0]
            (old, at), stop = self.tokens[side], np.searchsorted(np.cumsum(sizes[ids]), ends) + 1
            self.tokens[side] = np.concatenate([old, ids.astype(np.int32)]), np.concatenate([at, at[-1] + stop])
        self.held += sum(map(len, words))


def joined(words: list[str]) -> Iterator[str]:
    """The words in texts of some words each, joined by BORDERs; one that begins or ends with space stays alone."""
    text: list[str] = []
    for word in words:
        alone = not word or word[0].isspace() or word[-1].isspace()
        if text and (alone or len(text) == JOINED):
            yield " ".join(text)
            text = []
        if alone:
            yield word
        else:
            text.append(word)
    if text:
        yield " ".join(text)


def separate_words(a: dict, b_file: bytes) -> bool:
    """Whether both tokenizers cut at every BORDER and encode what lies between without regard to the rest.

    A: byte-level words begin at such a space, and no token is looked for across words.  B: merges that nothing
    precedes but the space's own sign; no piece has that sign after another character.  Both give all bytes back.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2
    except (ImportError, TypeError):
        return False
    b = sentencepiece_model_pb2.ModelProto()
    b.ParseFromString(b_file)
    words, merges, how = a.get("pre_tokenizer") or {}, a["model"], b.normalizer_spec
    return (
        all(a.get(k) is None for k in ("normalizer", "truncation", "padding"))
        and (words.get("type"), words.get("add_prefix_space"), words.get("use_regex", True)) == ("ByteLevel", False, True)
        and merges.get("type", "BPE") == "BPE" and not merges.get("dropout") and merges["vocab"].keys() >= byte_letters().keys()
        and all(t["special"] for t in a.get("added_tokens") or [])
        and b.trainer_spec.model_type == b.trainer_spec.BPE and b.trainer_spec.byte_fallback and not b.trainer_spec.treat_whitespace_as_suffix
        and how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces and not how.precompiled_charsmap
        and not any(p.type == p.USER_DEFINED or re.search("[^▁]▁", p.piece) for p in b.pieces)
    )


@lru_cache(maxsize=1)
def tokenizers(a_file: bytes, b_file: bytes) -> Tokenizers:
    return Tokenizers(a_file, b_file)


def flattened(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where each text's begin and the last one's end."""
    ends = np.cumsum([0, *map(len, lists)])
    return np.fromiter(chain.from_iterable(lists), np.int64, int(ends[-1])), ends


def chosen(ids: np.ndarray, ends: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the texts that fit."""
    if fit.all():
        return ids, ends
    sizes = np.diff(ends)
    return ids[np.repeat(fit, sizes)], np.concatenate([[0], np.cumsum(sizes[fit])])


def same_bytes(pieces: pa.Array, sizes: np.ndarray, ids: np.ndarray, ends: np.ndarray, wanted: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each text's tokens are the wanted ones."""
    data = pieces.take(pa.array(ids)).buffers()[2] if len(ids) else None
    data = memoryview(data or b"").cast("B")
    at = np.concatenate([[0], np.cumsum(sizes[ids])])[ends]
    return np.array([data[at[i] : at[i + 1]] == w for i, w in enumerate(wanted)], bool)


def lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where the places of the state vector begin and end in A, and begin in B: texts, and pieces of long ones."""
    starts = [a_at[:-1]]
    for first, stop in zip(a_at[:-1], a_at[1:]):
        if stop - first > 2 * LANE:
            tried = np.minimum(np.arange(first + LANE, stop - LANE, LANE)[:, None] + np.arange(TRIED), stop - 2)
            place = np.minimum(np.searchsorted(b_ends, a_ends[tried]), len(b_ends) - 1)
            shared = b_ends[place] == a_ends[tried]
            found = shared.any(axis=1)
            starts.append(tried[found, shared.argmax(axis=1)[found]] + 1)
    start = np.unique(np.concatenate(starts))
    stop = np.append(start[1:], a_at[-1])
    # Bytes before a start end the same number of B tokens in all earlier texts and pieces.
    before = np.where(start > 0, a_ends[start - 1], 0)
    return start, stop, np.searchsorted(b_ends, before, side="right")


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, start: np.ndarray, stop: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """The groups between cuts, in order: where each begins and ends in A and in B."""
    a, b, stop = start.copy(), b_start.copy(), stop.copy()
    a_from, b_from = a.copy(), b.copy()
    found = []
    while a.size:
        x, y = a_ends[a], b_ends[b]
        a += x <= y
        b += y <= x
        cut = np.flatnonzero(x == y)
        if cut.size:
            found.append(np.stack([a_from[cut], a[cut], b_from[cut], b[cut]]))
            a_from[cut], b_from[cut] = a[cut], b[cut]
            if (a[cut] == stop[cut]).any():
                live = a != stop
                a, b, stop, a_from, b_from = a[live], b[live], stop[live], a_from[live], b_from[live]
    groups = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    return tuple(groups[:, np.argsort(groups[0])])


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs or the sum of its times."""
    if times is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    return found, np.add.reduceat(times[order], first) if len(found) else times


def links(a_ids: np.ndarray, b_ids: np.ndarray, groups: tuple[np.ndarray, ...], text: np.ndarray, a_size: int, b_size: int) -> tuple[np.ndarray, ...]:
    """Text, pair and number of the linked id pairs, from the groups and the text of each group; expanded in bounded parts.

    Text and ids are one number while they are counted.
    """
    a0, a1, b0, b1 = groups
    wide, size = b1 - b0, (a1 - a0) * (b1 - b0)
    key = lambda t, a, b: (t * a_size + a) * b_size + b
    single = np.flatnonzero(size == 1)
    parts = [counted(key(text[single], a_ids[a0[single]], b_ids[b0[single]]))]
    for g in np.flatnonzero(size > LINKS):
        # A group without an inner cut for thousands of tokens: by distinct ids.
        one, n = np.unique(a_ids[a0[g] : a1[g]], return_counts=True)
        other, m = np.unique(b_ids[b0[g] : b1[g]], return_counts=True)
        rows = max(1, LINKS // len(other))
        for i in range(0, len(one), rows):
            parts.append((key(text[g], one[i : i + rows, None], other).ravel(), (n[i : i + rows, None] * m).ravel()))
    small = np.flatnonzero((size > 1) & (size <= LINKS))
    step = np.cumsum(size[small]) // LINKS
    for chunk in np.split(small, np.flatnonzero(np.diff(step)) + 1) if len(small) else []:
        group = np.repeat(chunk, size[chunk])
        k = np.arange(len(group)) - np.repeat(np.cumsum(size[chunk]) - size[chunk], size[chunk])
        row, column = np.divmod(k, wide[group])
        parts.append(counted(key(text[group], a_ids[a0[group] + row], b_ids[b0[group] + column])))
    keys, times = counted(*(np.concatenate(x) for x in zip(*parts)))
    rest, b = np.divmod(keys, b_size)
    owner, a = np.divmod(rest, a_size)
    return owner, a * SPAN + b, times


def group_digests(both: Tokenizers, a_ids: np.ndarray, b_ids: np.ndarray, groups: tuple[np.ndarray, ...], a_at: np.ndarray, b_at: np.ndarray) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2`` per text: the ids of each group in order."""
    a0, a1, b0, b1 = groups
    sequence = np.empty(len(a_ids) + len(b_ids), np.int64)
    a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_last[a1 - 1], b_last[b1 - 1] = 1, 1
    sequence[np.arange(len(a_ids)) + np.repeat(b0, a1 - a0)] = 2 * a_ids + a_last
    sequence[np.arange(len(b_ids)) + np.repeat(a1, b1 - b0)] = both.b_from + 2 * b_ids + b_last
    written = both.texts.take(pa.array(sequence))
    ends = np.frombuffer(written.buffers()[1], np.int32, len(written) + 1)
    data = memoryview(written.buffers()[2])
    at = ends[a_at + b_at]
    return [hashlib.sha256(data[at[i] : at[i + 1] - 1]).hexdigest() for i in range(len(a_at) - 1)]


def listed(values: pa.Array, owner: np.ndarray, rows: int) -> pa.ListArray:
    """One list per row from values in the order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), values)


def align_texts(both: Tokenizers, texts: list[str | None], spans: bool) -> list[pa.Array]:
    """The result columns of some texts."""
    rows = len(texts)
    full = [i for i, t in enumerate(texts) if t]
    sides = both.encode([texts[i] for i in full])
    wanted = [(" " + texts[i]).encode("utf-8") for i in full]
    fit = np.ones(len(full), bool)
    for side, pieces, sizes in zip(sides, both.bytes, both.sizes):
        fit &= same_bytes(pieces, sizes, *side, wanted)
    row_of = np.array(full, np.int64)[fit]
    (a_ids, a_at), (b_ids, b_at) = (chosen(*side, fit) for side in sides)
    a_ends, b_ends = np.cumsum(both.sizes[0][a_ids]), np.cumsum(both.sizes[1][b_ids])
    numbers, digests = np.zeros((4, rows), np.int64), np.full(rows, "", object)
    text = pair = times = group_row = np.zeros(0, np.int64)
    groups = (np.zeros(0, np.int64),) * 4
    if len(row_of):
        groups = lockstep(a_ends, b_ends, *lanes(a_ends, b_ends, a_at, b_at))
        group_row = row_of[np.searchsorted(a_at, groups[0], side="right") - 1]
        text, pair, times = links(a_ids, b_ids, groups, group_row, *map(len, both.sizes))
        numbers[0, row_of], numbers[1, row_of] = np.diff(a_at), np.diff(b_at)
        np.add.at(numbers[2], group_row, 1)
        np.add.at(numbers[3], group_row, (groups[1] - groups[0]) * (groups[3] - groups[2]))
        digests[row_of] = group_digests(both, a_ids, b_ids, groups, a_at, b_at)
    entries = pa.StructArray.from_arrays([pa.array(pair), pa.array(times.astype(np.int32))], fields=list(LINK))
    out = [*(pa.array(n) for n in numbers), pa.array(digests, pa.string()), listed(entries, text, rows)]
    if spans:
        a_row, b_row = np.repeat(row_of, np.diff(a_at)), np.repeat(row_of, np.diff(b_at))
        place = np.searchsorted(row_of, group_row)
        cuts = [(groups[1] - a_at[place], group_row), (groups[3] - b_at[place], group_row)] if len(row_of) else [(group_row, group_row)] * 2
        out += [listed(pa.array(v.astype(np.int32)), r, rows) for v, r in [(a_ids, a_row), (b_ids, b_row), *cuts]]
    return out


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of characters."""
    start = chars = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (chars + size > SLICE_CHARS or i - start >= SLICE_TEXTS):
            yield start, i
            start, chars = i, 0
        chars += size
    if len(texts) > start:
        yield start, len(texts)


def aligned(docs: DataFrame, a_path: str, b_path: str, *, text_col: str = "text", keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the alignment of each text's tokens.

    A is a byte-level BPE in the format of the ``tokenizers`` library and reads a space and the text; B is a
    ``sentencepiece`` model, which adds the space itself.  Special tokens are neither added nor read.  Adds ``n_a`` and
    ``n_b`` tokens, ``n_groups`` between shared ends, ``n_links``, ``groups_sha256`` (of ``a1,a2|b1;a3|b2``), and ``links``:
    every linked id pair once, as A id x 2^32 + B id, with its number.  ``spans`` adds the ids of both sides
    and, for each group, its end in tokens of A and of B.  Texts that are null or empty, or that a tokenizer doesn't
    give back byte for byte, have no tokens: zeros, an empty digest, empty lists.  Columns of these names are replaced.
    The tokenizer files are read on the driver and broadcast.  Nothing is shuffled.
    """
    added = RESULT + (f", {SPANS}" if spans else "")
    new = docs.sparkSession.createDataFrame([], added).schema
    keep = [c for c in (keep or docs.columns) if c not in new.names]
    files = docs.sparkSession.sparkContext.broadcast((Path(a_path).read_bytes(), Path(b_path).read_bytes()))
    names = [*keep, *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(*files.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for start, stop in slices(texts):
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, *align_texts(both, texts[start:stop], spans)], names)

    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__align_text"))
    schema = json.loads(docs.select(*[F.col(f"`{c}`") for c in keep]).schema.json())
    schema["fields"] += json.loads(new.json())["fields"]
    return given.mapInArrow(run, type(new).fromJson(schema))


def pair_counts(rows: DataFrame) -> DataFrame:
    """Rows ``pair, n, best``: how many rows hold a linked id pair, and whether no pair of its A id has more.

    Pairs are counted before the shuffle.  An A id has at most as many pairs as B has ids.
    """
    counts = rows.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("n") == most)


def aligned_with_counts(docs: DataFrame, a_path: str, b_path: str, *, text_col: str = "text", keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """``aligned`` rows without ``links``, but with ``n_best`` and ``count_sum``.

    A pair's count is the number of rows of ``docs`` that hold it linked.  ``n_best`` counts a row's links whose count is
    the highest of their A id, ties included; ``count_sum`` adds up the counts of its links.  The most frequent
    pairs, a bounded number, are broadcast; the others, which no single pair dominates, are joined.
    """
    rows = materialize(aligned(docs, a_path, b_path, text_col=text_col, keep=keep, spans=spans).withColumn(OWN, F.monotonically_increasing_id()))
    counts = materialize(pair_counts(rows))
    least = least_count(counts, "n", HOT)
    hot, cold = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)
    each = rows.select(OWN, F.inline("links")).join(F.broadcast(hot), "pair", "left")
    found = each.where(F.col("n").isNotNull())
    if not cold.isEmpty():
        found = found.unionByName(each.where(F.col("n").isNull()).drop("n", "best").join(cold, "pair"))
    sums = found.groupBy(OWN).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    added = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in (OWN, "links", "n_best", "count_sum")]
    return rows.drop("n_best", "count_sum").join(sums, OWN, "left").select(*kept, *added)
