"""Toxicity: noisy-channel deobfuscation, then a score of the restored words.

A writer may hide a word by leetspeak (``1d10t``), spacing (``i d i o t``) or repetition (``idiooot``).
Suspect passages become character lattices whose edges say what each character may stand for and at what
cost; Viterbi decoding under a character trigram model picks the cheapest reading.  The model is counted
over all documents.  All other words have one reading and are left alone.

The scorer learns from labelled rows: for words and word beginnings, the share of toxic documents among
those that hold them, as a lower confidence bound, so a few chance hits don't count.  The strongest are
taken one by one, and toxic documents that one of them explains no longer count for the others.  A
document's score combines its two strongest words, whatever its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.session import materialize

#: Labelled rows the scorer learns from at most, chosen by a hash of the id.
FIT_ROWS = 20_000
#: Standard deviations of the lower confidence bound, and the least share that counts as evidence.
SURE = 3.0
LEAST = 0.25
ALONE = 0.65
THRESHOLD = 0.3
#: Texts scored at once.
SLICE = 400
#: Texts whose words are taken apart at once while learning; a text has some thousand parts.
FEW = 100
PREFIXES = (4, 5, 6, 7, 8)

#: What a character may stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "µ": "u",
}
SEPARATORS = " .-_*~'"
LEET_COST, KEEP_COST, DROP_COST, SHRINK_COST = -1.5, -6.0, -0.7, -0.7
#: A space in a spaced run may be a border of words as well as one of letters.
BORDER_COST = -0.7

#: The model's alphabet: 0 is everything outside words, the last code any other letter.
LETTERS = [c for c in map(chr, range(0x180)) if c.isalpha() and c == c.lower() and unicodedata.category(c) != "Lo"]
CODES = {c: i + 1 for i, c in enumerate(LETTERS)}
SIZE = len(LETTERS) + 2

WORD = re.compile(r"[^\W\d_]+")
#: A token with leet characters beside a letter, separators between single letters, or three of a letter.
SUSPECT = re.compile(r"[^\W\d_][0-9@$!|+(€£µ*]|[0-9@$|+(€£µ*][^\W\d_]|(?<!\w)[^\W\d_](?:[.\-_*~'][^\W\d_]){2,}(?!\w)")
REPEATED = re.compile(r"([^\W\d_])\1\1")
#: A repeated letter whose occurrences are separated.
APART = re.compile(r"([^\W\d_])(?:[ .\-_*~']\1){2,}")
#: What stands between the words that are glued into one token: everything that can't stand for a letter.
MARKS = re.compile(r"[^\w@$!|+(€£µ*]+|[_*]+")
EDGE = " .,;:?!\"'()[]{}<>-_*~"
#: What can stand for no letter at an edge; the rest of ``EDGE`` is tried as a letter too.
BARE = "".join(c for c in EDGE if c not in LEET)
LETTER = re.compile(r"[^\W\d_]")
HIDING = re.compile(r"([^\W\d_])\1|[" + re.escape("".join(LEET) + SEPARATORS) + "]")
MEMBERS = set(LEET) | set(SEPARATORS)
LEET_SIGN = re.compile("[" + re.escape("".join(LEET)) + "]")
#: Passages of a word's chunks (``id iot``) are runs of tokens up to this long.
CHUNK = 3


def kin() -> dict[int, str | None]:
    """A translation of characters that may stand for each other to one of them; separators vanish."""
    groups: list[set[str]] = []
    for c, letters in LEET.items():
        joined = {c, *letters}.union(*(g for g in groups if g & {c, *letters}))
        groups = [g for g in groups if not g & joined] + [joined]
    table: dict[int, str | None] = {ord(c): min(x for x in g if x.isalpha()) for g in groups for c in g}
    return table | {ord(c): None for c in SEPARATORS}


KIN = kin()


def skeletons(tokens: list[str]) -> list[str]:
    """What all readings of a token share: kin letters as one, without repetition and separators.

    Every word of a reading has its skeleton within that of the token, since a lattice only exchanges kin, repeats
    or shrinks runs, and drops separators.  Tokens hold no line feeds.
    """
    return re.sub(r"(.)\1+", r"\1", "\n".join(tokens).translate(KIN)).split("\n") if tokens else []


def may_hold(parts: Iterable[str]) -> Callable[[list[str]], np.ndarray]:
    """A test which of some tokens can have a word with one of ``parts`` in any reading; the others needn't be decoded."""
    shapes = set(skeletons([p.rstrip("$") for p in parts]))
    least = sorted(x for x in shapes if not any(x[i:j] in shapes for i in range(len(x)) for j in range(i + 1, len(x) + 1) if j - i < len(x)))
    pattern = "|".join(map(re.escape, least))

    def test(tokens: list[str]) -> np.ndarray:
        if not least or not tokens:
            return np.zeros(len(tokens), bool)
        return pc.match_substring_regex(pa.array(skeletons(tokens), pa.string()), pattern).to_numpy(zero_copy_only=False)

    return test


def code_table() -> np.ndarray:
    """The code of every code point below 0x180, of other letters' and of the rest, by position."""
    table = np.zeros(0x182, np.int64)
    for c in map(chr, range(0x180)):
        table[ord(c)] = CODES.get(c.lower(), SIZE - 1 if c.isalpha() else 0)
    table[0x180] = SIZE - 1
    return table


def trigram_counts(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigram codes of a text and their counts; runs outside words count as one border."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    codes = table[np.minimum(points, 0x180)]
    codes = np.concatenate([[0], codes[(codes > 0) | (np.roll(codes, 1) > 0)], [0, 0]])
    return np.unique((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], return_counts=True)


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities [SIZE, SIZE, SIZE] of a letter after two others, counted over all texts.

    Each task sends its sums per trigram, so what is shuffled is bounded per task and what is collected
    by the alphabet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = code_table(), np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                code, n = trigram_counts(text.as_py() or "", table)
                total[code] += n
        code = np.flatnonzero(total)
        for start in range(0, len(code), 10_000):
            part = code[start : start + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["code", "n"])

    rows = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**3)
    counts[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    counts = counts.reshape(SIZE, SIZE, SIZE)
    pair = counts.sum(axis=0) + 0.1
    back = pair / pair.sum(axis=1, keepdims=True)
    return np.log((counts + 2.0 * back) / (counts.sum(axis=2, keepdims=True) + 2.0)).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for and the channel's cost."""
    steps: list[list[tuple[str, float]]] = []
    for m in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, n = m[1], len(m[0])
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options = [(c * k, SHRINK_COST * (k < n)) for k in {1, min(2, n), n}]
        else:
            options.append((m[0], KEEP_COST if c != " " else BORDER_COST))
            if c in LEET:
                options += [(x * k, LEET_COST * n + SHRINK_COST * (k < n)) for x in LEET[c] for k in {1, min(2, n)}]
            if c in SEPARATORS:
                options.append(("", DROP_COST))
        steps.append(options)
    return steps


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a token of any length: Viterbi over its lattice, states being the last two letters.

    A state holds its reading as a chain of pieces, so that a step costs the same wherever it is.
    """
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        coded = [(out, cost, [CODES.get(c, SIZE - 1 if c.isalpha() else 0) for c in out]) for out, cost in options]
        for (a, b), (score, chain) in states.items():
            for out, cost, codes in coded:
                x, y, s = a, b, score + cost
                for z in codes:
                    if z or y:
                        s += model.item(x, y, z)
                        x, y = y, z
                if (x, y) not in after or s > after[x, y][0]:
                    after[x, y] = (s, (chain, out))
        states = after
    _, _, chain = min(((-s - model.item(a, b, 0) * (b > 0), (a, b), chain) for (a, b), (s, chain) in states.items()), key=lambda e: e[:2])
    text = []
    while chain:
        chain, out = chain
        text.append(out)
    return "".join(reversed(text))


def suspect(token: str) -> bool:
    """Whether a token may hide a word."""
    return not token.isalpha() and bool(SUSPECT.search(token.strip(EDGE))) or bool(REPEATED.search(token))


def tokens(texts: pa.Array, wanted: Callable[[list[str]], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The distinct (row, token) pairs of lower-cased texts as two arrays, and the tokens they number.

    Tokens stand between white space; a run of three and more single letters is a token of its own, its
    letters joined by spaces, beside the letters.  So is a run of single letters, leet characters and
    separators.  With ``wanted`` only tokens that it wants are returned, and runs of short tokens, which may be
    a word's chunks, are tokens too.
    """
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    values = split.flatten()
    row = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    coded = values.dictionary_encode()
    vocabulary, code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)

    def runs(fits: list[bool], least: int = 3) -> list[np.ndarray]:
        at = np.flatnonzero(np.array(fits, bool)[code]) if vocabulary else np.empty(0, np.int64)
        cut = np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0)) + 1) if len(at) >= least else []
        return [r for r in cut if len(r) >= least]

    letters = [len(t) == 1 and t.isalpha() for t in vocabulary]
    members = [x or t in MEMBERS for t, x in zip(vocabulary, letters, strict=True)]
    mixed = [r for r in runs(members) if not all(letters[code[i]] for i in r)]
    chunks = runs([len(t) <= CHUNK for t in vocabulary], 2) if wanted else []
    spaced = [(row[r[0]], " ".join(vocabulary[code[i]] for i in r)) for r in runs(letters) + mixed + chunks]
    if wanted:
        fits = wanted([t for _, t in spaced])
        spaced = [x for x, fit in zip(spaced, fits.tolist(), strict=True) if fit]
        keep = wanted(vocabulary)
        place = np.cumsum(keep) - 1
        row, code = row[keep[code]], place[code[keep[code]]] if len(code) else code
        vocabulary = [t for t, k in zip(vocabulary, keep.tolist(), strict=True) if k]
    key = np.unique(row * max(len(vocabulary), 1) + code)
    row, code = np.divmod(key, max(len(vocabulary), 1))
    row = np.concatenate([row, np.array([r for r, _ in spaced], np.int64)])
    code = np.concatenate([code, len(vocabulary) + np.arange(len(spaced))])
    return row, code, vocabulary + [t for _, t in spaced]


def reading(token: str, model: np.ndarray) -> str:
    """A token as it is, or decoded where it is suspect."""
    if " " in token:
        return decode(token, model)
    if not suspect(token):
        return token
    core = token.strip(EDGE)
    return token.replace(core, decode(core, model), 1)


def restore(text: str | None, model: np.ndarray) -> str:
    """The lower-cased text, white space as single spaces, with suspect passages decoded."""
    text = re.sub(r"(?<!\S)[^\W\d_](?: [^\W\d_]){2,}(?!\S)", lambda m: reading(m[0], model), " ".join((text or "").lower().split()))
    return " ".join(reading(t, model) for t in text.split(" "))


def parts(word: str) -> list[str]:
    """A word's features: itself, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def bound(toxic: float, clean: float, sure: float = SURE) -> float:
    """Lower confidence bound (Wilson) of the toxic share."""
    n, z = toxic + clean, sure * sure
    p = toxic / n
    return (p + z / (2 * n) - sure * math.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def least_bound(toxic: Column, clean: Column) -> Column:
    """``bound`` as a column."""
    n, z = (toxic + clean).cast("double"), SURE * SURE
    p = toxic / n
    return (p + z / (2 * n) - SURE * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def words(token: str, model: np.ndarray) -> list[str]:
    """The words of a token's readings.

    Beside the main reading there are those of its pieces between marks, where it has several, and those the
    lattice has for doubled letters, for leet characters at the edges and for any separators: they add words
    to a clean token's own and take none away.
    """
    found = WORD.findall(reading(token, model))
    pieces = [] if " " in token or not suspect(token) else [x for x in MARKS.split(token) if x]
    if len(pieces) > 1:
        found += [w for x in pieces for w in WORD.findall(reading(x, model))]
    if " " not in token and (LETTER.search(token) or LEET_SIGN.search(token)):
        core = token.strip(BARE)
        cores = {core, core.lstrip(EDGE), core.rstrip(EDGE), core.strip(EDGE)}
        done = {core.strip(EDGE)} if suspect(token) else set()
        found += [w for x in sorted(cores - done) if HIDING.search(x) for w in WORD.findall(decode(x, model))]
    if APART.search(token):
        found += WORD.findall(decode(APART.sub(lambda m: m[0][::2], token), model))
    return found


def strength(word: str, evidence: dict[str, float]) -> float:
    return max(evidence.get(p, 0.0) for p in parts(word))


#: What most tokens hold; shared, as so many are remembered.
NOTHING: dict[str, float] = {}


class Reader:
    """Looks up the words of tokens, or what a function makes of them; remembers a bounded number of tokens."""

    def __init__(self, model: np.ndarray, make: object, most: int = 300_000) -> None:
        self.model, self.make, self.most, self.known = model, make, most, {}

    def __call__(self, token: str) -> object:
        if token not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[token] = self.make(words(token, self.model))
        return self.known[token]


def scores(texts: pa.Array, strong_words: Reader, wanted: Callable[[list[str]], np.ndarray]) -> np.ndarray:
    """Per text 1 less the product of 1 less the two strongest words' shares; 0 without any."""
    row, code, vocabulary = tokens(texts, wanted)
    found = [strong_words(t) for t in vocabulary]
    holds = np.array([bool(f) for f in found], bool)
    by_row: dict[int, dict[str, float]] = {}
    for r, c in zip(row[holds[code]].tolist(), code[holds[code]].tolist(), strict=True):
        by_row.setdefault(r, {}).update(found[c])
    out = np.zeros(len(texts))
    for r, strong in by_row.items():
        first, second, *_ = [*sorted(strong.values(), reverse=True), 0.0]
        out[r] = 1 - (1 - first) * (1 - second)
    return out


def strong(evidence: dict[str, float]) -> object:
    """A function that keeps of some words those with evidence, and how much."""
    return lambda found: {w: v for w in found if (v := strength(w, evidence)) > 0} or NOTHING


def incidence(texts: pa.Array, numbers: Reader) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a row and a number that ``numbers`` gives for one of its words."""
    row, code, vocabulary = tokens(texts)
    lists = [numbers(t) for t in vocabulary]
    size = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter((n for x in lists for n in x), np.int64, int(size.sum()))
    start = np.cumsum(size) - size
    rows = np.repeat(row, size[code])
    at = np.arange(len(rows)) - np.repeat(np.cumsum(size[code]) - size[code], size[code]) + np.repeat(start[code], size[code])
    most = int(flat.max(initial=0)) + 1
    return np.divmod(np.unique(rows * most + flat[at]), most)


def in_order(names: dict[str, int], size: int = 20_000) -> Iterator[tuple[int, list[str]]]:
    """Names in order, some at a time, with the place of the first."""
    entries = iter(names)
    at = 0
    while few := list(islice(entries, size)):
        yield at, few
        at += len(few)


def learn(labelled: DataFrame, model: np.ndarray) -> dict[str, float]:
    """The evidence of word parts, from a bounded number of rows ``row_id, text, toxic`` (0 or 1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                number: dict[str, int] = {}
                numbers = Reader(model, lambda found: tuple({number.setdefault(p, len(number)) for w in found for p in parts(w)}))  # noqa: B023
                held = np.zeros((2, 0), np.int64)
                for few in (piece.slice(i, FEW) for i in range(0, piece.num_rows, FEW)):
                    row, part = incidence(few.column("text"), numbers)
                    toxic = few.column("toxic").to_numpy()[row]
                    counts = np.stack([np.bincount(part[toxic == k], minlength=len(number)) for k in (0, 1)])
                    counts[:, : held.shape[1]] += held
                    held = counts
                yield from (pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *map(pa.array, held[:, at : at + len(names)])], ["part", "clean", "toxic"]) for at, names in in_order(number))
            pa.default_memory_pool().release_unused()

    counts = labelled.select("text", "toxic").mapInArrow(count, "part string, clean long, toxic long")
    counted = counts.groupBy("part").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # The share itself is above its lower bound, and a share of a quarter needs three rows at least.
    likely = counted.where(F.col("toxic") >= 3).where(least_bound(F.col("toxic"), F.col("clean")) > LEAST - 1e-6)
    # Of a bounded number of texts.
    clean = {r["part"]: r["clean"] for r in likely.collect() if bound(r["toxic"], r["clean"]) >= LEAST}
    number = {p: i for i, p in enumerate(sorted(clean))}

    def list_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Reader(model, lambda found: [number[p] for w in found for p in parts(w) if p in number])
        for batch in batches:
            for few in (batch.slice(i, FEW) for i in range(0, batch.num_rows, FEW)):
                row, part = incidence(few.column("text"), numbers)
                yield pa.RecordBatch.from_arrays([few.column("row_id").take(pa.array(row)), pa.array(part)], ["row_id", "part"])

    holds: dict[int, set] = {}
    for r in labelled.where("toxic = 1").select("row_id", "text").mapInArrow(list_toxic, "row_id long, part long").collect():
        holds.setdefault(r["part"], set()).add(r["row_id"])
    return explained({p: holds.get(i, set()) for p, i in number.items()}, clean)


def explained(holds: dict[str, set], clean: dict[str, int]) -> dict[str, float]:
    """Parts chosen by falling evidence, from the toxic rows and the number of clean rows that hold them.

    Toxic rows of a chosen part say nothing new about its beginnings and endings (``lose`` of ``loser``).
    Toxic rows of any chosen part count for a further one only if that has ``ALONE`` by itself: a word that
    happens to stand in a few of them doesn't.
    """
    chosen: dict[str, float] = {}
    gone: set = set()
    for p in sorted(holds, key=lambda p: (-bound(len(holds[p]), clean[p]) if holds[p] else 0.0, -len(p), p)):
        related = [q for q in chosen if q.startswith(p) or p.rstrip("$").startswith(q)]
        own = holds[p].difference(*(holds[q] for q in related))
        if not own or (value := bound(len(own), clean[p])) < LEAST:
            continue
        new = own - gone
        if value >= ALONE or new and bound(len(new), clean[p]) >= LEAST:
            chosen[p] = value
            gone |= holds[p]
    return chosen


def fit_sample(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, fit_rows: int) -> DataFrame:
    """Rows ``row_id, text, toxic`` of at most ``fit_rows`` labelled training documents, chosen by a hash of the id."""
    rows = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).where("label_id is not null and toxic in (0, 1)")
    one = rows.groupBy("label_id").agg(F.max("toxic").alias("toxic")).where(training)
    chosen = one.orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows)
    return docs.join(F.broadcast(chosen), docs[id_col] == chosen["label_id"]).select(F.col("label_id").cast("long").alias("row_id"), "text", "toxic")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``toxicity_score`` and ``toxicity_predicted`` (0 or 1).

    Rows whose crc32 of the id as text is 2 modulo 4 are held out and never learnt from; a null id is not
    held out and, having no label, not learnt from either.  Null, empty and wordless texts score 0; so does
    everything where no label can be learnt from.  Of several labels for an id the toxic one counts.  Added
    columns replace columns of the same name.
    """
    rest = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) == 2
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    model = language_model(texts)
    # Read once and stored: the sample is learnt from in one pass, whatever it was derived from.
    sample = materialize(fit_sample(texts, labels, ~rest(F.col("label_id")), id_col, fit_rows).repartition(64))
    evidence = learn(sample, model)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, evidence))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, evidence = shared.value
        strong_words, wanted = Reader(model, strong(evidence)), may_hold(evidence)
        for texts in batches:
            yield pa.array(np.concatenate([scores(texts.slice(i, SLICE), strong_words, wanted) for i in range(0, len(texts), SLICE)] or [np.zeros(0)]))
            pa.default_memory_pool().release_unused()

    out = docs.withColumn("held_out", F.coalesce(rest(F.col(id_col)), F.lit(False))).withColumn("toxicity_score", scored(F.col(text_col)))
    return out.withColumn("toxicity_predicted", (F.col("toxicity_score") >= threshold).cast("int"))
