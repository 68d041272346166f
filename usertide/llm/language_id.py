"""Language identification: word-first backoff.

A known word scores by its log frequency in each language.  An unseen word falls back to the log frequencies
of its character n-grams, of the longest length of which any is known.  Frequencies are counted over all
training rows, and every counted word and n-gram is used: both lists are Spark tables.  Each distinct word of
the documents is scored once.  The most frequent words are added up where the documents are read, as a bounded
number of them is broadcast; the others are joined.  Scores are scaled integers, so neither the order of
additions nor the number of broadcast words changes a result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.llm.words import least_count, words_of
from usertide.session import materialize

#: Words, and n-grams, that are broadcast at most (fewer for many languages), and texts with copies; the rest is joined.
HOT = 150_000
COPIED = 10_000
LONGEST = 5
#: Log frequencies are summed as integers, this many to 1.
SCALE = 2**24
#: Texts or words read at once, and entries a task holds before it sends them on.
SLICE = 1000
HELD = 200_000
SMOOTH = 0.5
UNKNOWN = "und"


def grams(word: str, n: int) -> list[str]:
    """The character n-grams of a word between border marks."""
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def emitted(found: dict[str | None, Counter]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, word, n`` in small batches."""
    for lang, counts in found.items():
        entries = iter(counts.items())
        while part := list(islice(entries, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array([w for w, _ in part], pa.string()), pa.array([k for _, k in part], pa.int64())], ["lang", "word", "n"])


def word_counts(rows: DataFrame) -> DataFrame:
    """Rows ``lang, word, n`` from rows ``text, lang``, null being a language too; counted per task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Counter] = {}
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                langs = piece.column("lang").to_pylist()
                for lang in set(langs):
                    texts = piece.column("text").filter(pa.array([x == lang for x in langs]))
                    _, code, vocabulary = words_of(texts)
                    counts = found.setdefault(lang, Counter())
                    for word, k in zip(vocabulary.to_pylist(), np.bincount(code, minlength=len(vocabulary)).tolist(), strict=True):
                        if word:
                            counts[word] += k
                if sum(map(len, found.values())) > HELD:
                    yield from emitted(found)
                    found = {}
        yield from emitted(found)

    return rows.select("text", "lang").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(counted: DataFrame) -> DataFrame:
    """Rows ``lang, word, n`` where ``word`` is a character n-gram, from the counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Counter] = {}
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                for lang, word, k in zip(*(piece.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                    counts = found.setdefault(lang, Counter())
                    for n in range(1, LONGEST + 1):
                        for g in grams(word, n):
                            counts[g] += k
                if sum(map(len, found.values())) > HELD:
                    yield from emitted(found)
                    found = {}
        yield from emitted(found)

    return counted.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies by word and n-gram, an array entry for each language in order; the same as ``Tables``, in memory."""

    def __init__(self, langs: list[str], words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]]) -> None:
        self.langs = langs
        self.words, self.grams = self.logs(words), self.logs(grams)

    def logs(self, counts: dict[str, dict[str, int]]) -> dict[str, np.ndarray]:
        total = np.ones(len(self.langs))
        table = {}
        for key, by_lang in counts.items():
            table[key] = np.array([by_lang.get(x, 0) for x in self.langs], np.float64) + SMOOTH
            total += table[key]
        return {k: np.log(v / total).astype(np.float32) for k, v in table.items()}

    def word(self, word: str) -> np.ndarray:
        if (known := self.words.get(word)) is not None:
            return known
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            if found := [v for g in grams(word, n) if (v := self.grams.get(g)) is not None]:
                return np.mean(found, axis=0)
        return np.zeros(len(self.langs), np.float32)


@dataclass
class Tables:
    """Scaled log frequencies of all words and of all n-grams: rows ``word, n`` and a column for each language in order."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame

    @property
    def columns(self) -> list[str]:
        return [f"v{i}" for i in range(len(self.langs))]


def logs(counted: DataFrame, langs: list[str]) -> DataFrame:
    """A table of ``Tables`` from rows ``lang, word, n``."""
    each = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"v{i}") for i, x in enumerate(langs)]
    by_word = materialize(counted.groupBy("word").agg(F.sum("n").alias("n"), *each))
    total = by_word.agg(F.count(F.lit(1)).alias("rows"), *(F.sum(f"v{i}").alias(f"v{i}") for i in range(len(langs)))).first()
    log = lambda v: F.round(F.log((F.col(v) + SMOOTH) / (1 + (total[v] or 0) + SMOOTH * total["rows"])) * SCALE).cast("long").alias(v)
    return by_word.select("word", "n", *(log(f"v{i}") for i in range(len(langs))))


def fit_counts(counted: DataFrame) -> Tables:
    """A model from rows ``lang, word, n`` of a stored table."""
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    return Tables(langs, logs(counted, langs), logs(gram_counts(counted), langs))


def fit(rows: DataFrame) -> Tables:
    """A model from all rows ``text, lang`` with neither null."""
    return fit_counts(materialize(word_counts(rows.where("text is not null and lang is not null"))))


def most_frequent(table: DataFrame, columns: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The place of each of the most frequent words of a table, and the values there; a bounded number."""
    most = HOT * 10 // max(len(columns), 10)
    rows = table.where(F.col("n") >= least_count(table, "n", most)).select("word", *columns).toArrow()
    values = [rows.column(c).to_numpy().astype(np.int64) for c in columns]
    return {w: i for i, w in enumerate(rows.column("word").to_pylist())}, np.stack(values, axis=1) if values else np.zeros((rows.num_rows, 0), np.int64)


def backoff(words: DataFrame, model: Tables) -> DataFrame:
    """Rows ``word`` with the mean of the n-grams of the longest length of which any is known; words without any are missing.

    Frequent n-grams are added up at once, and lengths below one with any of them aren't needed.
    """
    columns, size = model.columns, len(model.langs)
    shared = words.sparkSession.sparkContext.broadcast(most_frequent(model.grams, model.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = shared.value
        none = np.zeros(size, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                rows: list[tuple] = []
                sums: list[np.ndarray] = []
                for word in batch.column(0).slice(start, SLICE).to_pylist():
                    for n in range(min(LONGEST, len(word) + 2), 0, -1):
                        counts = Counter(grams(word, n))
                        hot = [(place[g], k) for g, k in counts.items() if g in place]
                        for g, k in counts.items():
                            if g not in place:
                                rows.append((word, n, g, k))
                                sums.append(none)
                        if hot:
                            rows.append((word, n, None, sum(k for _, k in hot)))
                            sums.append(np.array([k for _, k in hot]) @ values[[i for i, _ in hot]])
                            break
                table = np.stack(sums, axis=1) if sums else np.zeros((size, 0), np.int64)
                head = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array(v) for v in table)], ["word", "size", "gram", "k", *columns])

    found = materialize(words.select("word").mapInArrow(run, "word string, size int, gram string, k long" + "".join(f", {c} long" for c in columns)))
    table = model.grams.select(F.col("word").alias("gram"), *(F.col(c).alias(f"g{c}") for c in columns))
    joined = found.where("gram is not null").select("word", "size", "gram", "k").join(table, "gram").select("word", "size", "k", *((F.col("k") * F.col(f"g{c}")).alias(c) for c in columns))
    by_size = found.where("gram is null").select("word", "size", "k", *columns).union(joined).groupBy("word", "size").agg(F.sum("k").alias("k"), *(F.sum(c).alias(c) for c in columns))
    longest = by_size.groupBy("word").agg(F.max(F.struct("size", "k", *columns)).alias("one"))
    return longest.select("word", *(F.round(F.col(f"one.{c}") / F.col("one.k")).cast("long").alias(c) for c in columns))


def word_scores(used: DataFrame, model: Tables) -> DataFrame:
    """Rows ``word, n`` with a column for each language, stored."""
    columns = model.columns
    if not columns:
        return used
    joined = materialize(used.join(model.words.select("word", *columns), "word", "left"))
    unseen = joined.where("v0 is null").select("word", "n")
    backed = unseen.join(backoff(unseen, model), "word", "left").select("word", "n", *(F.coalesce(c, F.lit(0)).alias(c) for c in columns))
    return materialize(joined.where("v0 is not null").union(backed))


def text_sums(texts: DataFrame, scored: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``digest, copies, letters`` and a column for each language from rows ``digest, text``, one for each distinct text."""
    size = len(columns)
    shared = texts.sparkSession.sparkContext.broadcast(most_frequent(scored, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = shared.value
        for batch in batches:
            for piece in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                rows = piece.num_rows
                row, code, vocabulary = words_of(piece.column("text"))
                at = np.array([place.get(w, -1) for w in vocabulary.to_pylist()], np.int64)[code]
                hot, hot_row = at[at >= 0], row[at >= 0]
                sums = [np.bincount(hot_row, weights=values[hot, k], minlength=rows).astype(np.int64) for k in range(size)]
                many = max(len(vocabulary), 1)
                pair, n = np.unique(row[at < 0] * many + code[at < 0], return_counts=True)
                offsets = pa.array(np.searchsorted(pair, np.arange(rows + 1) * many), pa.int32())
                pairs = pa.StructArray.from_arrays([vocabulary.take(pa.array(pair % many)), pa.array(n.astype(np.int64))], ["word", "n"])
                letters = pa.array(np.bincount(row, minlength=rows))
                yield pa.RecordBatch.from_arrays([piece.column("digest"), letters, pa.ListArray.from_arrays(offsets, pairs), *map(pa.array, sums)], ["digest", "letters", "cold", *columns])

    schema = "digest binary, letters long, cold array<struct<word: string, n: long>>" + "".join(f", {c} long" for c in columns)
    first = [F.first(c).alias(c) for c in ("letters", "cold", *columns)]
    read = materialize(texts.where("text is not null").select("digest", "text").mapInArrow(run, schema).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), *first))
    pairs = read.select("digest", F.explode("cold").alias("c")).select("digest", "c.word", F.col("c.n").alias("k")).join(scored.select("word", *columns), "word")
    zero = [F.lit(0).cast("long").alias(c) for c in ("copies", "letters")]
    rows = read.select("digest", "copies", "letters", *columns).union(pairs.select("digest", *zero, *((F.col("k") * F.col(c)).alias(c) for c in columns)))
    return rows.groupBy("digest").agg(*(F.sum(c).alias(c) for c in ("copies", "letters", *columns)))


def identify(docs: DataFrame, model: Tables, *, text_col: str = "text", used: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score``, the predicted language's share of the odds.

    Null texts and texts without a letter are ``und`` with score 0, as is everything where nothing was
    learnt.  Of equal languages the first by name wins.  Added columns replace columns of the same name.
    ``used`` has the distinct words of ``docs`` as rows ``word, n`` where they have been counted already.
    """
    if not model.langs:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("lang_score", F.lit(0.0))
    digest = F.unhex(F.md5(F.col(text_col).cast("binary")))
    texts = docs.select(digest.alias("digest"), F.col(text_col).alias("text"))
    if used is None:
        used = word_counts(texts.select("text", F.lit(None).cast("string").alias("lang"))).select("word", "n")
    sums = text_sums(texts, word_scores(used, model), model.columns)
    total = F.array(*model.columns)
    best = F.array_max(total)
    odds = F.aggregate(F.transform(total, lambda x: F.exp((x - best) / SCALE)), F.lit(0.0), lambda a, x: a + x)
    lang = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position(total, best).cast("int"))
    results = materialize(sums.where("letters > 0").select("digest", "copies", F.struct(lang.alias("lang"), (1 / odds).alias("score")).alias("found")))
    # Texts with many copies are few and broadcast, so that no key of the join that deals rows out is frequent.
    copied = results.where(F.col("copies") >= max(least_count(results, "copies", COPIED), 16)).select(F.col("digest").alias("__digest"), F.col("found").alias("__copied"))
    own = results.select(F.col("digest").alias("__key"), F.col("found").alias("__found"))
    # Rows that need no join get a key that is no digest.
    none = F.monotonically_increasing_id().cast("string").cast("binary")
    key = F.when(F.col("__copied").isNull() & F.col("__digest").isNotNull(), F.col("__digest")).otherwise(F.concat(F.lit("row ").cast("binary"), none))
    out = docs.withColumn("__digest", digest).join(F.broadcast(copied), "__digest", "left").withColumn("__key", key).join(own, "__key", "left")
    found = F.coalesce("__copied", "__found")
    out = out.withColumn("lang_pred", F.coalesce(found["lang"], F.lit(UNKNOWN))).withColumn("lang_score", F.coalesce(found["score"], F.lit(0.0)))
    return out.drop("__digest", "__copied", "__key", "__found")


def held_out(id_col: Column) -> Column:
    """Whether the crc32 of an id as text is 0 modulo 5; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``identify`` for ``docs`` by a model of their own rows that aren't held out, with a column ``held_out``."""
    lang = F.when(~held_out(F.col(id_col)), F.col(lang_col).cast("string"))
    counted = materialize(word_counts(docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), lang.alias("lang"))))
    model = fit_counts(counted.where("lang is not null"))
    used = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return identify(docs, model, text_col=text_col, used=used).withColumn("held_out", held_out(F.col(id_col)))
