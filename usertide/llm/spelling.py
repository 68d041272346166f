"""Spelling variants by permuterm rotations.

A word ends with a terminator and is rotated to every start.  Two words that differ in one replaced letter have
rotations that differ only in their last letter, and a word that lacks one letter has a rotation that is the rest
of such a rotation.  So all rotations are sorted by what remains without the edited letter, and words that are one edit
apart stand next to each other: a group holds at most one word that lacks the letter, then one word per
letter of the alphabet.  A task scans its range of the sorted rotations and emits the neighbours it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.session import materialize

#: Ends each word; not a letter of any word.
END = "$"
#: The letters of a run, and its capitals that are lower-cased.
RUN = "[a-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of sorted rotations scanned at once.
SLICE = 20_000
NAMES = ["word", "near", "near_n"]


def words_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 5, slip: int = 97) -> DataFrame:
    """Rows ``word``, one per run of at least ``least`` letters of a text, capitals A-Z lower-cased.

    A run whose checksum (crc32 of ``<id>:<run>``, a null id being empty) is divisible by ``slip`` loses
    one letter; it is left out if fewer than ``least`` remain.  Null and empty texts have no runs.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    check = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return check.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 5, slip: int = 97, seen: int = 3) -> DataFrame:
    """Rows ``word, n``: the distinct words of ``words_of`` that occur at least ``seen`` times; counted before the shuffle."""
    return words_of(docs, id_col=id_col, text_col=text_col, least=least, slip=slip).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= seen)


def rotations(words: DataFrame) -> DataFrame:
    """Rows ``rest, letter, word, n``: every rotation as it is, with no letter, and without its last letter.

    The terminator is never the edited letter.
    """
    marked = F.concat("word", F.lit(END))
    turned = F.transform(F.sequence(F.lit(1), F.length(marked)), lambda i: F.concat(F.substring(marked, i, F.length(marked)), F.substring(marked, F.lit(1), i - 1)))
    each = words.select("word", "n", F.explode(turned).alias("turn"))
    cut = F.struct(F.expr("left(turn, length(turn) - 1)").alias("rest"), F.right("turn", F.lit(1)).alias("letter"))
    whole = F.struct(F.col("turn").alias("rest"), F.lit("").alias("letter"))
    both = F.when(F.endswith("turn", F.lit(END)), F.array(whole)).otherwise(F.array(whole, cut))
    return each.select("word", "n", F.explode(both).alias("r")).select("r.rest", "r.letter", "word", "n")


def met(table: pa.Table) -> pa.RecordBatch:
    """The neighbours within the groups of a sorted slice, in both directions."""
    rest = table.column("rest").combine_chunks()
    new = np.concatenate([[True], pc.not_equal(rest[1:], rest[:-1]).to_numpy(zero_copy_only=False)]) if len(rest) else np.zeros(0, bool)
    group = np.cumsum(new)
    letter = table.column("letter").combine_chunks()
    # A letter that repeats the one before it gives the same shorter word at several places; one of them counts.
    doubled = pc.equal(letter, pc.utf8_slice_codeunits(rest, -1)).to_numpy(zero_copy_only=False)
    whole = pc.equal(letter, "").to_numpy(zero_copy_only=False)
    left, right, step = [], [], 1
    at = np.arange(len(rest))
    while (at := at[at + step < len(rest)][group[at[at + step < len(rest)]] == group[at[at + step < len(rest)] + step]]).size:
        kept = at[~(whole[at] & doubled[at + step])]
        left.append(kept)
        right.append(kept + step)
        step += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    return pa.RecordBatch.from_arrays([word.take(pa.array(one)), word.take(pa.array(other)), n.take(pa.array(other))], NAMES)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks through the sorted rotations of a task; a group that a slice cuts waits for the next slice."""
    held: pa.Table | None = None
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            now = pa.Table.from_batches([batch.slice(start, SLICE)])
            now = pa.concat_tables([held, now]).combine_chunks() if held is not None else now
            last = now.column("rest")[-1]
            open_from = pc.index(now.column("rest"), last).as_py()
            yield met(now.slice(0, open_from))
            held = now.slice(open_from)
    if held is not None:
        yield met(held)


def neighbours(words: DataFrame) -> DataFrame:
    """Rows ``word, near, near_n`` for every two words that differ by one inserted, deleted or replaced letter, both ways, once.

    ``words`` has distinct ``word``, without the terminator, and ``n``.  No words give no rows.
    """
    turned = rotations(words)
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_turns = turned.repartitionByRange(tasks, "rest").sortWithinPartitions("rest", "letter")
    return sorted_turns.mapInArrow(scan, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """Rows ``word, root`` from rows ``word, form``: the last word that is reached by going from form to form.

    Each round doubles the way a row has gone.  Forms must lead nowhere in a circle; here they grow in frequency.
    """
    way = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = materialize(way.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        way = gone.select("word", "root")
        if gone.where("moved").isEmpty():
            return way


def spelling_groups(words: DataFrame, *, ratio: float = 2) -> DataFrame:
    """Rows ``word, form, root, n, n_near, form_n`` of rows ``word, n``.

    ``n_near`` counts the words one edit away.  ``form`` is the most frequent of them (the smallest in
    code-point order on a tie) if it occurs at least ``ratio`` times as often as the word, ``form_n`` its count, else both
    are null.  ``root`` is the last form of the chain, the word itself without one; words with one root form a group.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near"))).alias("best")
    found = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(found, "word", "left")
    frequent = -F.col("best.order") >= F.lit(ratio) * F.col("n")
    chosen = materialize(joined.select("word", F.when(frequent, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("best.order")).alias("form_n")))
    ends = roots(chosen.where("form is not null"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 5, seen: int = 3, slip: int = 97, ratio: float = 2) -> DataFrame:
    """``spelling_groups`` of the ``vocabulary`` of whole texts.  Columns other than the id and the text play no part."""
    return spelling_groups(materialize(vocabulary(docs, id_col=id_col, text_col=text_col, least=least, slip=slip, seen=seen)), ratio=ratio)
