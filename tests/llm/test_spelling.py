"""Spelling variants against a plain dictionary of one-letter edits."""

import re
import zlib
from collections import Counter

import pyarrow as pa
from usertide.llm import spelling
from usertide.llm.queries import QUERIES


def counted(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(words):
    """Each word's neighbours, by trying every edit."""
    letters = sorted({c for w in words for c in w})
    found = {}
    for w in words:
        tried = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        tried |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        found[w] = {t for t in tried if t in words and t != w}
    return found


def expected(words):
    links = near(words)
    form = {}
    for w, found in links.items():
        best = min(found, key=lambda t: (-words[t], t), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(links[w]), words.get(form[w], -1)) for w, n in words.items())


def plain(rows):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in rows)


def test_query_equals_all_edits(spark, sf_dir, docs):
    want = expected(counted((r["doc_id"], r["text"]) for r in docs.collect()))
    got = plain(QUERIES["op12_spelling_variants"](spark, sf_dir).collect())
    assert got == want and any(x[1] for x in want) and any(x[2] != x[1] != "" for x in want)


def test_larger_table_equals_all_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = expected(counted((r["doc_id"], r["text"]) for r in docs.collect()))
    assert plain(spelling.spelling_variants(docs).collect()) == want


def test_odd_rows(spark, odd_docs):
    got = plain(spelling.spelling_variants(odd_docs, seen=1).collect())
    words = Counter()
    for r in odd_docs.collect():
        for run in re.findall("[a-zÀ-ÿ]+", spelling_lower(r["text"] or "")):
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            words[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    assert got == expected({w: n for w, n in words.items() if len(w) >= 5})
    assert spelling.spelling_variants(odd_docs.limit(0)).collect() == []


def spelling_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_repeated_letters_ties_and_chains(spark):
    words = {"aaaaa": 1, "aaaaaa": 2, "aaaaaaa": 4, "aaaaaaaa": 8, "balls": 5, "bells": 5, "bolls": 2, "bulls": 1, "ballÿ": 10, "×aaaa": 3, "zzzzz": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert plain(spelling.spelling_groups(df).collect()) == expected(words)
    got = {r["word"]: r for r in spelling.spelling_groups(df).collect()}
    assert got["aaaaaa"]["root"] == "aaaaaaaa" and got["aaaaa"]["form"] == "×aaaa" and got["bolls"]["form"] == "balls" and got["zzzzz"]["n_near"] == 0


def test_scan_joins_groups_across_batches():
    rows = [("ab$", "", "ab", 1), ("ab$", "x", "xab", 2), ("ab$", "y", "yab", 3), ("b$a", "", "ab", 1), ("b$a", "a", "aab", 5), ("c$", "q", "qc", 1)]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["rest", "letter", "word", "n"])
    whole = [r for b in spelling.scan(iter([batch(rows)])) for r in b.to_pylist()]
    single = [r for b in spelling.scan(iter([batch([r]) for r in rows])) for r in b.to_pylist()]
    key = lambda r: (r["word"], r["near"])
    assert sorted(whole, key=key) == sorted(single, key=key)
    assert {(r["word"], r["near"]) for r in whole} == {("ab", "xab"), ("xab", "ab"), ("ab", "yab"), ("yab", "ab"), ("xab", "yab"), ("yab", "xab"), ("ab", "aab"), ("aab", "ab")} - {("ab", "aab"), ("aab", "ab")}


def test_a_doubled_letter_links_once(spark):
    df = spark.createDataFrame([("aabbb", 1), ("aaabbb", 1), ("aaabbbb", 1)], "word string, n long")
    assert sorted((r["word"], r["near"]) for r in spelling.neighbours(df).collect()) == [("aaabbb", "aaabbbb"), ("aaabbb", "aabbb"), ("aaabbbb", "aaabbb"), ("aabbb", "aaabbb")]
