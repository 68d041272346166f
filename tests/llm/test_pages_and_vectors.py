import base64
import hashlib
import random
import struct
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from usertide.llm import archives, url_filters, vectors
from usertide.llm.queries import RULES


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "rule_host string, rule_path string, verdict string")


def judged(df):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()}


def test_rules_and_aliases(spark, rules):
    rows = [
        (1, "http://a.com/x#f", '<link href="https://b.net/y?z=1&amp;q" rel="canonical">'), (2, "HTTP://A.com/x", None), (3, None, "x"),
        (4, "no scheme", ""), (5, "http://c.org/q", "<META http-equiv='refresh' content='0; url=/fr/w'>"), (6, "http://c.org/r", "<link rel=canonical href=q>"),
        (7, "https://b.net/y?z=1&q", None), (8, "https://www.example.net/en/a", "<link rel=canonical href=//b.net/>"), (9, "http://notexample.com/de/", None),
        (10, "ftp://Example.COM/de/x?y", None), (11, "x://", None), (12, "http://example.net", None), (12, "http://example.net", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS host", "'c' AS component", "1 AS node", "'c' AS a")
    assert judged(url_filters.judge(pages, rules)) == {
        1: ("a.com", "/x", None, "block"), 2: ("a.com", "/x", None, "block"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("c.org", "/q", None, "allow"), 6: ("c.org", "/r", None, "allow"), 7: ("b.net", "/y", "net/", "block"),
        8: ("www.example.net", "/en/a", "example.net/en/", "allow"), 9: ("notexample.com", "/de/", None, "allow"),
        10: ("example.com", "/de/x", "example.com/de/", "block"), 11: ("", "", None, "allow"), 12: ("example.net", "", None, "allow"),
    }
    edges = spark.createDataFrame([("http://notexample.com/de/", "http://q.com/"), ("http://z.net/", "http://q.com/"), (None, "http://q.com/")], "source string, target string")
    assert judged(url_filters.judge(pages, rules, edges))[9][3] == "block"
    assert url_filters.judge(pages, rules, edges).count() == len(rows)
    assert url_filters.judge(pages.limit(0), rules).collect() == [] and {v[3] for v in judged(url_filters.judge(pages, rules.limit(0))).values()} == {"allow"}


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_give_back_what_was_written(spark, sf_dir, min_bytes):
    odd = [(9001, "u\r\nv w", ""), (9000, None, None), (9002, "", "é" * 100_000), (9003, "x", "é" * 100_000), (9003, "x", "é" * 100_000), (None, "n", ""), (None, "m", "unique")]
    odd_pages = spark.createDataFrame(odd, "page_id long, url string, html string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").union(odd_pages).selectExpr("*", "'c' AS digest", "1 AS payload", "'c' AS first")
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, p in rows:
        if i is not None and len(p) >= min_bytes:
            first[p] = min(first.get(p, i), i)
    want = Counter()
    for i, p in rows:
        one = first.get(p)
        revisits = one is not None and one != i
        want[i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisits else "response", one if revisits else None, None if revisits else p] += 1
    got = archives.archived(pages, min_bytes=min_bytes, payloads=True).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    assert archives.archived(pages.limit(0)).collect() == []


def small_archive(monkeypatch=None):
    records = [archives.record(i, f"u{i}", b"p" * i, None, "d") for i in range(9)]
    entries, at = [], 0
    for data in records:
        entries.append({"digest": "0", "filename": archives.RECORDS, "offset": at, "length": len(data)})
        at += len(data)
    return archives.packed(records, entries)


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = small_archive()
    assert archives.LOCATOR in data
    for window in (1, 1 << 20):
        found = archives.archive_records(lambda o, n: data[o : o + n], len(data), window)
        assert [(r["page_id"], r["payload"]) for r in found] == [(str(i), b"p" * i) for i in range(9)]


def test_records_are_range_read():
    data, asked = small_archive(), []

    def read_at(offset, length):
        asked.append(length)
        return data[offset : offset + length]

    list(archives.archive_records(read_at, len(data), window=1))
    assert max(asked[3:]) < len(data) / 2


@pytest.mark.parametrize("change", ["end", "method", "payload"])
def test_broken_archives_are_refused(change):
    data = bytearray(small_archive())
    at = data.rfind(archives.CENTRAL)
    if change == "end":
        data = data[:-30]
    elif change == "method":
        struct.pack_into("<H", data, data.find(archives.CENTRAL) + 10, 8)
    else:
        data[60] ^= 255
    assert at > 0
    with pytest.raises(Exception, match="."):
        list(archives.archive_records(lambda o, n: bytes(data[o : o + n]), len(data)))


def brute_force(rows, k):
    keep = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in keep:
        if q % 20 == 0:
            out[q] = sorted((-float((keep[q] * keep[i]).sum()), i) for i in keep if i != q)[:k]
    return out


def test_recall_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute_force([(r["vec_id"], r["embedding"]) for r in df.collect()], 20)
    got = {}
    for r in vectors.nearest_vectors(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q, best in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 21)) and [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in best})
    assert hits >= 0.9 * 20 * len(want)


def test_copies_ties_and_odd_vectors(spark):
    random.seed(5)
    one, two = [1.0, 0.0, 2.0], [0.5, 1.0, 0.0]
    rows = [(i, one) for i in range(60)] + [(i, [float(random.randint(-3, 3)) for _ in range(3)]) for i in range(60, 160)] + [(200, two), (200, two)]
    odd = [(300, None), (320, []), (340, [0.0, 0.0, 0.0]), (360, [1.0, None, 1.0]), (380, [float("nan"), 1.0, 1.0]), (400, [float("inf"), 1.0, 0.0]), (420, [1.0, 2.0]), (None, one)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "'c' AS v", "'c' AS id", "'c' AS ids", "1 AS list")
    want = brute_force([r for r in rows + odd if not r[1] or len(r[1]) != 2], 20)
    got = {}
    for r in vectors.nearest_vectors(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert got == want
    few = {r["vec_id"] for r in vectors.nearest_vectors(df.where("vec_id < 4"), F.col("vec_id") == 0).collect()}
    assert few == {1, 2, 3}
    assert vectors.nearest_vectors(df.limit(0), F.lit(True)).collect() == []
