"""Exact duplicates against a dictionary, and the plan: only rows that may be repeated are shuffled."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from usertide.llm import exact_dedup
from usertide.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def check(got, rows):
    """One row of each text stays, the one of the smallest id."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[sha(text)].append(i)
    least = {k: min(ids, key=lambda i: (i is None, i)) for k, ids in groups.items()}
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (least[r["text_sha256"]], len(ids))
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert sorted(kept) == sorted(groups)


def test_whole_table(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = exact_dedup.exact_dedup(docs).collect()
    check(got, rows)
    assert sorted((r["doc_id"], r["text_sha256"]) for r in got) == sorted((i, sha(t)) for i, t in rows)


@pytest.mark.parametrize("seed", range(3))
def test_no_copy_is_missed(spark, monkeypatch, seed):
    # Crowded filters let many single rows through, but never lose a copy.
    monkeypatch.setattr(exact_dedup, "LOADS", ((200.0, 50.0), (1.0, 0.1), (0.01, 30.0))[seed])
    monkeypatch.setattr(exact_dedup, "BROADCAST_WORDS", (0, 4, 10**6)[seed])
    rows = [(i, f"text {i % 700 if i % 3 else i}") for i in range(4000)]
    check(exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_hot_group(spark):
    rows = [(i, "the same\ttext" if i % 3 == 0 else f"t{i // 2}") for i in range(6000)]
    check(exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect(), rows)


def test_white_space_and_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = exact_dedup.exact_dedup(odd_docs.withColumn("kept", F.lit("old")).withColumn("group_size", F.lit(0)))
    assert set(odd_docs.columns) < set(got.columns)
    check(got.collect(), rows)
    rows = [(9, "a b"), (8, "a  b"), (7, "a \t\n b"), (6, "a\rb"), (5, " a b"), (4, "a b"), (3, "ab"), (2, None), (1, ""), (None, "ab"), (None, "q"), (None, "q"), (0, " "), (0, "\n"), (0, "\x0b\x0c")]
    check(exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert exact_dedup.exact_dedup(odd_docs.limit(0)).collect() == []


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(2, None), (1, None), (3, "x")], "doc_id long, text_sha256 string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(df).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True)}


def test_single_rows_are_not_shuffled(spark, sf_dir):
    df = QUERIES["op13_exact_duplicates"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("PythonUDF", "EvalPython", "MapInArrow", "MapInPandas") if x in plan]
    # The first branch of the union holds the rows that go straight through: broadcasts only.
    optimized = df._jdf.queryExecution().sparkPlan().children().apply(0).toString()
    assert "BroadcastHashJoin" in optimized and "SortMergeJoin" not in optimized


def test_filters_leave_few_single_rows(spark):
    rows = spark.range(200_000).select(F.col("id").alias("doc_id"), F.sha2((F.col("id") - F.col("id") % 20 % 2 * (F.col("id") % 20 == 1).cast("long")).cast("string").cast("binary"), 256).alias("text_sha256"))
    suspects = rows
    for seed, load in enumerate(exact_dedup.LOADS):
        words = exact_dedup.filter_words(suspects.count(), load)
        found = exact_dedup.repeated_words(suspects, "text_sha256", words, seed)
        place = exact_dedup.places("text_sha256", words, seed)[0]
        suspects = suspects.withColumn(f"__dedup_word{seed}", place).join(found, f"__dedup_word{seed}", "left_semi").drop(f"__dedup_word{seed}").cache()
    repeated = rows.groupBy("text_sha256").count().where("count > 1").agg(F.sum("count")).first()[0]
    assert repeated == 20_000 and repeated <= suspects.count() < 1.3 * repeated
