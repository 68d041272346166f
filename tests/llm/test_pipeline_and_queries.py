import __spark_entry__ as contract
import corpus_pipeline
import pytest
import tiktoken
from oracle import connect, differences
from pyspark.sql import functions as F
from usertide.llm import decontamination, near_duplicates, pii, toxicity
from usertide.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_pipeline_stages_take_effect(spark, docs, sf_dir):
    labels, items = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    now, seen = docs, {}
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, sf_dir).cache()
        seen[name] = (before, now)
        if name != "byte_bpe":
            assert now.columns == docs.columns and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
    before, after = seen["toxicity"]
    assert ids(after) == ids(toxicity.toxicity(before, labels).where("toxicity_score < 0.3")) and len(ids(after)) < before.count()
    before, after = seen["near_duplicates"]
    assert ids(after) == ids(near_duplicates.near_duplicates(before).where("kept")) and len(ids(after)) < before.count()
    before, after = seen["decontamination"]
    assert ids(after) == ids(decontamination.contamination(before, items).where("20 * n_hit < n_words or n_hit = 0")) and len(ids(after)) < before.count()
    before, after = seen["pii"]
    assert ids(after) == ids(before) and after.where(F.length("text") != F.col("n_chars")).count() == 0
    assert after.where(F.col("text").rlike("@mail[0-9]")).count() == 0 < before.where(F.col("text").rlike("@mail[0-9]")).count()
    rest = pii.replace_pii(before).select("doc_id", "text")
    assert sorted(map(tuple, after.select("doc_id", "text").collect())) == sorted(map(tuple, rest.collect()))
    before, after = seen["byte_bpe"]
    assert ids(after) == ids(before) and after.where("not round_trip or n_tokens <> size(ids)").count() == 0


def test_pipeline_runs_from_start_to_end(spark, docs, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert 0 < len(rows) < docs.count() and tiktoken and all(r["round_trip"] for r in rows)


def test_stages_on_odd_rows(spark, odd_docs, sf_dir):
    odd = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "key", "items", "value")
    now = odd
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
    got = {r["doc_id"]: r["n_tokens"] for r in now.collect()}
    assert set(got) == {1, 2, 3, 4, 5, None, 7, 8} and got[1] == got[2] == 0
    now = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
    assert now.collect() == []
