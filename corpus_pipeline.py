"""The corpus pipeline: raw documents to token ids, in five stages that are each stored and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.llm import bpe, decontamination, near_duplicates, pii, toxicity
from usertide.llm.queries import rank_file
from usertide.llm.ship import ship
from usertide.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject."""
    ship(spark)
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("toxicity_predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each near-duplicate group, once; rows without an id stay.

    Distinct rows need no shuffle of their own: the join has brought the rows of an id together.
    """
    ship(spark)
    kept = near_duplicates.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").dropDuplicates().select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    ship(spark)
    return decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("not contaminated").select(*COLUMNS)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets; ``n_chars`` follows the new text."""
    return pii.replace_pii(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number and whether decoding gives the text again."""
    ship(spark)
    ranks = bpe.load_ranks(rank_file())
    coded = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("byte_bpe", encode),
]

#: A classifier and a tokenizer can't be said in SQL; the tests follow each stage by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
