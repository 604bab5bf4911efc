"""A corpus from raw documents: judge, deduplicate, mix, pack. Each stage calls one operator on all that the stage before
kept; the result of each is written and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotweave.llm import exact_dedup, minhash, mixing, packing, quality
from slotweave.llm.common import materialize, reachable


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, a similarity of 0.8 or more."""
    return minhash.drop_near_copies(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix with their token ids, and their places in the training sequences. Of a document that the mix
    takes several times each copy has a row number of its own."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_classifier", judge_quality),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can't express the classifier; the tests hold the stages against brute force.
ORACLE_SQL = None
