"""The corpus pipeline: documents to token shards, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of ``documents``. SQL cannot
express the stages; the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edictum.llm import decontaminate, minhash, mixing, tokens, toxicity
from edictum.llm.common import prepare, stage

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier, learned from all labels, rejects go."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash of five-word shingles in BK-trees, checked at similarity 0.8 and more: the smallest id of each group stays."""
    prepare(spark)
    return minhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a copy of a test item go."""
    prepare(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's target asks for."""
    prepare(spark)
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, written and read back: doc_id, start, n_tokens, ids_crc32."""
    prepare(spark)
    return tokens.token_report(stage(tokens.encode_shards(docs), "shards", compression="none"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
