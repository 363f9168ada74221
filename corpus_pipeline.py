"""From raw documents to balanced shards: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import decontam, mixing, sharding, simhash, toxicity
from marketloom.llm.common import stored

#: SQL can express neither the trained stages nor the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.reject_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of domains below their target weight more often."""
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.repeat_rows(mixing.mix(docs, labelled, least=1.0), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_domains),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
