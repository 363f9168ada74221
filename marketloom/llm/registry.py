"""Queries of the corpus operations over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import audit, decontam, licences, mixing, orchard, piecebpe, repeats, sharding, simhash, spotsigs, tokens, toxicity, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.match_licences(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "canonical_digest", "license_id")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(_documents(spark, sf_dir))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(_documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_documents(spark, sf_dir), tokens.load_vocabulary())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mix(docs.select("doc_id", "text"), labelled, keep=["doc_id"]).select("doc_id", "tokens", "domain", "posterior", "rate", "copies")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.coding_report(_documents(spark, sf_dir), piecebpe.load_model())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_warc, op2_licence_scan, op3_sharding, op4_toxicity, op5_repeats, op6_spotsigs, op7_simhash, op8_token_counts, op9_mixing, op10_decontamination,
                                    op11_piece_coding, op12_conversation_repair, op13_clustering)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.ORACLE, "op2_licence_scan": licences.oracle(), "op6_spotsigs": spotsigs.ORACLE, "op13_clustering": orchard.ORACLE}
