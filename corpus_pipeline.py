"""From raw documents to token ids: rejects, near copies and secrets go, sources are mixed, texts are encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm import bpe, mixing, quality_rules, secret_scan, simhash
from tabprep.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail."""
    return quality_rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode(docs.drop("n_chars"), out=("ids", "n_tokens")).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("secret_scan", secrets),
    ("mix_sources", mix), ("bpe_encode", encode),
]
# Fingerprints, draws and merges are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
