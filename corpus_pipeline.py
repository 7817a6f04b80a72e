"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Quality rules drop documents, near duplicates leave one document of each group, decontamination drops documents that
hold a benchmark item, the secret scan masks secrets, and byte-pair encoding ends with ids and their decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkmill.llm import decontaminate, near_dup, quality, secrets, word_bpe
from inkmill.llm.common import read
from inkmill.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and score at the threshold or above."""
    return quality.quality_rules(docs, read(spark, sf_dir, "labels")).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return near_dup.drop_near_duplicates(docs, percent=80).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), mixed=True).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and the length counted anew."""
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, with lang and source."""
    coded = word_bpe.encode_and_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secret_scan), ("encoding", encoding)]
# Hash weights, MinHash components and learned merges are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
