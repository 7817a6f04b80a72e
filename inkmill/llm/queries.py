"""The named queries of this subpackage; every one runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Query
from ..session import cut_lineage, scratch_path
from . import chat, decontaminate, hard_negatives, license_scan, near_dup, quality, secrets, sharding, token_alignment, token_counts, token_files, url_filter, word_bpe
from .common import read
from .oracles import SQL

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
REGISTRY: dict[str, Query] = {}


def query(run):
    REGISTRY[run.__name__] = Query(run, SQL.get(run.__name__))
    return run


@query
def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.bytes_law(read(spark, sf_dir, "documents"), 8)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest_formatted(chat.format_conversations(table.unionByName(chat.control_conversation(table))))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(read(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE))
    return token_files.add_starts(cut_lineage(token_files.describe_token_files(token_files.read_token_files(spark, folder))))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_components(read(spark, sf_dir, "documents"), percent=85)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.encode_and_decode(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), mixed=True)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.finite_rows(vectors.withColumn("label", noisy))
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest_licenses(license_scan.scan_licenses(read(spark, sf_dir, "documents")))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
