"""Streaming queries; each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..session import scratch_path
from ..streaming import streams
from . import tables as t
from .registry import REGISTRY, query
from .shaping import KEYWORDS, SQL_KEYWORD_HIT, WORD_COUNT

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document_stream(spark, d) -> DataFrame:
    """A table is one file or a folder of files; as a pattern its path may be either."""
    return streams.stream_scan(spark, f"{d}/documents.parque[t]", DOCUMENTS, "parquet")


@query("stream_scan", "SELECT doc_id, lang, n_chars FROM documents")
def stream_scan(spark, d):
    rows = document_stream(spark, d).select("doc_id", "lang", "n_chars")
    return streams.drain_to_parquet(rows, scratch_path(spark, "stream"))


@query("stream_map_tokenize", f"""
SELECT doc_id, {WORD_COUNT}::INTEGER AS n_tokens, array_to_string({t.sql_token_ids('text')}, ' ') AS input_ids FROM documents""")
def stream_map_tokenize(spark, d):
    coded = streams.stream_map(document_stream(spark, d), n_tokens=T.word_count("text"), input_ids=t.joined(t.token_ids("text")))
    return streams.drain_to_parquet(coded.select("doc_id", "n_tokens", "input_ids"), scratch_path(spark, "stream"))


@query("stream_keyword_filter", f"SELECT count(*) AS total, count(*) FILTER ({SQL_KEYWORD_HIT}) AS kept FROM documents")
def stream_keyword_filter(spark, d):
    counts = streams.stream_retention(document_stream(spark, d), "text", KEYWORDS)
    return streams.drain_latest(counts, scratch_path(spark, "stream"))


@query("stream_interleave", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr')")
def stream_interleave(spark, d):
    rows = document_stream(spark, d).select("doc_id", "lang")
    both = streams.stream_interleave(rows.filter("lang = 'en'"), rows.filter("lang = 'fr'"))
    return streams.drain_to_parquet(both, scratch_path(spark, "stream"))


@query("stream_alternate", REGISTRY["interleave_datasets"].sql)
def stream_alternate(spark, d):
    rows = document_stream(spark, d).select("doc_id", "lang")
    both = [rows.filter("lang = 'en'"), rows.filter("lang = 'fr'")]
    return streams.drain_alternating(both, "doc_id", scratch_path(spark, "stream"))
