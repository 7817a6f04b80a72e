"""A table's own columns survive, whatever the operators call their helpers."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from inkmill.llm import chat, decontaminate, license_scan, near_dup, quality, secrets, token_counts, url_filter, word_bpe
from inkmill.llm.queries import BYTE_BPE, WORD_BPE

HELPERS = ["_key", "_KEY2", "_own", "_h", "_sum", "_w", "_lines", "_s", "_p", "_t", "_v", "_f", "_parts", "_code", "_scan", "_node", "_rule", "_carried",
           "_gone", "_text", "_trusted", "__user0", "__user1", "node", "component", "key"]
TEXT = "the key is token = abcdefgh12345678 and nothing more of it stands here today"


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, "a short one")], "doc_id long, text string")
    return df.withColumns({c: F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")) for c in HELPERS})


def operators(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(0, "an item that no text here has in it")], "item_id long, text string")
    return {
        "quality": (lambda df, c: quality.quality_rules(df, labels, text_col=c), "n_words"),
        "secrets": (lambda df, c: secrets.scan_secrets(df, text_col=c), "spans"),
        "masks": (lambda df, c: secrets.mask_secrets(df, text_col=c), "doc_id"),
        "bpe": (lambda df, c: word_bpe.encode_and_decode(df, public_tokenizers.path(WORD_BPE), text_col=c), "ids_sha256"),
        "counts": (lambda df, c: token_counts.count_tokens(df, public_tokenizers.path(BYTE_BPE), text_col=c), "n_tokens"),
        "licences": (lambda df, c: license_scan.scan_licenses(df, text_col=c), "n_words"),
        "benchmark": (lambda df, c: decontaminate.drop_contaminated(df, bench, text_col=c), "doc_id"),
        "urls": (lambda df, c: url_filter.filter_urls(df, url=c, html=c), "verdict"),
        "chat": (lambda df, c: chat.canonical_turns(df, record=c), "layout"),
        "copies": (lambda df, c: near_dup.drop_near_duplicates(df), "doc_id"),
    }


@pytest.mark.parametrize("name", ["quality", "secrets", "masks", "bpe", "counts", "licences", "benchmark", "urls", "chat", "copies"])
def test_own_columns_stay(spark, table, name):
    run, added = operators(spark)[name]
    out = run(table, "text")
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3] and set(table.columns) <= set(out.columns)
    for c in HELPERS:
        assert [got[i][c] for i in (1, 2, 3)] == [f"{c}:{i}" for i in (1, 2, 3)], c
    plain = {r.doc_id: r[added] for r in run(table.select("doc_id", "text"), "text").collect()}
    assert plain == {i: got[i][added] for i in plain}


@pytest.mark.parametrize("name", ["quality", "secrets", "bpe", "benchmark", "urls"])
def test_text_column_of_any_name(spark, table, name):
    run, added = operators(spark)[name]
    plain = {r.doc_id: r[added] for r in run(table.select("doc_id", "text"), "text").collect()}
    moved = table.select("doc_id", F.col("text").alias("_w"), "_key")
    assert {r.doc_id: r[added] for r in run(moved, "_w").collect()} == plain
