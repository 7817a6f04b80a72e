"""Token alignment, license scan and hard negatives against plain Python; rows with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from inkmill.llm import hard_negatives, license_scan, token_alignment
from inkmill.llm.queries import BYTE_BPE, PIECE_BPE

from . import brute

DIR = "/root/testdata/sf0.001"
BYTE, PIECE = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
       "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense")
GPL = ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License")
ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose")
ODD = [
    (1, "Released under the MIT License."), (2, "Released under the MIT License."), (3, None), (4, ""), (5, " \n"), (6, "x" * 2_000_000), (7, "the license " * 40_000),
    (8, "Licensed under the Apache License, Version 2.0. (CC BY-NC 4.0) under the mit license under the MIT license"), (9, MIT), (10, MIT.replace("merge,", "")),
    (11, "/* " + GPL + " */ " + ZLIB), (12, ZLIB.replace("In no event", "words that come between and are more than a slack of eight allow " * 3)),
    (13, "SPDX-License-Identifier: Apache-2.0"), (14, "é中🙂 ß  a\t\n b </s><s> <|endoftext|> <0x41> under the"), (15, "a▁b"), (None, "Under the MIT licenseé"), (1, None),
    (16, "MIT " * 5_000), (17, "no license here"), (18, " lead and trail  "), (19, "0123456789 " * 500),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "old", "old", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, notices string, _scan0 int").cache()


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


# Licences.

def test_license_query(spark, documents):
    got = contract.queries()["op12_license_scan"](spark, DIR)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert _sorted(got.collect()) == _sorted([(i, *brute.licenses(t, license_scan.NOTICES)) for i, t in documents])


def test_license_odd(odd):
    scanned = license_scan.scan_licenses(odd)
    assert sorted(scanned.columns) == ["_scan0", "doc_id", "n_words", "notices", "text"]
    got = license_scan.digest_licenses(scanned).collect()
    assert _sorted(got) == _sorted([(i, *brute.licenses(t, license_scan.NOTICES)) for i, t in ODD])
    labels = {r.doc_id: r.labels for r in got}
    assert labels[9] == labels[10] == "mit" and labels[11] == "gpl,gpl-3,zlib" and labels[12] == "" and labels[13] == "apache-2" and labels[17] == ""


def test_license_random_notices(spark):
    """Notices of a small alphabet, so that every phrase is found in many ways."""
    rng = random.Random(5)
    word = lambda: rng.choice("abcdef")
    notices = tuple((f"l{k}", f"[{word()} {word()}] {word()} {word()} {word()} [{word()} {word()} {word()}] {word()}") for k in range(6))
    notices += tuple((f"p{k}", f"{word()} {word()} [{word()} {word()} {word()}]") for k in range(4))
    rows = [(k, " ".join(word() for _ in range(rng.randint(0, 60)))) for k in range(60)]
    scanned = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices).collect()
    assert any(r.notices for r in scanned)
    for r in scanned:
        assert [(n.template, n.start, n.share) for n in r.notices] == brute.notices(r.text, notices)


def test_license_word_counts(odd):
    counts = {r.word: r.n_docs for r in license_scan.licence_word_counts(odd).collect()}
    assert counts["mit"] == sum("mit" in brute.licence_words(t) for _, t in ODD)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.digest_licenses(license_scan.scan_licenses(none)).collect() == []
    assert token_alignment.align_tokens(none, BYTE, PIECE).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine_hard_negatives(hard_negatives.finite_rows(vectors), F.lit(True)).collect() == []


# Alignment.

@pytest.fixture(scope="module")
def both_sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    return lambda text: brute.two_sides(text, a, b)


def test_alignment_query(spark, documents, both_sides):
    got = contract.queries()["op13_token_alignment"](spark, DIR).collect()
    assert _sorted(got) == _sorted(brute.alignments(documents, both_sides))


@pytest.mark.parametrize("round_keys", [1 << 22, 1 << 6])
def test_alignment_odd(odd, both_sides, round_keys):
    """Also in many rounds of small shards."""
    rows = [(i, t) for i, t in ODD if t is None or len(t) < 100_000]
    table = odd.filter("text IS NULL OR length(text) < 100000")
    got = token_alignment.align_tokens(table, BYTE, PIECE, shard_keys=16, round_keys=round_keys)
    assert _sorted(got.collect()) == _sorted(brute.alignments(rows, both_sides))


def test_alignment_groups_as_text(spark, both_sides):
    table = spark.createDataFrame([(1, "Hello, wörld 🙂"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in token_alignment.align_tokens(table, BYTE, PIECE, digest=False).collect()}
    a, b = both_sides("Hello, wörld 🙂")
    assert got == {1: brute.groups(a, b), 2: ""}


def test_alignment_long_text(spark, both_sides):
    text = "Long and unbroken. " * 60_000 + "z" * 50_000
    got = token_alignment.align_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), BYTE, PIECE).collect()
    assert _sorted(got) == _sorted(brute.alignments([(1, text)], both_sides))


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64))
    shards, rows = token_alignment.shard_of(keys, 7), []
    for k in range(7):
        slots, bits, placed = token_alignment.build_shard(keys[shards == k])
        rows.append((k, slots, np.packbits(bits, bitorder="little").tobytes(), placed.astype("<u8").tobytes()))
    known = token_alignment.PerfectHash(rows, 7)
    assert sorted(known.numbers(keys)) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 63, 1_000, dtype=np.uint64), keys)
    assert (known.numbers(others) == -1).all()
    assert 8 * len(known.words) * 8 < 6 * len(keys)


def test_tree_sum(spark):
    rng = np.random.default_rng(2)
    rows = [(s, p, rng.integers(0, 9, 4).astype("<i8")) for s in range(3) for p in range(37) if (s + p) % 5]
    table = spark.createDataFrame([(s, p, v.tobytes()) for s, p, v in rows], "slice long, part long, counts binary")
    got = {r.slice: list(np.frombuffer(r.counts, "<i8")) for r in token_alignment._tree_sum(table, fan_in=3).collect()}
    assert got == {s: list(sum(v for t, _, v in rows if t == s)) for s in range(3)}


# Hard negatives.

def _vectors(seed, n, dims, low=-40, high=40):
    rng = random.Random(seed)
    centres = [[rng.randint(low, high) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, rng.randint(0, 2), [x + rng.randint(-6, 6) for x in c] if rng.random() < 0.9 else list(c)))
    return rows


@pytest.mark.parametrize("dims, round_values", [(1, 4_000_000), (2, 9), (7, 4_000_000), (7, 20)])
def test_negatives_random(spark, dims, round_values):
    rows = _vectors(dims, 400, dims) + [(1000 + k, k % 3, [0] * dims) for k in range(20)]
    rows += [(2000, 1, []), (2001, 1, [5]), (2002, 0, [-3]), (7, 1, [9] * dims), (2003, 2, [30] * (dims + 1))]
    table = spark.createDataFrame(rows, "vec_id long, label long, vec array<long>").repartition(5)
    got = hard_negatives.mine_hard_negatives(table, F.col("vec_id") % 10 == 0, round_values=round_values).collect()
    assert _sorted(got) == _sorted(brute.hard_negatives(rows, lambda r: r[0] % 10 == 0))


def test_negatives_pruned_buckets():
    """The candidates of a bucket hold every row that reaches the least score, and leave rows out."""
    rng = np.random.default_rng(3)
    rows = np.floor(256 * rng.normal(size=(600, 8))).astype(np.int64)
    rows[::7] = 0
    bucket = hard_negatives.Bucket(np.arange(600), np.zeros(600, np.int64), rows)
    anchors = hard_negatives.Anchors(np.arange(50), np.zeros(50, np.int64), rows[:50])
    scores, seen = anchors.rows @ rows.T, 0
    for share in (-0.5, 0.0, 0.3, 0.9, 0.999):
        least = np.floor(share * anchors.lengths * bucket.longest).astype(np.int64)
        alive, low, high = bucket.ranges(anchors, least)
        for a in range(50):
            found = set(bucket.candidates(anchors.focus[a], low[a], high[a])) if alive[a] else set()
            assert set(np.flatnonzero(scores[a] >= least[a])) <= found
            seen += len(found) if share == 0.9 else 0
    assert seen < 50 * 600 / 4


def test_negatives_finite_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan]), (6, 1, [inf]), (7, 1, [-inf]), (None, 1, [1.0]), (8, 2, [])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("vec", F.lit("old"))
    assert _sorted(hard_negatives.finite_rows(table).collect()) == _sorted([(1, 1, [128, -1]), (8, 2, [])])


def test_negatives_large_components(spark):
    """Products beyond the integers of a double stay exact; beyond 62 bits they are an error."""
    big = 1 << 28
    rows = [(0, 0, [big, 1]), (1, 0, [big, 1]), (2, 1, [big, 0]), (3, 1, [big - 1, 3]), (4, 1, [big, 1])]
    table = spark.createDataFrame(rows, "vec_id long, label long, vec array<long>")
    got = hard_negatives.mine_hard_negatives(table, F.col("vec_id") == 0).collect()
    assert _sorted(got) == _sorted(brute.hard_negatives(rows, lambda r: r[0] == 0))
    with pytest.raises(Exception, match="does not fit"):
        hard_negatives.mine_hard_negatives(spark.createDataFrame([(0, 0, [1 << 40]), (1, 0, [1 << 40])], table.schema), F.col("vec_id") == 0).collect()


# Token files.

def test_encode_batch(documents):
    """Batches give what single texts give, special strings, blanks beside spaces and empty texts included."""
    from inkmill.llm.byte_level import Encoder

    texts = [t for _, t in ODD] + [t for _, t in documents] + ["<|endoftext|> a <|endoftext|>", " a", "a ", "a  b \n c", "\n", None, "x", "it's 12½ don't "]
    own, alone = Encoder(BYTE), Encoder(BYTE, limit=50)
    ids, ends = own.encode_batch(texts)
    assert [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)] == [alone.encode(t) for t in texts]
    assert own.encode_batch([])[1].tolist() == []
    assert max(map(len, own.spaced)) <= 64 and max(map(len, own.tokens)) <= 64


def test_token_starts_of_repeated_ids(spark, tmp_path):
    """The ids before a row in its file are those that its start counts."""
    from inkmill.llm import token_files

    rows = [(1, "word " * n) for n in (5, 3, 2, 1, 6, 4)] + [(0, "a"), (None, "b c"), (2, None)]
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "ids"), BYTE)
    files = token_files.read_token_files(spark, str(tmp_path / "ids"))
    stream = [i for r in sorted(files.collect(), key=lambda r: (r.part, r.place)) for i in r.tokens]
    got = token_files.add_starts(token_files.describe_token_files(files)).collect()
    assert len(got) == len(rows)
    for r in got:
        import zlib

        own = stream[r.start:r.start + r.n_tokens]
        assert own[-1] == 0 and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
    assert sorted(r.start for r in got) == sorted(np.cumsum([0, *[r.n_tokens for r in sorted(got, key=lambda r: r.start)]])[:-1])
