"""Masking, tags and entity counts over Arrow buffers; batches from one shuffle."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.functions import scalars, text as T
from inkmill.functions.scalars import uniform, uniform_array
from inkmill.operators import encoding, examples as X, metrics as M, user_code
from inkmill.operators.ordering import batch_assign
from inkmill.plans import tables as t
from inkmill.plans.tables import LABEL_NAMES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_draw_arrays_equal_single_draws(spark):
    df = spark.createDataFrame([(1, "a%d", 4), (2, None, 2), (3, "ä", 0), (4, "b", None)], "id long, k string, n int")
    rows = df.select(uniform_array(F.col("n"), "42:x", "id", "k").alias("u"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: uniform("42:x", "id", "k", i)).alias("v"), "n").collect()
    for r in rows:
        assert r.u == (None if r.n is None else r.v[:r.n])


def test_three_char_pieces(spark):
    df = spark.createDataFrame([(0, "abcd e"), (1, ""), (2, None), (3, "  \U0001d504bcdefg")], "id int, text string")
    rows = {r.id: r for r in t.three_char_pieces(df.coalesce(1), "text").collect()}

    def ids(*pieces):
        return [101, *(r[0] for r in spark.createDataFrame([(p,) for p in pieces], "p string").select(t.token_id(F.col("p"))).collect()), 102]

    assert rows[0].word_ids == [None, 0, 0, 1, None] and rows[0].piece_ids == ids("abc", "d", "e")
    assert rows[1].word_ids == [None, None] and rows[1].piece_ids == [101, 102]
    assert rows[2].word_ids is None and rows[2].piece_ids is None
    assert rows[3].piece_ids == ids("\U0001d504bc", "def", "g") and rows[3].word_ids == [None, 0, 0, 0, None]


def test_whole_word_mask_draws_once_a_word(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5], [None, 7, 7, 9, 7]), (2, None, None), (3, [], [])], "id long, ids array<int>, w array<string>").coalesce(1)
    indexed = {r.id: r.i for r in X.add_word_index(df, "w", "i").collect()}
    assert indexed == {1: [None, 0, 0, 1, 2], 2: None, 3: []}
    masked = X.whole_word_mask(df.withColumn("labels", F.col("ids")), "ids", "labels", "w", ["id"], 103, probability=0.5)
    rows = {r.id: r for r in masked.collect()}
    hit = [spark.range(1).select(uniform("42:0:w", F.lit(1), F.lit(i))).first()[0] < 0.5 for i in range(3)]
    want = [False, hit[0], hit[0], hit[1], hit[2]]
    assert rows[1].labels == [x if h else -100 for x, h in zip([1, 2, 3, 4, 5], want)]
    assert rows[1].ids == [103 if h else x for x, h in zip([1, 2, 3, 4, 5], want)]
    assert rows[2].ids is None and rows[3].ids == []
    assert "md5" not in _plan(masked)  # no digest a position in a lambda


def test_seqeval_odd_rows(spark):
    df = spark.createDataFrame([
        (["B-X", "I-X", "I-Y", "O"], ["B-X", "I-X", "B-Y", "O"]), (["I-X", "-", "B-X"], ["I-X", "-100", "I-X"]),
        (["O", "B-Z"], ["O"]), ([], []), (None, ["O"])], "p array<string>, y array<string>").coalesce(1)
    scores = M.seqeval(df, "p", "y")
    rows = {r.type: (r.precision, r.recall, r.number) for r in scores.collect()}
    assert rows == {"X": (1 / 3, 0.5, 2), "Y": (1.0, 1.0, 1), "overall": (0.5, 2 / 3, 3), None: (0.0, 0.0, None)}
    assert "Generate" not in _plan(scores)  # no row a span


def test_collate_shuffles_rows_once(spark, monkeypatch):
    from inkmill.operators import ordering

    df = spark.range(103).select("id", (F.col("id") % 3).alias("g"), F.array(F.col("id")).alias("ids")).repartition(4)

    def mean(examples):
        return [{"n": len(examples), "ids": [x for e in examples for x in e["ids"]]}]

    want = {(r.g, r.batch_id): sorted(r.ids) for r in batch_assign(df, 4, "id", ["g"]).groupBy("g", "batch_id").agg(F.collect_list("id").alias("ids")).collect()}
    for edges in (4096, 5):
        monkeypatch.setattr(ordering, "MAX_EDGES", edges)
        got = user_code.collate_batches(df, 4, "id", mean, "n int, ids array<long>", ["g"])
        assert _plan(got).count("Exchange hashpartitioning") == 1
        assert {(r.g, r.batch_id): r.ids for r in got.collect()} == want
    again = df.union(df)  # equal keys stay in one range, and batches keep their size
    assert sorted(r.n for r in user_code.collate_batches(again, 4, "id", mean, "n int, ids array<long>").collect()) == [2] + [4] * 51


def test_pieces_leave_a_batch_by_slices(spark, monkeypatch):
    import pyarrow as pa

    rows = [["ab"] * n for n in (0, 3, 500, 1, 0, 2, 2, 2)]
    monkeypatch.setattr(encoding, "WORDS_AT_ONCE", 4)
    parts = list(encoding._slices(pa.array([None, *rows], pa.list_(pa.string())).slice(1)))
    assert [len(p.flatten()) for p in parts] == [3, 500, 3, 4] and [r for p in parts for r in p.to_pylist()] == rows
    df = spark.createDataFrame(list(enumerate(rows)), "id int, w array<string>").coalesce(1)
    merges = spark.createDataFrame([(0, "a", "b")], "rank int, left string, right string")
    got = {r.id: r.pieces for r in encoding.encode_bpe(df, F.col("w"), merges).collect()}
    assert got == {i: [["ab"]] * len(r) for i, r in enumerate(rows)}


def test_examples_of_a_batch_are_plain_values():
    import pyarrow as pa

    rows = [{"id": 1, "i": [1, None, 3], "f": [0.1, float("inf")], "s": ["a", None]}, {"id": 2, "i": None, "f": [], "s": None}, {"id": None, "i": [5], "f": [None], "s": []}]
    table = pa.Table.from_pylist(rows, pa.schema({"id": pa.int64(), "i": pa.list_(pa.int32()), "f": pa.list_(pa.float32()), "s": pa.list_(pa.string())}))
    for part in (table, table.slice(1), table.take([2, 0, 1]), table.slice(0, 0), pa.concat_tables([table, table.slice(2)])):
        assert user_code._examples(part) == part.to_pylist()
        assert all(type(x) in (int, type(None)) for e in user_code._examples(part) for x in e["i"] or [])


def test_bytes_are_spelled_where_words_are_encoded(spark):
    from inkmill.functions import pretok

    df = spark.createDataFrame([(0, "hé €\U0001f600 a\u0000b"), (1, None), (2, ""), (3, "é" * 50)], "id int, text string")
    merges = spark.createDataFrame([(0, "Ã", "©"), (1, "Ġ", "a")], "rank int, left string, right string")
    want = encoding.encode_bpe(df, pretok.pretok_bytelevel("text"), merges).collect()
    got = encoding.encode_bpe(df, pretok.pretok_bytelevel_raw("text"), merges, byte_level=True).collect()
    assert got == want


def test_long_words_and_kept_words(spark, monkeypatch):
    import random

    rng = random.Random(2)
    table = {}
    for rank in range(60):
        parts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(2)]
        table.setdefault(tuple(parts), rank)
    for n in (1, 2, 31, 33, 200):
        word = "".join(rng.choice("abc") for _ in range(n))
        monkeypatch.setattr(encoding, "LONG_WORD", 1 << 30)
        want = encoding._bpe_word(word, table)
        monkeypatch.setattr(encoding, "LONG_WORD", 0)
        assert encoding._bpe_word(word, table) == want
    seen = spark.sparkContext.accumulator(0)

    def encode(word):
        seen.add(1)
        return [word]

    df = spark.createDataFrame([(i, ["x", "y", "z" * 100]) for i in range(20)], "id int, w array<string>").coalesce(1)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "2")
    try:
        assert [r.p for r in df.select(encoding._word_encoder(encode)("w").alias("p")).collect()] == [[["x"], ["y"], ["z" * 100]]] * 20
    finally:
        spark.conf.set(size, before)
    assert seen.value == 12  # the long word once per batch


def test_many_draws_are_those_of_each_key(monkeypatch):
    rng = random.Random(1)
    for _ in range(20):
        n = rng.randint(0, 15)
        keys = [rng.choice(["tag", "err:é", "x" * rng.randint(0, 70)]) + f":{rng.randint(0, 10 ** rng.randint(1, 15))}" for _ in range(n)]
        counts = [rng.choice([0, 1, 3, 11, 105, 1200]) for _ in range(n)]
        monkeypatch.setattr(scalars, "KEYS_AT_ONCE", rng.choice([7, 100, 131_072]))
        monkeypatch.setattr(scalars, "LANES", rng.choice([5, 32_768]))
        want = np.concatenate([np.zeros(0), *(scalars.row_draws(k, c) for k, c in zip(keys, counts))])
        assert (scalars.many_draws(keys, counts) == want).all()


def test_seqeval_query_makes_tags_in_arrays(spark, tmp_path, monkeypatch):
    from inkmill.plans import REGISTRY

    texts = ["a b  c d e f", "", None, "x", "y " * 300]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    scores = REGISTRY["seqeval"].run(spark, str(tmp_path))
    assert "lambda" not in _plan(scores)  # no tag a position in a lambda

    def tag(doc, i, error):
        def u(seed):
            return int(hashlib.md5(f"{seed}:{doc}:{i}".encode()).hexdigest()[:8], 16) / 2 ** 32
        return LABEL_NAMES[(int(u("tag") * 9) + (error and u("err") < 0.1)) % 9]

    tags = [([tag(d, i, True) for i in range(len(t.split()))], [tag(d, i, False) for i in range(len(t.split()))]) for d, t in enumerate(texts) if t is not None]
    want = {r.type: r for r in M.seqeval(spark.createDataFrame([*tags, (None, None)], "p array<string>, y array<string>"), "p", "y").collect()}
    got = {r.type: r for r in scores.collect()}
    assert got.keys() == want.keys() and got["overall"].number > 100
    for name in got.keys() - {None}:
        assert got[name].number == want[name].number and got[name].f1 == pytest.approx(want[name].f1, abs=1e-8)


def test_span_counts_by_slices(spark, monkeypatch):
    df = spark.createDataFrame([(["B-X", "I-X", "I-Y"], ["B-X", "I-X", "B-Y"]), (["B-Z"], ["-100"]), ([], []), (["O", "I-X"], ["I-X", "O"])] * 3, "p array<string>, y array<string>").coalesce(1)
    rows = df.toArrow().to_batches()
    want = [sorted(map(str, b.to_pylist())) for b in M._span_counts(iter(rows))]
    monkeypatch.setattr(M, "TAGS_AT_ONCE", 1)
    assert [sorted(map(str, b.to_pylist())) for b in M._span_counts(iter(rows))] == want and "'Z'" not in str(want)


def test_offsets_over_flat_buffers(spark, tmp_path, monkeypatch):
    """Tokens, word ids and spans of texts with wide spaces, marks, Hangul, blanks only, nothing, and no text."""
    from inkmill.functions import pretok
    from inkmill.plans import REGISTRY

    texts = ["the then, the", "cafe\u0301\u2003\uac01\u00a0na\u0308ive\x85dog", " \t\u3000", "", None, "\u0130 \u20ac5 \U0001d504b" + " the" * 40] * 3
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(pretok, "ITEMS_AT_ONCE", 5)
    df = REGISTRY["encode_with_offsets"].run(spark, str(tmp_path))
    assert "aggregate" not in _plan(df)  # no sum over the pieces before each piece
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == len(texts) and rows[2].starts == rows[2].tokens == rows[3].tokens == ""
    assert rows[4].starts is None and rows[4].ends is None and rows[4].tokens == rows[4].word_ids == ""  # no text
    for doc, text in enumerate(texts):
        if not text or not text.strip():
            continue
        row = rows[doc]
        pieces, ids, starts, ends = row.tokens.split(" "), *([int(x) for x in getattr(row, c).split(" ")] for c in ("word_ids", "starts", "ends"))
        assert len(pieces) == len(ids) == len(starts) == len(ends) and ids[0] == 0 and sorted(ids) == ids
        for piece, a, b in zip(pieces, starts, ends):
            plain = unicodedata.normalize("NFD", text[a:b].lower())
            plain = "".join(c for c in plain if unicodedata.category(c) != "Mn")
            assert piece.removeprefix("##") in plain and 0 <= a < b <= len(text)
    first = rows[0]
    assert first.word_ids.split(" ")[-1] == "3" and first.starts.split(" ")[0] == "0" and first.ends.split(" ")[-1] == "13"


def test_normalize_text_of_all_kinds(spark):
    texts = ["", "ABC z", "\u00c9\u00e0 \u0130I", "e\u0301x", "\uac01\uac00", None, "\u1e69\u0323"]
    got = spark.createDataFrame([(x,) for x in texts], "text string").select(T.normalize_text("text").alias("n")).collect()
    for text, r in zip(texts, got):
        want = None if text is None else "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
        assert r.n == want
