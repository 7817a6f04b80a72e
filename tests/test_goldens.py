"""Hand-checked results on small rows."""

import math

import pytest
from pyspark.sql import functions as F

from inkmill.functions import arrays as A, pretok as P, text as T
from inkmill.operators import encoding, examples as X, metrics as M, predict, qa, shaping
from inkmill.plans.tables import LABEL_NAMES

SENTENCE = "Hello, how are  you?"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def text_row(spark, text):
    return spark.createDataFrame([(0, text)], "doc_id bigint, text string")


def spans(df):
    return [tuple(p) for p in one(df).pieces]


def test_normalize(spark):
    row = one(text_row(spark, "Héllò hôw are ü?").select(T.normalize_text("text"), T.normalize_text_full("text")))
    assert row[0] == row[1] == "hello how are u?"


def test_pretok_bert_offsets(spark):
    got = spans(P.piece_offsets(text_row(spark, SENTENCE), "text"))
    assert got == [("Hello", 0, 5), (",", 5, 6), ("how", 7, 10), ("are", 11, 14), ("you", 16, 19), ("?", 19, 20)]


def test_pretok_bytelevel_offsets(spark):
    got = spans(P.bytelevel_offsets(text_row(spark, SENTENCE), "text"))
    assert got == [("Hello", 0, 5), (",", 5, 6), ("Ġhow", 6, 10), ("Ġare", 10, 14), ("Ġ", 14, 15), ("Ġyou", 15, 19), ("?", 19, 20)]


def test_pretok_metaspace_offsets(spark):
    got = spans(P.metaspace_offsets(text_row(spark, SENTENCE), "text"))
    assert got == [("▁Hello,", 0, 6), ("▁how", 7, 10), ("▁are", 11, 14), ("▁you?", 16, 20)]


def test_pretok_whitespace_and_sequence(spark):
    row = one(text_row(spark, "Let's test my pre-tokenizer...").select(
        P.pretok_whitespace("text").alias("w"), P.pretok_sequence("text").alias("s")))
    assert row.w == ["Let", "'", "s", "test", "my", "pre", "-", "tokenizer", "..."]
    assert row.s == ["Let", "'", "s", "test", "my", "pre", "-", "tokenizer", ".", ".", "."]


def test_byte_level_round_trip(spark):
    text = "Ünï cödé 😀\n\ttabs  and ­ soft"
    row = one(text_row(spark, text).select(P.from_byte_level(F.array_join(P.pretok_bytelevel("text"), "")).alias("back")))
    assert row.back == text


def test_word_count_and_strip(spark):
    rows = spark.createDataFrame([("  a  b\n",), ("",), ("  ",)], "text string").select(
        T.word_count("text").alias("n"), T.strip("text").alias("s")).collect()
    assert [(r.n, r.s) for r in rows] == [(2, "a  b"), (0, ""), (0, "")]


def test_html_unescape(spark):
    text = "I&#039;m &amp;lt; caf&eacute; &#x41; &amp"
    row = one(text_row(spark, text).select(T.html_unescape("text").alias("exact"), T.html_unescape_native("text").alias("native")))
    assert row.exact == "I'm &lt; café A &"
    assert row.native == row.exact


def test_keyword_filter(spark):
    rows = spark.createDataFrame([("import numpy as np",), ("import pandas as pd",)], "text string")
    words = ["pandas", "sklearn", "matplotlib", "seaborn"]
    assert [r.text for r in shaping.filter_keywords(rows, "text", words).collect()] == ["import pandas as pd"]
    many = words + [f"never.{i}(" for i in range(60)]
    assert [r.text for r in shaping.filter_keywords(rows, "text", many).collect()] == ["import pandas as pd"]
    kept = one(shaping.keyword_retention(rows, "text", words))
    assert (kept.total, kept.kept, kept.retained) == (2, 1, 0.5)
    assert one(shaping.keyword_retention(rows.filter("false"), "text", words)).retained is None


def test_wordpiece_encode(spark):
    vocab = spark.createDataFrame([(x,) for x in ("hug", "b", "##s", "##u", "##gs")], "token string")
    words = spark.createDataFrame([(["hugs", "bugs", "mug", "bum"],)], "w array<string>")
    assert one(encoding.encode_wordpiece(words, F.col("w"), vocab)).pieces == [["hug", "##s"], ["b", "##u", "##gs"], ["[UNK]"], ["[UNK]"]]


def test_piece_spans(spark):
    vocab = spark.createDataFrame([(x,) for x in ("hug", "##s")], "token string")
    df = P.piece_offsets(text_row(spark, " hugs zz"), "text", out="words")
    df = encoding.encode_wordpiece(df, F.transform("words", lambda w: w["token"]), vocab)
    row = one(df.select(encoding.piece_spans("pieces", "words").alias("s"), encoding.word_ids("pieces").alias("w")))
    assert [tuple(s) for s in row.s] == [(1, 4), (4, 5), (6, 8)]
    assert row.w == [0, 0, 1]


def test_unigram_probability(spark):
    scores = {"p": 5 / 210, "u": 36 / 210, "g": 20 / 210}
    words = spark.createDataFrame([("pug", 1), ("pux", 1)], "word string, freq bigint")
    rows = {r.word: r for r in encoding.viterbi_words(words, {k: -math.log(v) for k, v in scores.items()}).collect()}
    assert rows["pug"].pieces == ["p", "u", "g"]
    assert math.exp(-(rows["pug"].score - 1)) == pytest.approx(0.000389, abs=1e-6)
    assert rows["pux"].pieces == ["<unk>"] and rows["pux"].score is None


def test_align_labels(spark):
    df = spark.createDataFrame([([None, 0, 1, 1, 2, 2, None], [3, 0, 7])], "word_ids array<int>, tags array<int>")
    assert one(A.align_labels(df, "word_ids", "tags", "labels")).labels == [-100, 3, 0, 0, 7, 8, -100]


TAGS = [LABEL_NAMES[i] for i in (3, 0, 7, 0, 0, 0, 7, 0, 0)]


def test_label_names():
    assert TAGS == ["B-ORG", "O", "B-MISC", "O", "O", "O", "B-MISC", "O", "O"]


def test_seqeval(spark):
    predicted = TAGS.copy()
    predicted[2] = "O"
    df = spark.createDataFrame([(predicted + ["B-PER"], TAGS + ["-100"])], "p array<string>, y array<string>")
    rows = {r.type: r for r in M.seqeval(df, "p", "y").collect()}
    misc, org, overall = rows["MISC"], rows["ORG"], rows["overall"]
    assert (misc.precision, misc.recall, round(misc.f1, 2), misc.number) == (1.0, 0.5, 0.67, 2)
    assert (org.precision, org.recall, org.f1, org.number) == (1.0, 1.0, 1.0, 1)
    assert (overall.precision, round(overall.recall, 2), overall.f1, round(overall.accuracy, 2)) == (1.0, 0.67, 0.8, 0.89)


def test_entity_span_rules(spark):
    tags = ["I-PER", "I-PER", "B-PER", "I-LOC", "O", "I-LOC", "B-LOC"]
    df = spark.createDataFrame([(tags,), ([],)], "t array<string>").select(A.entity_spans("t").alias("s"))
    full, empty = [[tuple(x) for x in r.s] for r in df.collect()]
    assert full == [("PER", 0, 1), ("PER", 2, 2), ("LOC", 3, 3), ("LOC", 5, 5), ("LOC", 6, 6)]
    assert empty == []


def test_dynamic_padding(spark):
    df = spark.createDataFrame([(0, 0, [200, 200, 200]), (1, 0, [200, 200]), (2, 1, [7])], "i int, batch_id int, ids array<int>")
    rows = {r.i: r for r in X.pad_dynamic(df, "ids", ["batch_id"], pad_id=9).collect()}
    assert rows[1].ids == [200, 200, 9] and rows[1].attention_mask == [1, 1, 0]
    assert rows[2].ids == [7] and rows[0].attention_mask == [1, 1, 1]


def test_pair_template(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5])], "a array<int>, b array<int>")
    row = one(df.select(A.template_pair("a", "b", F.lit(101), F.lit(102)).alias("ids"), A.pair_type_ids("a", "b").alias("types")))
    assert row.ids == [101, 1, 2, 3, 102, 4, 5, 102] and row.types == [0, 0, 0, 0, 0, 1, 1, 1]


@pytest.mark.parametrize("n,kept", [(300, 2), (256, 2), (127, 0), (0, 0)])
def test_chunk_overflow(spark, n, kept):
    df = spark.createDataFrame([(1, list(range(n)))], "doc_id int, ids array<int>")
    rows = X.chunk_overflow(df, "ids", 128).orderBy("chunk_id").collect()
    assert [r.ids for r in rows] == [list(range(k * 128, k * 128 + 128)) for k in range(kept)]


def test_shift_right_and_clm(spark):
    df = spark.createDataFrame([([5, 6, 2, -100],)], "l array<int>")
    assert one(df.select(A.shift_right("l", 0, 1).alias("x"))).x == [0, 5, 6, 2]
    assert one(df.select(A.clm_labels("l", 2).alias("x"))).x == [5, 6, -100, -100]


def qa_frame(spark, question, context):
    df = spark.createDataFrame([("e", question, context)], "example_id string, question string, context string")
    return P.piece_offsets(P.piece_offsets(df, "question", out="q"), "context", out="c")


def test_qa_windows_and_labels(spark):
    context = " ".join(f"w{i}" for i in range(30))
    start = context.index("w12")
    df = qa_frame(spark, "one two three", context).withColumns({"a": F.lit(start), "b": F.lit(start + len("w12 w13"))})
    windows = qa.span_labels(qa.qa_windows(df, "q", "c", max_length=16, stride=4), "q", "ctx", "a", "b").orderBy("window").collect()
    # Ten context tokens per window, step six: 0-9, 6-15, 12-21, 18-27, 24-29.
    assert [[t.token for t in w.ctx][0] for w in windows] == ["w0", "w6", "w12", "w18", "w24"]
    assert [(w.start_position, w.end_position) for w in windows] == [(0, 0), (11, 12), (5, 6), (0, 0), (0, 0)]


def test_qa_windows_need_room(spark):
    df = qa_frame(spark, "a b c d", "x " * 50)
    with pytest.raises(Exception, match="question too long"):
        qa.qa_windows(df, "q", "c", max_length=10, stride=4).collect()


def test_rouge(spark):
    df = spark.createDataFrame([(1, "I absolutely loved reading the Hunger Games", "I loved reading the Hunger Games")], "k int, p string, r string")
    rows = {r.n: r for r in M.rouge_n(df, "k", "p", "r").collect()}
    assert [round(x, 2) for x in rows[1][1:]] == [0.86, 1.0, 0.92]
    assert [round(x, 2) for x in rows[2][1:]] == [0.67, 0.8, 0.73]
    for scored in (M.rouge_l_rows(df, "k", "p", "r"), M.rouge_lsum_rows(df, "k", "p", "r")):
        assert [round(x, 2) for x in one(M.mean_scores(scored))] == [0.86, 1.0, 0.92]


def test_squad(spark):
    df = spark.createDataFrame([(1, "The  Cat!", ["a dog", "cat"]), (2, "red big house", ["the big house."])], "k int, p string, refs array<string>")
    row = one(M.squad_em_f1(df, "k", "p", "refs"))
    assert (row.exact_match, round(row.f1, 4)) == (50.0, 90.0)


def test_accuracy_f1(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "p int, y int")
    assert tuple(one(M.accuracy_f1(df, "p", "y"))) == (0.5, 0.5)


def test_fill_mask(spark):
    vocab = spark.createDataFrame([("the", 0), ("deal", 1), ("idea", 2)], "token string, id int")
    df = spark.createDataFrame([("a great [MASK].", [9, 5], [[0.0, 0.0, 0.0], [0.1, 2.0, 1.0]])], "text string, ids array<int>, logits array<array<double>>")
    rows = predict.fill_mask_topk(df, "text", "ids", "logits", 5, vocab, 2).orderBy("rank").collect()
    assert [r.filled for r in rows] == ["a great deal.", "a great idea."]


def test_lead_summary(spark):
    row = one(text_row(spark, "One.  Two! Three? Four.").select(T.lead_summary("text", 3).alias("s")))
    assert row.s == "One.\nTwo!\nThree?"
