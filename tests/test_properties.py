"""Operators against brute force and against what must always hold."""

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.operators import blocks, combine, encoding, examples as X, knn, metrics as M, ordering, qa, sampling, training, vocab
from inkmill.sources import writers


def test_row_numbers_on_clustered_ids(spark):
    ids = sorted({*range(500), 10**15, *range(10**9, 10**9 + 50)})
    df = spark.createDataFrame([(i, "abc"[k % 3]) for k, i in enumerate(ids)], "id bigint, g string").repartition(5)
    rows = ordering.global_row_number(df, "id", n_buckets=7).orderBy("id").collect()
    assert [r.row_no for r in rows] == list(range(1, len(ids) + 1))
    grouped = ordering.global_row_number(df, "id", ["g"]).orderBy("g", "id").collect()
    seen = Counter()
    for r in grouped:
        seen[r.g] += 1
        assert r.row_no == seen[r.g]


def test_row_numbers_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint")
    assert ordering.global_row_number(df, "id").count() == 0
    assert sampling.train_test_split_frac(df, "id", 0.8, 1).count() == 0


def test_batches_are_full(spark):
    df = spark.range(103)
    sizes = sorted(r["count"] for r in ordering.batch_assign(df, 10, "id").groupBy("batch_id").count().collect())
    assert sizes == [3] + [10] * 10


@pytest.mark.parametrize("n,share", [(1000, 0.8), (7, 0.9), (1, 0.5)])
def test_split_sizes(spark, n, share):
    out = sampling.train_test_split_frac(spark.range(n), "id", share, 42).collect()
    sizes = Counter(r.split for r in out)
    assert sizes["train"] == math.floor(share * n) and len({r.id for r in out}) == n


def test_absolute_split_needs_rows(spark):
    with pytest.raises(Exception, match="fewer rows"):
        sampling.train_test_split_abs(spark.range(5), "id", 4, 2, 1).collect()


def test_sample_is_head_of_permutation(spark):
    small = {r.id for r in sampling.sample_n(spark.range(300), "id", 40, 7).collect()}
    assert {r.id for r in sampling.shuffle_seeded(spark.range(300), "id", 7).filter("position < 40").collect()} == small and len(small) == 40


def test_interleave_stops_at_shortest(spark):
    a, b, c = spark.range(0, 9), spark.range(100, 104), spark.range(200, 206)
    rows = combine.interleave_datasets([a, b, c], "id").orderBy("position").collect()
    assert [r.id for r in rows] == [0, 100, 200, 1, 101, 201, 2, 102, 202, 3, 103, 203]
    assert combine.interleave_datasets([a, b.filter("false")], "id").count() == 0


def test_group_texts_keeps_order_and_drops_tails(spark):
    rng = random.Random(3)
    docs, at = [], 0
    for i in range(60):
        n = rng.choice([0, 1, 5, 40, 200])
        docs.append((i, list(range(at, at + n))))
        at += n
    df = spark.createDataFrame(docs, "doc_id bigint, ids array<int>").repartition(4)
    got = {(r.batch_id, r.chunk_id): r.ids for r in X.group_texts(df, "ids", "doc_id", chunk=16, batch_rows=25).collect()}
    want = {}
    for b in range(0, 60, 25):
        flat = [x for _, ids in docs[b:b + 25] for x in ids]
        for c in range(len(flat) // 16):
            want[(b // 25, c)] = flat[c * 16:c * 16 + 16]
    assert got == want


def test_mask_rates(spark):
    df = spark.createDataFrame([(i, [101] + list(range(1000, 1100)) + [102]) for i in range(200)], "doc_id int, ids array<int>")
    rows = X.mlm_mask(df, "ids", ["doc_id"], 103, 5000, special_ids=(101, 102)).collect()
    labels = [x for r in rows for x in r.labels]
    hits = sum(x != -100 for x in labels)
    n = 200 * 100
    assert abs(hits - 0.15 * n) < 3 * math.sqrt(n * 0.15 * 0.85)
    assert all(r.labels[0] == r.labels[-1] == -100 for r in rows)
    masked = sum(x == 103 for r in rows for x in r.ids)
    assert abs(masked - 0.8 * hits) < 4 * math.sqrt(hits * 0.8 * 0.2)
    again = X.mlm_mask(df, "ids", ["doc_id"], 103, 5000, special_ids=(101, 102), epoch=1).collect()
    assert again != rows


def test_whole_word_index_ignores_nulls(spark):
    df = spark.createDataFrame([([None, 0, 0, 1, None, 1, 2, None],), ([None, None],), ([],)], "w array<int>")
    got = [r.idx for r in X.add_word_index(df, "w", "idx").collect()]
    assert got == [[None, 0, 0, 1, None, 1, 2, None], [None, None], []]


def test_training_batches(spark):
    df = spark.createDataFrame([(i, [1] * (i % 7), "train") for i in range(50)], "doc_id bigint, ids array<int>, split string")
    rows = writers.training_batches(df, "doc_id", "ids", 8, seed=1).collect()
    assert sorted(r.doc_id for r in rows) == list(range(50))
    for batch in {r.batch_id for r in rows}:
        assert len({len(r.ids) for r in rows if r.batch_id == batch}) == 1
    assert all(sum(r.attention_mask) == r.doc_id % 7 for r in rows)


def test_nbest_against_loops(spark):
    rng = np.random.default_rng(5)
    context = "".join(chr(97 + i % 26) for i in range(200))
    features, want = [], {}
    for e in range(12):
        best = None
        for f in range(3):
            s, t = np.round(rng.normal(size=40), 1), np.round(rng.normal(size=40), 1)
            off = [None if rng.random() < 0.3 else (3 * i, 3 * i + 2) for i in range(40)]
            if e == 0:
                off = [None] * 40
            features.append((e * 3 + f, e, s.tolist(), t.tolist(), off))
            tops = [sorted(range(40), key=lambda i, v=v: (-v[i], i))[:20] for v in (s, t)]
            for a in tops[0]:
                for b in tops[1]:
                    if off[a] and off[b] and b >= a and b - a + 1 <= 30:
                        score = s[a] + t[b]
                        if best is None or score > best[0]:
                            best = (score, context[off[a][0]:off[b][1]])
        want[e] = best[1] if best else ""
    examples = spark.createDataFrame([(e, context) for e in range(13)], "example_id bigint, context string")
    frame = spark.createDataFrame(features, "feature_id bigint, example_id bigint, start_logits array<double>, end_logits array<double>, offset_mapping array<struct<start int, end int>>")
    got = {r.example_id: r.prediction_text for r in qa.qa_nbest_span(examples, frame).collect()}
    assert got == {**want, 12: ""}


@pytest.mark.parametrize("metric", ["l2", "dot", "cosine"])
def test_neighbours(spark, metric):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(120, 8)).astype("float32")
    vectors[40:80] = vectors[40]  # a third of all rows are copies
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    queries = base.select(F.col("vec_id").alias("query_id"), "embedding")
    exact = sorted(map(tuple, knn.knn_exact(base, queries, 4, metric, exclude_self=True).select("query_id", "rank", "vec_id").collect()))
    blocked = sorted(map(tuple, knn.knn_blocked(base, queries, 4, metric, True, block_rows=30).select("query_id", "rank", "vec_id").collect()))
    v = vectors.astype("float64")
    want = []
    for i in range(120):
        if metric == "l2":
            near = -((v - v[i]) ** 2).sum(axis=1)
        else:
            near = v @ v[i] / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[i]) if metric == "cosine" else 1)
        order = sorted((j for j in range(120) if j != i), key=lambda j: (-round(near[j], 9), j))
        want += [(i, k + 1, j) for k, j in enumerate(order[:4])]
    assert exact == blocked == want


def test_many_queries_take_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "MAX_QUERIES", 3)
    base = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(9)], "vec_id bigint, embedding array<float>")
    rows = knn.knn_exact(base, base.select(F.col("vec_id").alias("query_id"), "embedding"), 1).collect()
    assert sorted((r.query_id, r.vec_id) for r in rows) == [(i, i) for i in range(9)]


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert M.lcs_length(a, b) == lcs_table(a, b)
        codes = [np.array([ord(c) for c in s], dtype="int64") for s in (a, b)]
        found = M.lcs_positions(*codes)
        assert len(found) == lcs_table(a, b)
        assert lcs_table([a[i] for i in sorted(found)], b) == len(found)
        assert M.union_lcs_hits([b], [a]) == lcs_table(a, b)


def bleu_by_hand(pairs):
    import re

    hit, total, c, r = [0] * 4, [0] * 4, 0, 0
    for p, q in pairs:
        p, q = (re.findall(r"\w+|[^\w\s]", s) for s in (p, q))
        c, r = c + len(p), r + len(q)
        for n in range(4):
            a, b = (Counter(tuple(s[i:i + n + 1]) for i in range(len(s) - n)) for s in (p, q))
            hit[n] += sum((a & b).values())
            total[n] += sum(a.values())
    misses, logs = 0, 0.0
    for n in range(4):
        if total[n] == 0:
            return 0.0
        misses += hit[n] == 0
        logs += math.log(hit[n] / total[n] if hit[n] else 1 / (2**misses * total[n]))
    return 100 * (1 if c >= r else math.exp(1 - r / c)) * math.exp(logs / 4)


@pytest.mark.parametrize("pairs", [
    [("A Spark job reads many small files from one shared folder, slowly.",
      "One Spark job slowly reads many small files from one shared folder.")],
    [("one one one one", "one job reads files.")],
    [("a b c d e", "a b c d e"), ("x y", "x z y")],
    [("one two", "one two three")],
])
def test_bleu(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "k int, p string, r string")
    assert M.bleu(df, "k", "p", "r").first().bleu == pytest.approx(bleu_by_hand(pairs), abs=1e-9)


# Trainers against slow loops over plain lists.

CORPUS = ["this is a small course on tokens.", "this chapter shows how words fall apart.",
          "aaaa aaa abab ababab banana bananas cabana", "several tokenizers are trained and tested on this."]


def word_table(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return vocab.word_freqs(df, "doc_id", F.split("text", " "))


def counted(texts):
    return Counter(w for text in texts for w in text.split(" "))


def glue(parts, left, right, merged):
    out = []
    for p in parts:
        if out and out[-1] == left and p == right:
            out[-1] = merged
        else:
            out.append(p)
    return out


def slow_train(words, continuation, n, by_score):
    splits = {w: [c if not i else continuation + c for i, c in enumerate(w)] for w in words}
    merges = []
    for _ in range(n):
        pairs, letters = {}, Counter()
        for w, f in words.items():
            for s in splits[w]:
                letters[s] += f
            for p in zip(splits[w], splits[w][1:]):
                pairs[p] = pairs.get(p, 0) + f
        if not pairs:
            break
        value = {p: f / (float(letters[p[0]]) * letters[p[1]]) for p, f in pairs.items()} if by_score else pairs
        top = max(value.values())
        best = next(p for p in pairs if value[p] == top)
        merged = training.joined_token(*best, continuation)
        merges.append((*best, merged))
        splits = {w: glue(s, *best, merged) for w, s in splits.items()}
    return merges


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_train_bpe(spark, seed):
    rng = random.Random(seed)
    texts = CORPUS if seed == 0 else [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(12)) for _ in range(4)]
    tokens, merges = training.train_bpe(word_table(spark, texts), n_merges=25)
    want = slow_train(counted(texts), "", 25, False)
    assert [(m.left, m.right, m.merged) for m in merges] == want
    assert tokens[0] == "<|endoftext|>" and tokens[-len(want):] == [m[2] for m in want]


def test_train_bpe_stops_without_pairs(spark):
    tokens, merges = training.train_bpe(word_table(spark, ["ab ab c"]), vocab_size=50)
    assert [m.merged for m in merges] == ["ab"] and tokens == ["<|endoftext|>", "a", "b", "c", "ab"]


def test_train_wordpiece(spark):
    _, merges = training.train_wordpiece(word_table(spark, CORPUS), n_merges=8)
    assert [(m.left, m.right, m.merged) for m in merges] == slow_train(counted(CORPUS), "##", 8, True)


def segmentations(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        for rest in segmentations(word[i:]):
            yield [word[:i], *rest]


def best_score(word, scores, skip=None):
    fits = [sum(scores[p] for p in s) for s in segmentations(word) if all(p in scores and p != skip for p in s)]
    return min(fits) if fits else None


def test_viterbi_against_all_segmentations(spark):
    rng = random.Random(4)
    tokens = ["a", "b", "ab", "ba", "aab", "bb", "abba", "aba"]
    scores = {x: rng.random() * len(x) for x in tokens}
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(30)] + ["abz"]
    df = spark.createDataFrame([(w, 1) for w in dict.fromkeys(words)], "word string, freq bigint")
    for r in encoding.viterbi_words(df, scores, start_score=0.0, removals=True).collect():
        want = best_score(r.word, scores)
        if want is None:
            assert r.score is None and r.pieces == ["<unk>"]
            continue
        assert r.score == pytest.approx(want) and "".join(r.pieces) == r.word
        for w in r.without:
            assert w.score == pytest.approx(best_score(r.word, scores, w.token))


def test_train_unigram(spark):
    words = counted(CORPUS)
    pieces = Counter()
    for w, f in words.items():
        pieces.update({w[i:j]: 0 for i, j in combinations(range(len(w) + 1), 2)})
        for i, j in combinations(range(len(w) + 1), 2):
            pieces[w[i:j]] += f
    chars = {t: f for t, f in pieces.items() if len(t) == 1}
    longer = Counter({t: f for t, f in pieces.items() if len(t) > 1})
    model = {**chars, **dict(longer.most_common(60 - len(chars)))}

    def losses(freqs, skip=None):
        total = sum(freqs.values())
        scores = {t: -math.log(f / total) for t, f in freqs.items()}
        return sum(f * encoding._viterbi(w, scores, 20, 1.0, skip)[1] for w, f in words.items())

    while len(model) > 40:
        base = losses(model)
        grown = {t: round(losses(model, t) - base, 8) for t in model if len(t) > 1}
        for t in sorted(grown, key=grown.get)[:int(len(model) * 0.1)]:
            del model[t]
    got = training.train_unigram(word_table(spark, CORPUS), vocab_size=40, seed_size=60)
    assert set(got) == set(model)
    assert got["a"] == pytest.approx(-math.log(model["a"] / sum(model.values())))


def test_encode_bpe_applies_rules_once(spark):
    merges = [("a", "b"), ("x", "abc"), ("b", "c"), ("ab", "c"), ("a", "bc")]
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(merges)], "rank int, left string, right string")
    words = ["abc", "xabc", "xbc", "ababab", "aabc", ""]
    df = spark.createDataFrame([(words,)], "w array<string>")
    got = encoding.encode_bpe(df, F.col("w"), table).first().pieces
    want = []
    for w in words:
        parts = list(w)
        for a, b in merges:
            parts = glue(parts, a, b, a + b)
        want.append(parts)
    assert got == want


def test_dictionary_join_keeps_empty_rows(spark):
    vocab_table = spark.createDataFrame([("a", 5), ("b", 6)], "token string, id int")
    df = spark.createDataFrame([(1, ["b", "z", "a", "b"]), (2, [])], "doc_id int, w array<string>")
    rows = {r.doc_id: r.input_ids for r in encoding.dictionary_encode_join(df, "doc_id", F.col("w"), vocab_table, 1).collect()}
    assert rows == {1: [6, 1, 5, 6], 2: []}


def test_overlap_counts_inside_the_row(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice("abc") for _ in range(draw.randrange(12))], [draw.choice("abcd") for _ in range(draw.randrange(12))]) for i in range(40)]
    rows += [(40, None, ["a"]), (41, ["a"], None), (42, None, None), (43, [], []), (0, ["a", "a"], ["a"])]
    table = spark.createDataFrame(rows, "k int, p array<string>, r array<string>")
    counted = M.overlap_counts(table, "k", "p", "r", [1, 2, 3])
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()

    def grams(tokens, n):
        return Counter(tuple((tokens or [])[i:i + n]) for i in range(len(tokens or []) - n + 1))

    want = [(k, n, sum(grams(p, n).values()), sum(grams(r, n).values()), sum((grams(p, n) & grams(r, n)).values())) for k, p, r in rows for n in (1, 2, 3)]
    assert sorted(map(tuple, counted.collect())) == sorted(want)


@pytest.mark.parametrize("step", [2, 12])
def test_substrings_grown_to_a_bound(spark, step):
    draw = random.Random(8)
    rows = [("".join(draw.choice("ab") for _ in range(draw.randrange(1, 16))), draw.randrange(1, 5)) for _ in range(30)]
    rows = [(w, n, i) for i, (w, n) in enumerate(dict(rows).items())]
    words = spark.createDataFrame(rows, "word string, freq bigint, rank bigint")
    every = vocab.subword_freqs(words)
    assert sorted(vocab.subword_freqs(words, min_freq=7, step=step).collect()) == sorted(every.filter("freq >= 7").collect())
    order = lambda r: (-r.freq, r.first)
    want = sorted(every.collect(), key=order)
    got = sorted(vocab.subword_freqs(words, top=25, step=step).collect(), key=order)
    assert got == [r for r in want if r.freq >= want[24].freq]


def test_substrings_of_a_long_word(spark):
    draw = random.Random(9)
    words = spark.createDataFrame([("".join(draw.choices("0123456789abcdef", k=20_000)), 1), ("abcabc", 3), ("x", 9)], "word string, freq bigint")
    word = words.first().word
    got = {r.token: r.freq for r in vocab.subword_freqs(words, min_freq=60).collect()}
    want = Counter(word[i:i + 2] for i in range(len(word) - 1)) + Counter({"ab": 6, "bc": 6, "ca": 3})
    assert got == {t: n for t, n in want.items() if n >= 60}


@pytest.mark.parametrize("size", [3, 1000])
def test_look_up_in_blocks(spark, size):
    draw = random.Random(11)
    rows = [(draw.choice([None, *range(30)]), [draw.choice([None, "", "a", "b", "c", "dd"]) for _ in range(draw.randrange(6))]) for _ in range(40)]
    rows += [(50, None), (51, []), (52, None)]
    df = spark.createDataFrame(rows, "k int, w array<string>").repartition(3)
    table = spark.createDataFrame([("a", 7), ("a", 3), ("b", None), ("", 1), (None, 9), ("unseen", 4)], "token string, id int")
    known = {"a": [3, 7], "b": [0], "": [1]}
    got = blocks.look_up(df, "k", F.col("w"), blocks.table_values(table, "token", "id", F.lit(0)), "array<int>", "v", size).collect()
    want = {}
    for k, w in rows:
        want.setdefault(k, []).extend((i, known.get(x, [0])) for i, x in enumerate(w or []))
    assert len(got) == len(want) and {r.k: r.v for r in got} == {k: [v for _, v in sorted(e)] for k, e in want.items()}


def test_join_forms_shuffle_no_token(spark):
    words = F.array_repeat(F.lit("ab"), 1000)
    table = spark.createDataFrame([("ab", 5)], "token string, id int")
    entries = blocks._write_blocks(spark.range(50), "id", words, 10_000).filter("_items IS NOT NULL")
    assert entries.agg(F.sum(F.size("_items"))).first()[0] <= 8 * 2
    assert {tuple(r.input_ids) for r in encoding.dictionary_encode_join(spark.range(50), "id", words, table, 1).collect()} == {(5,) * 1000}


def test_few_substrings_are_counted_for_the_most_frequent(spark, monkeypatch):
    draw, counted = random.Random(12), []
    words = [("the", 5000), ("then", 4000)] + [("".join(draw.choices("bcdfghjklmnpqrsvwxyz", k=12)), 1) for _ in range(200)]
    df = spark.createDataFrame([(w, f, i) for i, (w, f) in enumerate(words)], "word string, freq bigint, rank bigint")
    cut = vocab.cut_lineage
    monkeypatch.setattr(vocab, "cut_lineage", lambda t: (counted.append(out := cut(t)), out)[1])
    got = {r.token: (r.freq, r.first) for r in vocab.subword_freqs(df, top=4).collect()}
    assert got == {"th": (9000, 0), "he": (9000, 1), "the": (9000, 0), "en": (4000, (1 << 20) + 2), "hen": (4000, (1 << 20) + 1), "then": (4000, 1 << 20)}
    assert sum(t.count() for t in counted if "token" in t.columns) < 6000  # 12,500 with all substrings up to 13 characters


def test_blocks_of_neighbours_are_no_more_than_cores_need(spark):
    draw = random.Random(13)
    base = spark.createDataFrame([(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(300)], "vec_id bigint, embedding array<float>")
    queries = base.withColumnRenamed("vec_id", "query_id")
    small = knn.knn_blocked(base, queries, 3, "l2", True, block_rows=20)
    plan = small._jdf.queryExecution().analyzed().toString()
    assert plan.count("explode(sequence(0, 5, ") == 2  # 2 * ceil(sqrt(8 cores)) blocks a side, not 15
    key = ["query_id", "rank", "vec_id"]
    assert sorted(map(tuple, small.select(*key).collect())) == sorted(map(tuple, knn.knn_blocked(base, queries, 3, "l2", True).select(*key).collect()))
