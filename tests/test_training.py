"""Many merges of a round, and removals from one run, against one at a time."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkmill.operators import encoding, runs, stretches, training, vocab
from inkmill.operators.merging import Runs, ScoredWords, apply_merges, cut_runs

STRIDE = 1000


def glued(symbols, pair, token):
    out, i = [], 0
    while i < len(symbols):
        if tuple(symbols[i:i + 2]) == pair:
            out.append(token)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def tables(words):
    """Counts and first places of pairs, counts of symbols."""
    pairs, first, letters = Counter(), {}, Counter()
    for k, (symbols, freq) in enumerate(words):
        for s in symbols:
            letters[s] += freq
        for i, p in enumerate(zip(symbols, symbols[1:])):
            pairs[p] += freq
            first.setdefault(p, k * STRIDE + i)
    return pairs, first, letters


def slow(words, n, by_score, joined):
    """One merge at a time, the first seen among the best; (merges, symbols)."""
    merges = []
    for _ in range(n):
        pairs, first, letters = tables(words)
        if not pairs:
            break
        value = {p: f / (float(letters[p[0]]) * float(letters[p[1]])) if by_score else f for p, f in pairs.items()}
        best = min(pairs, key=lambda p: (-value[p], first[p]))
        merges.append((best, value[best]))
        words = [(glued(s, best, joined(*best)), f) for s, f in words]
    return merges, [s for s, _ in words]


def random_words(rng, letters, mark=""):
    alphabet, words = letters[:rng.randint(1, len(letters))], {}
    for _ in range(rng.randint(1, 40)):
        words["".join(rng.choice(alphabet) for _ in range(rng.randint(1, rng.choice([4, 9, 25]))))] = rng.randint(1, rng.choice([1, 3, 50]))
    return [([c if not i else mark + c for i, c in enumerate(w)], f) for w, f in words.items()]


@pytest.mark.parametrize("seed", range(60))
def test_runs(seed):
    rng = random.Random(seed)
    words, n = random_words(rng, "abcd"), rng.randint(1, 60)
    want, symbols = slow(words, n, False, lambda a, b: a + b)
    known, got = {s for w, _ in words for s in w}, []
    while len(got) < n:
        pairs, _, _ = tables(words)
        if not pairs:
            break
        levels = sorted(pairs.values(), reverse=True)
        bound = levels[min(rng.randint(1, 8), len(levels)) - 1]
        runs = {}
        for k, (s, f) in enumerate(words):
            for start, run in cut_runs(s, {p for p in pairs if pairs[p] >= bound}):
                old = runs.get(tuple(run), (0, (k, start)))
                runs[tuple(run)] = (old[0] + f, min(old[1], (k, start)))
        table, found = Runs([(list(r), f) for r, (f, _) in sorted(runs.items(), key=lambda x: x[1][1])], bound, known), []
        while len(got) + len(found) < n and (best := table.best()):
            found.append(best)
            table.merge(best[0])
        assert found, "every look gives a merge"
        ranks = {}
        for i, (p, _) in enumerate(found):
            ranks.setdefault(p, []).append(i)
        words = [(apply_merges(s, ranks), f) for s, f in words]
        got += found
    assert got == want and [s for s, _ in words] == symbols


@pytest.mark.parametrize("seed", range(60))
def test_scored_words(seed):
    rng = random.Random(seed)
    words, n = random_words(rng, "abcdefgh", "##"), rng.randint(1, 60)
    joined = lambda a, b: training.joined_token(a, b, "##")
    want, symbols = slow(words, n, True, joined)
    known, got = {s for w, _ in words for s in w}, []
    while len(got) < n:
        pairs, first, letters = tables(words)
        if not pairs:
            break
        best = sorted((-(f / (float(letters[p[0]]) * float(letters[p[1]]))), first[p], p) for p, f in pairs.items())[:rng.randint(1, 12)]
        top = {b[2] for b in best}
        held = [(s, f, k) for k, (s, f) in enumerate(words) if any(p in top for p in zip(s, s[1:]))]
        own = {s for w, _, _ in held for s in w}
        table = ScoredWords(held, top, best[-1][:2], {p: (f, first[p]) for p, f in pairs.items() if own & set(p)}, letters, known, STRIDE)
        found = []
        while len(got) + len(found) < n and (one := table.best()):
            found.append(one)
            table.merge(one[0], joined(*one[0]))
        assert found, "every look gives a merge"
        ranks = {}
        for i, (p, _) in enumerate(found):
            ranks.setdefault(p, []).append(i)
        words = [(apply_merges(s, ranks, [joined(*p) for p, _ in found]), f) for s, f in words]
        got += found
    assert got == want and [s for s, _ in words] == symbols


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("aabcde") for _ in range(rng.randint(1, 12))) for _ in range(40)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return vocab.word_freqs(df, "doc_id", F.split("text", " ")), list(Counter(w for t in texts for w in t.split(" ")).items())


@pytest.mark.parametrize("max_symbols", [1_000_000, 1_500, 1])
def test_train_bpe_until_nothing_is_left(spark, corpus, max_symbols):
    """Also where the runs of many, or of all, pairs are too many for the driver."""
    freqs, words = corpus
    n = 10_000 if max_symbols > 1_500 else 60 if max_symbols > 1 else 8
    want, _ = slow([(list(w), f) for w, f in words], min(n, 400), False, lambda a, b: a + b)
    _, merges = training.train_bpe(freqs, n_merges=n, max_symbols=max_symbols)
    assert [((m.left, m.right), int(m.score)) for m in merges][:len(want)] == want
    assert len(merges) == n or len({w for w, _ in words}) == len({m.merged for m in merges} & {w for w, _ in words} | {w for w, _ in words if len(w) == 1})


@pytest.mark.parametrize("max_symbols", [1_000_000, 2_000, 1])
def test_train_wordpiece_by_many(spark, corpus, max_symbols):
    freqs, words = corpus
    n = 200 if max_symbols > 2_000 else 30 if max_symbols > 1 else 3
    splits = [([c if not i else "##" + c for i, c in enumerate(w)], f) for w, f in words]
    want, _ = slow(splits, n, True, lambda a, b: training.joined_token(a, b, "##"))
    _, merges = training.train_wordpiece(freqs, n_merges=n, max_symbols=max_symbols)
    assert [((m.left, m.right), m.score) for m in merges] == want


def test_trained_merges_encode(spark, corpus):
    """Merges of merges: the words coded by the trained rules are the words left by training."""
    freqs, words = corpus
    want, symbols = slow([(list(w), f) for w, f in words], 150, False, lambda a, b: a + b)
    _, merges = training.train_bpe(freqs, n_merges=150)
    table = spark.createDataFrame([([w for w, _ in words],)], "w array<string>")
    got = encoding.encode_bpe(table, F.col("w"), training.merge_table(spark, merges)).first().pieces
    assert got == symbols


@pytest.mark.parametrize("seed", range(20))
def test_removals_from_one_run(seed):
    rng = random.Random(seed)
    word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 14)))
    tokens = {word[i:j] for i in range(len(word)) for j in range(i + 1, len(word) + 1) if rng.random() < 0.4}
    scores = {t: rng.random() * len(t) for t in tokens}
    pieces, score, without = encoding._viterbi_removals(word, scores, 14, 1.0)
    assert (pieces, score) == encoding._viterbi(word, scores, 14, 1.0)
    assert set(without) == {p for p in pieces or [] if len(p) > 1}
    for piece, got in without.items():
        want = encoding._viterbi(word, scores, 14, 1.0, piece)[1]
        assert got == (want if want is None else pytest.approx(want))


def test_removals_join(spark, corpus):
    freqs, words = corpus
    rng = random.Random(1)
    scores = {c: 3.0 for c in "abcde"} | {w[i:i + n]: 3.0 + rng.random() for w, _ in words[:60] for n in (2, 3) for i in range(len(w) - n + 1)}
    plain = freqs.select("word", "freq")
    want = encoding.viterbi_words(plain, scores, removals=True)
    got = encoding.viterbi_words_join(plain, training.score_table(spark, scores), removals=True)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("seed", range(20))
def test_arrays_of_ids(seed, monkeypatch):
    """Pairs, runs and merges over Arrow buffers, in several chunks, against one word at a time."""
    rng = random.Random(seed)
    monkeypatch.setattr(runs, "SYMBOLS_AT_ONCE", rng.choice([1, 30, 10_000]))
    words = [([rng.randint(1, 5) for _ in range(rng.randint(2, 12))], rng.randint(1, 50)) for _ in range(60)]
    rows = pa.record_batch([pa.array([f for _, f in words]), pa.array(range(60)), pa.array([s for s, _ in words], pa.list_(pa.int32()))], ["freq", "rank", "syms"])
    batches = [rows.slice(0, 25), rows.slice(25, 0), rows.slice(25)]
    pairs, _, _ = tables(words)
    counts = Counter()
    for batch in runs.pair_sums(batches):
        for code, freq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[code >> 32, code & 0xFFFFFFFF] += freq
    assert counts == pairs

    frequent = set(rng.sample(sorted(pairs), min(len(pairs), 9)))
    codes = np.array(sorted(runs.pair_code(*p) for p in frequent), "int64")
    want, first = Counter(), {}
    for rank, (s, f) in enumerate(words):
        for start, run in cut_runs([chr(96 + x) for x in s], {(chr(96 + a), chr(96 + b)) for a, b in frequent}):
            want[tuple(ord(c) - 96 for c in run)] += f
            first.setdefault(tuple(ord(c) - 96 for c in run), rank * STRIDE + start)
    got, place = Counter(), {}
    for batch in runs.run_sums(batches, codes, STRIDE):
        for run, freq, at in zip(*(c.to_pylist() for c in batch.columns)):
            run = tuple(np.frombuffer(run, "int32").tolist())
            got[run] += freq
            place[run] = min(place.get(run, at), at)
    assert (got, place) == (want, first)

    order = sorted(frequent)
    rng.shuffle(order)
    ranks, tokens = {p: [i] for i, p in enumerate(order)}, [10 + i for i in range(len(order))]
    some = sorted(want)[::2]
    known = pa.array([np.array(r, "int32").tobytes() for r in some], pa.binary())
    done = runs.Merged(codes, ranks, tokens, known, pa.array([apply_merges(list(r), ranks, tokens) for r in some], pa.list_(pa.int32())))
    left = [row for batch in done.words(batches) for row in zip(*(c.to_pylist() for c in batch.columns))]
    assert left == [(f, k, m) for k, (s, f) in enumerate(words) if len(m := apply_merges(s, ranks, tokens)) > 1]


def test_first_places_are_kept():
    """The first place of a pair is not looked for among all its places each time."""
    table = Runs([(["a", "b", "c"], 1) for _ in range(50)], 1, {"a", "b", "c"})
    table._drop(("a", "b"), 0)
    assert table.first(("a", "b")) == 3 and table.smallest["a", "b"] == 3
    table._add(("a", "b"), 0)
    assert table.first(("a", "b")) == 0


def test_train_unigram_prunes_to_the_whole_size(spark, tmp_path):
    from inkmill.plans import REGISTRY

    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.token: r.neg_log_p for r in REGISTRY["train_unigram"].run(spark, str(tmp_path)).collect()}
    assert set("▁abcdefgh") < set(got) and 9 < len(got) <= 100  # 300 seeds, 219 after three rounds and 198 after four
    assert sum(2.718281828459045 ** -x for x in got.values()) == pytest.approx(1)


def test_stretches_against_places_one_by_one(monkeypatch):
    rng = random.Random(3)
    for _ in range(100):
        letters = "ab▁é😀c"[:rng.randint(1, 6)]
        tokens = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 6))}
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))]
        want = Counter()
        for freq, w in enumerate(words, 1):
            spanned = {b for i in range(len(w)) for j in range(i + 2, len(w) + 1) if w[i:j] in tokens for b in range(i + 1, j)}
            cuts = [b for b in range(len(w) + 1) if b not in spanned]
            want.update({w[a:b]: 0 for a, b in zip(cuts, cuts[1:]) if b - a > 1})
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    want[w[a:b]] += freq
        monkeypatch.setattr(stretches, "BYTES_AT_ONCE", rng.choice([5, 100, 4_000_000]))
        monkeypatch.setattr(stretches, "HELD_STRETCHES", rng.choice([1, 200_000]))
        batch = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(range(1, len(words) + 1), pa.int64())], ["word", "freq"])
        got = Counter()
        for part in stretches.stretch_sums(iter([batch]), stretches.Tokens(tokens)):
            for word, freq in zip(*[c.to_pylist() for c in part.columns]):
                got[word] += freq
        assert got == want


def test_unigram_rounds_see_distinct_stretches(spark, monkeypatch):
    """Each word is a shared part behind a letter of its own that no token spans: the losses are those of all words."""
    rows = [(chr(0x4e00 + i) + p, 1 + i % 3, i) for i, p in enumerate(["abab", "abcab", "bcbc"] * 30)]
    words = spark.createDataFrame(rows, "word string, freq long, first_seen long")
    seen, losses = [], training.unigram_losses

    def watched(table, scores):
        seen.append(table.count())
        want = {r.token: (r.lost, float(r.increase)) for r in losses(words, scores).collect()}
        got = {r.token: (r.lost, float(r.increase)) for r in losses(table, scores).collect()}
        assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t], abs=1e-6) for t in want)
        return losses(table, scores)

    monkeypatch.setattr(training, "unigram_losses", watched)
    got = training.train_unigram(words, vocab_size=96, seed_size=100)
    assert len(got) <= 96 and seen and max(seen) <= 6  # 90 distinct words
