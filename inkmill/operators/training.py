"""Vocabulary training: a driver loop over Spark jobs on the table of distinct words.

Each round reads one bounded result on the driver, from which it tells the next merges
(see ``merging``), or the tokens of a vocabulary whose size is a parameter. The table
of distinct words itself stays distributed; it is written again after each round.

A single merge is one string replacement on symbols that stand between ``OPEN`` and
``CLOSE``: left to right, without overlap, and never across a symbol boundary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from . import vocab
from .encoding import MAX_BROADCAST_TOKENS, viterbi_words, viterbi_words_join
from .merging import Runs, ScoredWords, apply_merges
from .runs import Merged, pair_code, pair_sums, run_sums
from .stretches import stretches

# Two code points that Unicode keeps out of text.
OPEN, CLOSE = "\ufdd0", "\ufdd1"
# Pairs looked at per round when merges that share no symbol are taken at once.
CANDIDATES = 64
# Pairs whose runs the first round of byte-pair training looks at, and symbols of runs on the driver.
FREQUENT_PAIRS = 128
MAX_SYMBOLS = 1_000_000
# Pairs whose words the first round of training by scores looks at.
SCORED_PAIRS = 256


@dataclass
class Merge:
    left: str
    right: str
    merged: str
    score: float


def _mark(symbols: Column) -> Column:
    return F.array_join(F.transform(symbols, lambda s: F.concat(F.lit(OPEN), s, F.lit(CLOSE))), "")


def _unmark(marked: Column) -> Column:
    # A split at one plain character needs no regular expression.
    return F.split(F.rtrim(F.replace(marked, F.lit(OPEN), F.lit("")), F.lit(CLOSE)), CLOSE)


def joined_token(left: str, right: str, continuation: str) -> str:
    """The merged token: the right part loses its continuation prefix."""
    return left + (right[len(continuation):] if continuation and right.startswith(continuation) else right)


def merge_marked(marked: Column, left: str, right: str, merged: str) -> Column:
    pair = f"{OPEN}{left}{CLOSE}{OPEN}{right}{CLOSE}"
    return F.replace(marked, F.lit(pair), F.lit(f"{OPEN}{merged}{CLOSE}"))


def merge_pair(splits: DataFrame, left: str, right: str, continuation: str = "") -> DataFrame:
    """Replace each adjacent (left, right) of ``syms`` by their merger."""
    merged = joined_token(left, right, continuation)
    return splits.withColumn("syms", _unmark(merge_marked(_mark(F.col("syms")), left, right, merged)))


def initial_splits(freqs: DataFrame, continuation: str = "") -> DataFrame:
    return freqs.withColumn("syms", vocab.symbols(F.col("word"), continuation))


class _Words:
    """The distinct words with their current symbols."""

    def __init__(self, freqs: DataFrame, continuation: str):
        splits = initial_splits(vocab.rank_words(freqs), continuation)
        self.table = cut_lineage(splits.select("freq", "rank", "syms"), freqs.sparkSession.sparkContext.defaultParallelism)

    def alphabet(self) -> list[str]:
        symbols = self.table.select(F.explode_outer("syms").alias("symbol")).distinct()
        return [r.symbol for r in symbols.orderBy("symbol").collect()]

    def splits(self) -> DataFrame:
        return self.table

    def apply(self, merges: list[Merge]) -> None:
        """Merges in their order, looked up in one table."""
        ranks: dict[tuple[str, str], list[int]] = {}
        for i, m in enumerate(merges):
            ranks.setdefault((m.left, m.right), []).append(i)
        shared = self.table.sparkSession.sparkContext.broadcast((ranks, [m.merged for m in merges]))

        @F.arrow_udf("array<string>")
        def merged(batch: pa.Array) -> pa.Array:
            return pa.array([apply_merges(s, *shared.value) for s in batch.to_pylist()], pa.list_(pa.string()))

        self.table = cut_lineage(self.table.withColumn("syms", merged("syms")))
        shared.destroy()


class _IdWords:
    """The distinct words of two or more symbols, as ids of their symbols (``names``, from 1 on)."""

    def __init__(self, freqs: DataFrame):
        kinds = [F.col("freq").cast("long").alias("freq"), F.col("rank").cast("long").alias("rank")]
        words = cut_lineage(vocab.rank_words(freqs).select(*kinds, "word"), freqs.sparkSession.sparkContext.defaultParallelism)

        def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = pc.unique(batch.column(0).flatten())
                missing = pa.nulls(int(batch.column(0).null_count > 0), pa.string())
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([found, missing])], ["symbol"])

        symbols = words.select(vocab.symbols(F.col("word")).alias("syms")).mapInArrow(distinct, "symbol string").distinct()
        self.alphabet = [r.symbol for r in symbols.orderBy("symbol").collect()]
        self.names = ["", *self.alphabet]
        self.ids = {s: i for i, s in enumerate(self.alphabet, 1)}
        alphabet = self.alphabet

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pa.array(alphabet, pa.string())
            for batch in batches:
                batch = batch.filter(pc.greater(pc.list_value_length(batch.column("syms")), 1))
                bounds = pc.subtract(batch.column("syms").offsets, batch.column("syms").offsets[0])
                ids = pc.add(pc.index_in(batch.column("syms").flatten(), value_set=known), pa.scalar(1, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("freq"), batch.column("rank"), pa.ListArray.from_arrays(bounds, ids)], ["freq", "rank", "syms"])

        self.schema = "freq long, rank long, syms array<int>"
        self.table = cut_lineage(words.select("freq", "rank", vocab.symbols(F.col("word")).alias("syms")).mapInArrow(numbered, self.schema))
        self.stride = 1 + (self.table.agg(F.max(F.size("syms"))).first()[0] or 0)

    def pairs(self) -> DataFrame:
        """code, freq of neighbours."""
        return self.table.mapInArrow(pair_sums, "code long, freq long").groupBy("code").agg(F.sum("freq").alias("freq"))

    def runs(self, frequent: np.ndarray) -> DataFrame:
        """syms, freq, first: the distinct runs between rare pairs, with their first place; one row each."""
        shared, stride = self.table.sparkSession.sparkContext.broadcast(frequent), self.stride
        rows = self.table.mapInArrow(lambda batches: run_sums(batches, shared.value, stride), "syms binary, freq long, first long")
        return rows.groupBy("syms").agg(F.sum("freq").alias("freq"), F.min("first").alias("first"))

    def apply(self, merges: list[Merge], frequent: np.ndarray | None, runs: pa.Array | None, done: list[list[str]]) -> None:
        """Merges in their order. ``done`` are the merged ``runs`` between pairs that are not ``frequent``, where those are known."""
        for m in merges:
            if m.merged not in self.ids:
                self.ids[m.merged] = len(self.names)
                self.names.append(m.merged)
        ranks: dict[tuple[int, int], list[int]] = {}
        for i, m in enumerate(merges):
            ranks.setdefault((self.ids[m.left], self.ids[m.right]), []).append(i)
        if frequent is None:
            frequent, runs = np.array(sorted(pair_code(*p) for p in ranks), "int64"), pa.array([], pa.binary())
        lists = pa.array([[self.ids[s] for s in run] for run in done], pa.list_(pa.int32()))
        shared = self.table.sparkSession.sparkContext.broadcast(Merged(frequent, ranks, [self.ids[m.merged] for m in merges], runs, lists))
        self.table = cut_lineage(self.table.mapInArrow(lambda batches: shared.value.words(batches), self.schema))
        shared.destroy()


def _merges_of_runs(words: _IdWords, known: set[str], limit: int, n_pairs: int, max_symbols: int):
    """(the next merges, what ``apply`` needs, how many times more symbols would fit) from the runs of about ``n_pairs`` frequent pairs; no merges if the runs are too many."""
    pairs = cut_lineage(words.pairs())
    levels = pairs.select("freq").orderBy(F.desc("freq")).limit(n_pairs + 1).collect()
    if not levels:
        return [], (None, None, []), 0
    # All pairs above the last level seen; the last level too where it is the first or nothing lies below it.
    last = levels[-1].freq
    bound = last if last == levels[0].freq or len(levels) <= n_pairs else last + 1
    frequent = pairs.filter(F.col("freq") >= bound)
    if len(levels) > n_pairs and bound == last and frequent.count() > max_symbols:
        return [], (None, None, []), 0
    codes = np.array(sorted(r.code for r in frequent.select("code").collect()), "int64")
    runs = cut_lineage(words.runs(codes))
    size = (runs.agg(F.sum(F.length("syms"))).first()[0] or 0) // 4
    if size > max_symbols:
        return [], (None, None, []), 0
    rows = runs.toArrow().combine_chunks().sort_by("first")  # max_symbols symbols at most
    runs = rows.column("syms").combine_chunks()
    symbols = [[words.names[i] for i in np.frombuffer(r, "int32")] for r in runs.to_pylist()]
    table, merges = Runs(zip(symbols, rows.column("freq").to_pylist()), bound, known), []
    while len(merges) < limit and (found := table.best()):
        pair, count = found
        merges.append(Merge(*pair, pair[0] + pair[1], float(count)))
        table.merge(pair)
    return merges, (codes, runs, table.rows()), max_symbols // max(size, 1)


def _independent_merges(words: _IdWords, known: set[str], limit: int) -> list[Merge]:
    """The next merges that share no symbol, as many as are certain after one count.

    A merge of (a, b) changes only pairs that hold a or b, and each new pair occurs
    no more often, and no earlier, than a pair that held a or b before. So the next
    best pair stands if it shares no symbol with the merges before it. This needs
    a != b and a merged token that is no symbol yet; otherwise the round ends there.
    """
    order = [F.desc("freq"), F.asc("first")]
    rows = vocab.pair_freqs(words.table).orderBy(*order).limit(CANDIDATES if limit > 1 else 1).collect()
    taken: list[Merge] = []
    used: set[str] = set()
    for row in rows[:limit]:
        left, right = words.names[row.left], words.names[row.right]
        if left in used or right in used:
            break
        merge = Merge(left, right, left + right, float(row.freq))
        taken.append(merge)
        if left == right or merge.merged in known:
            break
        used |= {left, right}
        known.add(merge.merged)
    return taken


def train_bpe(freqs: DataFrame, vocab_size: int | None = None, n_merges: int | None = None,
              specials: tuple[str, ...] = ("<|endoftext|>",), max_symbols: int = MAX_SYMBOLS) -> tuple[list[str], list[Merge]]:
    """Vocabulary and merges: the most frequent pair is merged until the size is reached or no pair is left.

    The size counts specials and alphabet; ``n_merges`` counts merges instead. A round
    merges on the runs of frequent pairs, ``max_symbols`` symbols at most on the
    driver; it takes fewer pairs where the runs are too many, and merges that share no
    symbol where even the most frequent pairs have too many. The result is that of one
    merge at a time.
    """
    words = _IdWords(freqs)
    tokens = [*specials, *words.alphabet]
    vocab_size = len(tokens) + n_merges if vocab_size is None else vocab_size
    known, merges, n_pairs = set(tokens), [], FREQUENT_PAIRS
    while len(tokens) < vocab_size:
        found, runs, room = _merges_of_runs(words, known, vocab_size - len(tokens), n_pairs, max_symbols)
        if not found:
            n_pairs = max(1, n_pairs // 8)
            found, runs = _independent_merges(words, known, vocab_size - len(tokens)), (None, None, [])
        elif room > 1:
            n_pairs *= 4 if room > 4 else 2
        if not found:
            break
        if len(tokens) + len(found) < vocab_size:
            words.apply(found, *runs)
        merges += found
        tokens += [m.merged for m in found]
    return tokens, merges


def _scored_merges(words: _Words, known: set[str], limit: int, n_pairs: int, max_symbols: int) -> tuple[list[Merge], int]:
    """(the next merges by score, symbols of the words looked at) from the words that hold one of the best ``n_pairs`` pairs."""
    adjacent = cut_lineage(vocab.adjacent_freqs(words.splits()))
    letters = {r.left: r.freq for r in adjacent.groupBy("left").agg(F.sum("freq").alias("freq")).collect()}  # the vocabulary so far
    scored = vocab.scored_pairs(adjacent).select("left", "right", "score", "first")
    best = scored.orderBy(F.desc("score"), "first").limit(n_pairs).collect()
    if not best:
        return [], 0
    best = sorted(best, key=lambda r: (-r.score, r.first))
    top = Merge(best[0].left, best[0].right, joined_token(best[0].left, best[0].right, "##"), best[0].score)
    pairs = {(r.left, r.right) for r in best}
    shared = words.table.sparkSession.sparkContext.broadcast(pairs)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(p in shared.value for p in zip(s, s[1:])) for s in batch.column(0).to_pylist()], pa.bool_()))

    held = words.splits().select("syms", F.col("freq").cast("long").alias("freq"), F.col("rank").cast("long").alias("rank"))
    held = cut_lineage(held.mapInArrow(holding, "syms array<string>, freq long, rank long"))
    symbols = cut_lineage(held.select(F.explode("syms").alias("symbol")).distinct())
    near = adjacent.filter(F.col("right").isNotNull())
    near = cut_lineage(near.join(symbols, F.col("left") == F.col("symbol"), "left_semi").union(near.join(symbols, F.col("right") == F.col("symbol"), "left_semi")).distinct())
    size = held.agg(F.coalesce(F.sum(F.size("syms")), F.lit(0))).first()[0] + near.count()
    if size > max_symbols:
        return [top] if n_pairs == 1 else [], size
    rows = sorted(held.collect(), key=lambda r: r.rank)  # max_symbols symbols and pairs at most
    table = ScoredWords([(r.syms, r.freq, r.rank) for r in rows], pairs, (-best[-1].score, best[-1].first),
                        {(r.left, r.right): (r.freq, r.first) for r in near.collect()}, letters, known, vocab.SYMBOLS)
    merges: list[Merge] = []
    while len(merges) < limit and (found := table.best()):
        (left, right), score = found
        merges.append(Merge(left, right, joined_token(left, right, "##"), score))
        table.merge((left, right), merges[-1].merged)
    return merges, size


def train_wordpiece(freqs: DataFrame, vocab_size: int | None = None, n_merges: int | None = None,
                    specials: tuple[str, ...] = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"), max_symbols: int = MAX_SYMBOLS) -> tuple[list[str], list[Merge]]:
    """Vocabulary by the pair score, as if one pair was merged at a time.

    A merge can raise other scores. A round looks at the words that hold one of the
    best pairs, at most ``max_symbols`` symbols of them on the driver, and rescores the
    pairs of their symbols; it ends when a pair may be the best that it does not know.
    """
    words = _Words(freqs, "##")
    tokens = [*specials, *words.alphabet()]
    vocab_size = len(tokens) + n_merges if vocab_size is None else vocab_size
    known, merges, n_pairs = set(tokens), [], SCORED_PAIRS
    while len(tokens) < vocab_size:
        found, size = _scored_merges(words, known, vocab_size - len(tokens), n_pairs, max_symbols)
        if not found:
            if size <= max_symbols:
                break
            n_pairs = max(1, n_pairs // 8)
            continue
        if 4 * size < max_symbols:
            n_pairs *= 2
        words.apply(found)
        merges += found
        tokens += [m.merged for m in found]
    return tokens, merges


def score_table(spark: SparkSession, scores: dict[str, float]) -> DataFrame:
    """token, neg_log_p of a trained model."""
    return spark.createDataFrame(list(scores.items()), "token string, neg_log_p double")


def unigram_losses(words: DataFrame, scores: dict[str, float]) -> DataFrame:
    """token, lost, increase: what the corpus loss gains if the token were taken away.

    Only words whose best path uses the token can change. ``lost`` counts the words
    that have no path without it. The sum is a decimal, so that it does not depend on
    the order of the rows.
    """
    plain = words.select("word", "freq")
    if len(scores) <= MAX_BROADCAST_TOKENS:
        coded = viterbi_words(plain, scores, removals=True)
    else:
        coded = viterbi_words_join(plain, cut_lineage(score_table(words.sparkSession, scores)), removals=True)
    drops = coded.select("freq", "score", F.explode("without").alias("w"))
    change = (F.col("freq") * (F.col("w.score") - F.col("score"))).cast("decimal(38,10)")
    return drops.groupBy(F.col("w.token").alias("token")).agg(
        F.count_if(F.col("w.score").isNull()).alias("lost"), F.sum(change).alias("increase"))


def train_unigram(freqs: DataFrame, vocab_size: int = 100, seed_size: int = 300, drop_share: float = 0.1) -> dict[str, float]:
    """token -> -log p: prune the tokens of least loss increase until the size is reached.

    The loop holds the vocabulary, whose size is bounded by ``seed_size`` and the
    alphabet. Frequencies stay fixed; single characters are never pruned, so each round
    needs only the distinct stretches of the words of the round before (see ``stretches``).
    """
    cores = freqs.sparkSession.sparkContext.defaultParallelism
    words = cut_lineage(vocab.rank_words(freqs), cores)
    seed = vocab.subword_topn(words, seed_size).collect()
    chars = sorted((r for r in seed if len(r.token) == 1), key=lambda r: r.first)
    rest = sorted((r for r in seed if len(r.token) > 1), key=lambda r: (-r.freq, r.first, len(r.token)))
    token_freqs = {r.token: r.freq for r in [*chars, *rest]}
    while len(token_freqs) > vocab_size:
        scores = _scores(token_freqs)
        if len(scores) <= MAX_BROADCAST_TOKENS:
            words = cut_lineage(stretches(words, scores), cores)
        grown = {r.token: (r.lost, r.increase or 0) for r in unigram_losses(words, scores).collect()}
        prunable = sorted((t for t in token_freqs if len(t) > 1), key=lambda t: grown.get(t, (0, 0)))
        dropped = prunable[: int(len(token_freqs) * drop_share)]
        if not dropped:
            break
        for token in dropped:
            del token_freqs[token]
    return _scores(token_freqs)


def _scores(token_freqs: dict[str, int]) -> dict[str, float]:
    total = sum(token_freqs.values())
    return {t: -math.log(f / total) for t, f in token_freqs.items()}


def corpus_loss(coded: DataFrame) -> DataFrame:
    """One row: word losses weighted by frequency."""
    return coded.agg(F.sum(F.col("freq") * F.col("score")).alias("loss"))


def vocab_table(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """token, id in vocabulary order."""
    return spark.createDataFrame(list(zip(tokens, range(len(tokens)))), "token string, id int")


def merge_table(spark: SparkSession, merges: list[Merge]) -> DataFrame:
    """rank, left, right, merged, score."""
    rows = [(i, m.left, m.right, m.merged, float(m.score)) for i, m in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string, merged string, score double")


def save_vocab(table: DataFrame, path: str) -> None:
    table.write.mode("errorifexists").parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
