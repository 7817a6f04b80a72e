"""Corpus metrics as aggregate queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType

from ..functions.arrays import ngrams
from ..functions.once import compute_once
from ..functions.pretok import pretok_bert
from ..functions.scalars import IGNORE_LABEL, ColumnOrName, _col
from ..functions.text import WHITESPACE, sent_split, strip

# What answer normalisation takes out.
ASCII_PUNCTUATION = r"[!-/:-@\[-\x60{-~]"
ARTICLES = r"(?<![\p{L}\p{N}_])(a|an|the)(?![\p{L}\p{N}_])"


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def accuracy_f1(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """One row: accuracy, and F1 of class 1. A null prediction or label is wrong in both."""
    p, y = F.col(prediction), F.col(label)
    tp = F.count_if((p == 1) & (y == 1))
    return df.agg(F.avg(F.coalesce(p == y, F.lit(False)).cast("int")).alias("accuracy"),
                  _ratio(2.0 * tp, (F.count_if(p == 1) + F.count_if(y == 1))).alias("f1"))


def _kept(tags: str, labels: str) -> Column:
    pairs = F.filter(F.arrays_zip(F.col(tags).alias("t"), F.col(labels).alias("l")), lambda z: z["l"] != str(IGNORE_LABEL))
    return F.transform(pairs, lambda z: z["t"])


def drop_ignored(df: DataFrame, predictions: str, labels: str) -> DataFrame:
    """Remove the positions whose label is the ignored value (as text) from both tag arrays."""
    return df.withColumns({predictions: _kept(predictions, labels), labels: _kept(labels, labels)})


COUNTS = ("pred", "true", "tp", "n", "same")


def _spans(types: np.ndarray, begins: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, last places) of the spans of ``entity_spans``; type -1 is outside."""
    inside = types >= 0
    same = row[1:] == row[:-1]
    first = inside.copy()
    first[1:] &= begins[1:] | ~(same & (types[1:] == types[:-1]))
    last = inside.copy()
    last[:-1] &= ~same | ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last)


class _Tags:
    """Tags by number, with the number of their type (-1 outside) and whether they are B- tags; a missing tag is -1, outside."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.types: dict[str, int] = {}

    def numbered(self, tags: pa.Array) -> np.ndarray:
        coded = tags.dictionary_encode()
        known = np.array([*(self.ids.setdefault(t, len(self.ids)) for t in coded.dictionary.to_pylist()), -1], "int32")
        return known[coded.indices.fill_null(-1).to_numpy()]

    def typed(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        types = np.array([*(-1 if t == "O" else self.types.setdefault(t[2:], len(self.types)) for t in self.ids), -1], "int32")
        return types[numbers], np.array([*(t.startswith("B-") for t in self.ids), False], bool)[numbers]


# Tags looked at together; a longer row stands alone.
TAGS_AT_ONCE = 100_000


def _slices(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about TAGS_AT_ONCE labels."""
    start, ends = 0, rows.column(1).offsets.to_numpy()
    while start < rows.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + TAGS_AT_ONCE, side="right")) - 1)
        yield rows.slice(start, end - start)
        start = end


def _span_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per type and ``overall`` of a batch of (predictions, labels); a row without one of them has no type and no counts."""
    for batch in batches:
        present = pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid())
        rows = batch if batch.num_rows == (pc.sum(present).as_py() or 0) else batch.filter(present)
        out = [] if rows.num_rows == batch.num_rows else [(None,) * 6]
        if rows.num_rows:
            tags, whole, typed = _Tags(), np.zeros(5, "int64"), np.zeros((3, 0), "int64")
            for part in _slices(rows):
                said, true = part.column(0), part.column(1)
                sizes = np.diff(true.offsets.to_numpy())
                if (np.diff(said.offsets.to_numpy()) != sizes).any():  # labels decide the length
                    said = pa.array([(p + [None] * n)[:n] for p, n in zip(said.to_pylist(), sizes)], pa.list_(pa.string()))
                p, y, row = tags.numbered(said.flatten()), tags.numbered(true.flatten()), np.repeat(np.arange(len(sizes), dtype="int32"), sizes)
                kept = (y >= 0) & (y != tags.ids.get(str(IGNORE_LABEL), -1))
                if not kept.all():
                    p, y, row = p[kept], y[kept], row[kept]
                (p_type, p_begins), (y_type, y_begins) = tags.typed(p), tags.typed(y)
                (p_first, p_last), (y_first, y_last) = _spans(p_type, p_begins, row), _spans(y_type, y_begins, row)
                ends = np.full(len(row), -1)
                ends[p_first] = p_last
                found = y_first[(ends[y_first] == y_last) & (p_type[y_first] == y_type[y_first])]
                typed = np.pad(typed, ((0, 0), (0, len(tags.types) - typed.shape[1])))
                typed += [np.bincount(t, minlength=len(tags.types)) for t in (p_type[p_first], y_type[y_first], y_type[found])]
                whole += (len(p_first), len(y_first), len(found), len(row), int(np.count_nonzero(p == y)))
            # A tag that is left and not outside is part of a span, so other types are those of ignored positions.
            out += [(name, *typed[:, i].tolist(), 0, 0) for name, i in tags.types.items() if typed[:2, i].any()]
            out.append(("overall", *whole.tolist()))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["type", *COUNTS])


def seqeval(df: DataFrame, predictions: str, labels: str) -> DataFrame:
    """type, precision, recall, f1, number, accuracy: per entity type, and ``overall``.

    Positions with an ignored or missing label are left out. Spans and their matches are
    found inside each row, over the flat buffers of a batch; only counts per type leave it.
    """
    tags = df.select(F.col(predictions).cast("array<string>"), F.col(labels).cast("array<string>"))
    counts = tags.mapInArrow(_span_counts, "type string, " + ", ".join(f"{c} long" for c in COUNTS))
    sums = counts.groupBy("type").agg(*[F.sum(c).alias(c) for c in COUNTS])
    precision, recall = _ratio(F.col("tp"), F.col("pred")), _ratio(F.col("tp"), F.col("true"))
    return sums.select(
        "type", precision.alias("precision"), recall.alias("recall"),
        _ratio(2.0 * F.col("tp"), F.col("pred") + F.col("true")).alias("f1"), F.col("true").alias("number"),
        F.when(F.col("type") == "overall", _ratio(F.col("same"), F.col("n"))).alias("accuracy"))


def overlap_counts(df: DataFrame, key: str, pred_tokens: str, ref_tokens: str, orders: list[int]) -> DataFrame:
    """key, n, pred, ref, hit: n-gram counts of both sides and their clipped overlap.

    The overlap is found inside the row: the grams of both sides are sorted together, predictions first among
    equals, and one pass over them keeps how many predicted ones are still free. Every row gives one row per order,
    also without a gram; null tokens count as none.
    """
    def grams(tokens: str, n: int) -> Column:
        return F.coalesce(ngrams(tokens, n), F.array().cast("array<string>"))

    def tagged(side: str, mark: int) -> Column:
        return F.transform(side, lambda g: F.struct(g.alias("gram"), F.lit(mark).alias("side")))

    def add(state: Column, e: Column) -> Column:
        same = e["gram"].eqNullSafe(state["gram"])
        free = F.when(same, state["free"]).otherwise(0)
        taken = ((e["side"] == 1) & (free > 0)).cast("int")
        return F.struct(e["gram"].alias("gram"), F.when(e["side"] == 0, free + 1).otherwise(free - taken).alias("free"), (state["hit"] + taken).alias("hit"))

    once = compute_once(df.select(key, pred_tokens, ref_tokens), pred_tokens, ref_tokens)
    sides = once.select(key, F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), grams(pred_tokens, n).alias("p"), grams(ref_tokens, n).alias("r")) for n in orders])).alias("g")).select(key, "g.*")
    start = F.struct(F.lit(None).cast("string").alias("gram"), F.lit(0).alias("free"), F.lit(0).alias("hit"))
    hit = F.aggregate(F.sort_array(F.concat(tagged("p", 0), tagged("r", 1))), start, add)["hit"]
    return sides.select(key, "n", F.size("p").alias("pred"), F.size("r").alias("ref"), hit.alias("hit"))


def bleu(df: DataFrame, key: str, prediction: str, reference: str, max_n: int = 4) -> DataFrame:
    """One row: corpus BLEU, brevity penalty and both lengths; one reference per prediction.

    Tokens are stripped texts with punctuation isolated. The i-th order without a match
    gets the precision 1 / (2^i * total).
    """
    tokens = df.select(key, pretok_bert(strip(prediction)).alias("p"), pretok_bert(strip(reference)).alias("r"))
    orders = list(range(1, max_n + 1))
    counts = overlap_counts(tokens, key, "p", "r", orders)
    row = counts.agg(*[F.coalesce(F.sum(F.when(F.col("n") == n, F.col(c))), F.lit(0)).alias(f"{c}{n}")
                       for n in orders for c in ("hit", "pred", "ref")])
    pred_len, ref_len = F.col("pred1"), F.col("ref1")
    logs, misses = F.lit(0.0), F.lit(0)
    for n in orders:
        hit, total = F.col(f"hit{n}"), F.col(f"pred{n}")
        misses = misses + (hit == 0).cast("int")
        precision = F.when(hit == 0, 1.0 / (F.pow(F.lit(2.0), misses) * total)).otherwise(hit / total)
        logs = logs + F.when(total > 0, F.log(precision))
    brevity = F.when(pred_len >= ref_len, 1.0).when(pred_len > 0, F.exp(1 - ref_len / pred_len)).otherwise(0.0)
    # Without a single prediction of max_n tokens there is no precision of that order: score 0.
    score = F.coalesce(100 * brevity * F.exp(logs / max_n), F.lit(0.0))
    return row.select(score.alias("bleu"), brevity.alias("brevity"), pred_len.alias("pred_len"), ref_len.alias("ref_len"))


def rouge_tokens(text: ColumnOrName, ascii_only: bool = True) -> Column:
    """Lower-cased runs of letters and digits; outside ASCII they count unless ``ascii_only``."""
    keep = "[a-z0-9]++" if ascii_only else r"[\p{L}\p{M}\p{N}]++"
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(keep), F.lit(0))


def _prf(hit: Column, pred: Column, ref: Column) -> dict[str, Column]:
    p, r = _ratio(hit, pred), _ratio(hit, ref)
    return {"precision": p, "recall": r, "fmeasure": _ratio(2.0 * hit, pred + ref)}


def rouge_n_rows(df: DataFrame, key: str, prediction: str, reference: str, orders: list[int], ascii_only: bool = True) -> DataFrame:
    """key, n, precision, recall, fmeasure for every pair, also for pairs without n-grams."""
    tokens = df.select(key, rouge_tokens(prediction, ascii_only).alias("p"), rouge_tokens(reference, ascii_only).alias("r"))
    counts = overlap_counts(tokens, key, "p", "r", orders)
    scores = _prf(F.col("hit"), F.col("pred"), F.col("ref"))
    return counts.select(key, "n", *[c.alias(name) for name, c in scores.items()])


def rouge_n(df: DataFrame, key: str, prediction: str, reference: str, orders: list[int] | None = None,
            ascii_only: bool = True) -> DataFrame:
    """n, precision, recall, fmeasure: means over all pairs."""
    rows = rouge_n_rows(df, key, prediction, reference, orders or [1, 2], ascii_only)
    return rows.groupBy("n").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "fmeasure")])


def _match_bits(a: list, b: list) -> int:
    """Positions of ``a`` on one longest common subsequence with ``b``: set bits of the result are free.

    Bit-parallel: one big-integer step per element of ``b``.
    """
    where: dict = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        hits = row & where.get(token, 0)
        row = ((row + hits) | (row - hits)) & full
    return row


def lcs_length(a: list, b: list) -> int:
    return len(a) - _match_bits(a, b).bit_count()


@F.arrow_udf(IntegerType())
def _lcs(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([lcs_length(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


def lcs_positions(ref: np.ndarray, pred: np.ndarray) -> set[int]:
    """Positions in ``ref`` of one longest common subsequence with ``pred``.

    Of the table of lengths one number per row is kept: bit j is free where its row does not grow at j. That is a bit
    a cell, 50 MB for two lines of 20,000 words; lengths that the way back asks for are counted from the bits.
    """
    ref, pred = ref.tolist(), pred.tolist()
    where: dict = {}
    for j, token in enumerate(pred):
        where[token] = where.get(token, 0) | (1 << j)
    full = (1 << len(pred)) - 1
    rows = [full]
    for token in ref:
        row = rows[-1]
        hits = row & where.get(token, 0)
        rows.append(((row + hits) | (row - hits)) & full if hits else row)
    found, i, j = set(), len(ref), len(pred)
    while i and j:
        if ref[i - 1] == pred[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
            continue
        row, above, below = rows[i], rows[i - 1], (1 << j) - 1
        # Left only if the row does not grow here, and the row above has less.
        if row >> (j - 1) & 1 and row is not above and (row & below).bit_count() < (above & below).bit_count():
            j -= 1
        else:
            i -= 1
    return found


def union_lcs_hits(pred: list[list], ref: list[list]) -> int:
    """Clipped size of the union, per reference sentence, of its subsequences with all predicted sentences."""
    codes: dict = {}
    pred, ref = ([np.array([codes.setdefault(t, len(codes)) for t in s], dtype="int64") for s in side] for side in (pred, ref))
    left = [np.bincount(np.concatenate([np.empty(0, "int64"), *side]), minlength=len(codes)) for side in (pred, ref)]
    hits = 0
    for sentence in ref:
        shared = [p for p in pred if np.isin(sentence, p).any()]
        for i in sorted(set().union(*[lcs_positions(sentence, p) for p in shared])):
            token = sentence[i]
            if left[0][token] > 0 and left[1][token] > 0:
                hits += 1
                left[0][token] -= 1
                left[1][token] -= 1
    return hits


@F.arrow_udf(IntegerType())
def _lcs_sum(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([union_lcs_hits(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


def rouge_l_rows(df: DataFrame, key: str, prediction: str, reference: str, ascii_only: bool = True) -> DataFrame:
    """key, precision, recall, fmeasure by the longest common subsequence of whole texts."""
    tokens = df.select(key, rouge_tokens(prediction, ascii_only).alias("p"), rouge_tokens(reference, ascii_only).alias("r"))
    hits = tokens.withColumn("hit", _lcs("p", "r"))
    return hits.select(key, *[c.alias(n) for n, c in _prf(F.col("hit"), F.size("p"), F.size("r")).items()])


def rouge_lsum_rows(df: DataFrame, key: str, prediction: str, reference: str, ascii_only: bool = True) -> DataFrame:
    """The same with texts split at newlines and the union of subsequences per sentence."""
    def lines(text: str) -> Column:
        return F.transform(F.filter(F.split(text, "\n"), lambda s: s != ""), lambda s: rouge_tokens(s, ascii_only))

    tokens = df.select(key, lines(prediction).alias("p"), lines(reference).alias("r"))
    hits = tokens.withColumn("hit", _lcs_sum("p", "r"))
    return hits.select(key, *[c.alias(n) for n, c in _prf(
        F.col("hit"), F.size(F.flatten("p")), F.size(F.flatten("r"))).items()])


def mean_scores(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "fmeasure")])


def by_sentence(text: str) -> Column:
    """One sentence per line, as the summary metrics expect."""
    return F.array_join(sent_split(text), "\n")


def squad_normalize(text: ColumnOrName) -> Column:
    """Lower-case, drop ASCII punctuation and articles, squeeze white space."""
    bare = F.regexp_replace(F.lower(_col(text)), ASCII_PUNCTUATION, "")
    return strip(F.regexp_replace(F.regexp_replace(bare, ARTICLES, " "), WHITESPACE + "+", " "))


def squad_em_f1(df: DataFrame, key: str, prediction: str, references: str) -> DataFrame:
    """One row: mean exact match and mean token F1 in percent, each the best over an array of references.

    Every example counts: a null prediction is an empty answer, and without references both scores are 0.
    """
    given = F.coalesce(squad_normalize(prediction), F.lit(""))
    pairs = df.select(key, given.alias("p"), F.posexplode_outer(references).alias("ref_no", "ref"))
    pairs = pairs.withColumn("r", squad_normalize("ref")).withColumn("pair", F.struct(
        F.col(key).alias("id"), "ref_no", F.coalesce(F.col("p") == F.col("r"), F.lit(False)).cast("int").alias("em"))).select(
        "pair", F.filter(F.split("p", " "), lambda w: w != "").alias("pt"),
        F.filter(F.split(F.coalesce("r", F.lit("")), " "), lambda w: w != "").alias("rt"))
    counts = overlap_counts(pairs, "pair", "pt", "rt", [1]).withColumn(
        "f1", _ratio(2.0 * F.col("hit"), F.col("pred") + F.col("ref"))).select("pair", "f1")
    best = counts.groupBy("pair.id").agg(F.max("pair.em").alias("em"), F.max("f1").alias("f1"))
    return best.agg((F.avg("em") * 100).alias("exact_match"), (F.avg("f1") * 100).alias("f1"))
