"""Hard negatives of anchors by inner product, with length buckets and coordinate pruning.

Rows are dealt by range of length, the longest first, and each task cuts its rows into buckets. A bucket holds, for
each coordinate of the unit vectors, the list of its rows sorted by that coordinate. For an anchor and the least score
that still matters, the longest row of a bucket gives the least cosine a row must have; that cosine and the anchor's
focus coordinates (its largest ones) give a feasible range of each of these coordinates. The rows in all ranges are
the candidates, and only their inner products are computed, as exact integers.

The least score rises while a task reads its rows: for positives it is the last of the best so far, for negatives the
lower bound of the range asked for, or the last of the best in it. Anchors go to the tasks in rounds of at most
``ROUND_VALUES`` vector components; each round scans the rows in place. Only the best of each anchor leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut_lineage
from .common import partitions

BUCKET_VALUES = 1 << 17
FOCUS = 3
ROUND_VALUES = 4_000_000
SLACK = 1e-9  # of unit coordinates and cosines, far above their rounding
_NONE = np.iinfo(np.int64).min


def finite_rows(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label and ``vec``, each component floor(scale * x), of the rows without a null or a value that is not finite."""
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    rows = df.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & sound)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec"))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` components; shorter vectors end in zeros."""
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(lists), dims)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def _unit(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return rows / np.where(lengths == 0, 1, lengths)[:, None]


class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows, lengths = ids, labels, rows, _lengths(rows)
        self.longest = float(lengths.max())
        unit = _unit(rows, lengths)
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, axis=0)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(ids))[:, None], axis=0)

    def ranges(self, anchors: Anchors, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(alive, low, high): anchors that a row may satisfy, and their feasible places in each focus list."""
        reach = anchors.lengths * self.longest * (1 + SLACK)
        alive = reach >= least
        cosine = np.clip(np.divide(least, reach, out=np.zeros(len(least)), where=reach > 0) - SLACK, -1, 1)
        cosine[least <= 0] = -1  # a short row may then have any cosine
        near, own = np.arccos(cosine)[:, None], np.arccos(np.clip(np.take_along_axis(anchors.unit, anchors.focus, axis=1), -1, 1))
        bottom, top = np.cos(np.minimum(own + near, np.pi)) - SLACK, np.cos(np.maximum(own - near, 0)) + SLACK
        low, high = np.zeros(anchors.focus.shape, np.int64), np.full(anchors.focus.shape, len(self.ids))
        for f in np.unique(anchors.focus):
            at = anchors.focus == f
            low[at] = np.searchsorted(self.sorted[:, f], bottom[at], "left")
            high[at] = np.searchsorted(self.sorted[:, f], top[at], "right")
        return alive, low, high

    def candidates(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the rows in all ranges, from the shortest range on."""
        first, *rest = np.argsort(high - low)
        rows = self.order[low[first]:high[first], focus[first]]
        for k in rest:
            places = self.place[rows, focus[k]]
            rows = rows[(places >= low[k]) & (places < high[k])]
        return rows

    def scores(self, rows: np.ndarray, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products: in doubles where no partial sum can leave their integers, in 64-bit integers below 2^62."""
        reach = length * self.longest
        if reach < 2.0 ** 52:
            return (self.rows[rows].astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        if reach >= 2.0 ** 62:
            raise ValueError("an inner product does not fit a long")
        return self.rows[rows] @ anchor


class Anchors:
    """One round of anchors, with (id, score) of the positives of each once they are known."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, positives: list[list[tuple[int, int]]] | None = None):
        self.ids, self.labels, self.rows, self.positives = ids, labels, rows, positives
        self.lengths = _lengths(rows)
        self.unit = _unit(rows, self.lengths)
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :min(FOCUS, rows.shape[1])]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by descending score, ties by smaller id."""
    first = np.lexsort((ids, -scores))[:k]
    return ids[first], scores[first]


def _buckets(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Bucket]:
    size = max(1, BUCKET_VALUES // max(1, dims))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield Bucket(part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2), dims))


def _search(bucket: Bucket, anchors: Anchors, least: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, ids, scores) of the rows of the same (or another) label that reach the anchor's least score."""
    alive, low, high = bucket.ranges(anchors, least)
    for a in np.flatnonzero(alive):
        rows = bucket.candidates(anchors.focus[a], low[a], high[a]) if anchors.focus.shape[1] else np.arange(len(bucket.ids))
        rows = rows[((bucket.labels[rows] == anchors.labels[a]) == same) & (bucket.ids[rows] != anchors.ids[a])]
        if len(rows):
            scores = bucket.scores(rows, anchors.rows[a], anchors.lengths[a])
            fit = scores >= least[a]
            if fit.any():
                yield a, bucket.ids[rows[fit]], scores[fit]


def _table(columns: dict[str, np.ndarray | list[np.ndarray]]) -> pa.RecordBatch:
    flat = [np.concatenate(c) if isinstance(c, list) else c for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in flat], list(columns))


def _positives(batches: Iterator[pa.RecordBatch], anchors: Anchors, dims: int, k: int) -> Iterator[pa.RecordBatch]:
    least, best = np.full(len(anchors.ids), _NONE), {}
    for bucket in _buckets(batches, dims):
        for a, ids, scores in _search(bucket, anchors, least, True):
            if a in best:
                ids, scores = np.concatenate([best[a][0], ids]), np.concatenate([best[a][1], scores])
            best[a] = _best(ids, scores, k)
            if len(best[a][0]) == k:
                least[a] = best[a][1][-1]
    if best:
        yield _table({"anchor": np.repeat(list(best), [len(i) for i, _ in best.values()]), "id": [i for i, _ in best.values()], "score": [s for _, s in best.values()]})


def _negatives(batches: Iterator[pa.RecordBatch], anchors: Anchors, dims: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    def bound(score: int) -> tuple[int, int]:
        return -(-low * score // 100), high * score // 100  # of Python integers, as 100 times a score may not fit a long

    bounds = [sorted({bound(s) for _, s in found if bound(s)[0] <= bound(s)[1]}) for found in anchors.positives]
    best: dict[tuple[int, tuple[int, int]], tuple[np.ndarray, np.ndarray]] = {}
    least = np.array([min((b[0] for b in found), default=np.iinfo(np.int64).max) for found in bounds], np.int64)
    for bucket in _buckets(batches, dims):
        for a, ids, scores in _search(bucket, anchors, least, False):
            needed = []
            for b in bounds[a]:
                old = best.get((a, b))
                fit = (scores >= b[0]) & (scores <= b[1])
                if fit.any():
                    more = (ids[fit], scores[fit]) if old is None else (np.concatenate([old[0], ids[fit]]), np.concatenate([old[1], scores[fit]]))
                    best[a, b] = old = _best(*more, k)
                needed.append(int(old[1][-1]) if old is not None and len(old[0]) == k else b[0])
            least[a] = min(needed)
    rows = [(a, place, positive, score, *best[a, bound(score)]) for a, found in enumerate(anchors.positives)
            for place, (positive, score) in enumerate(found) if (a, bound(score)) in best]
    if rows:
        n = [len(r[4]) for r in rows]
        a = np.repeat([r[0] for r in rows], n)
        yield _table({"anchor": a, "place": np.repeat([r[1] for r in rows], n), "anchor_id": anchors.ids[a], "positive_id": np.repeat([r[2] for r in rows], n),
                      "positive_score": np.repeat([r[3] for r in rows], n), "negative_id": [r[4] for r in rows], "negative_score": [r[5] for r in rows]})


def mine_hard_negatives(df: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                        round_values: int = ROUND_VALUES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``df`` holds vec_id, label and ``vec`` (integers), none of them null; ``is_anchor`` is a condition on these. The
    score is the inner product; shorter vectors end in zeros, and an empty one scores 0. An anchor's positives are its
    first ``n_positives`` rows of the same label, its negatives for each positive the first ``n_negatives`` rows of
    other labels with low * positive <= 100 * negative <= high * positive; higher scores come first, ties by smaller
    id. Rows with the anchor's own id are never its partners; other repeated rows are rows of their own. Each anchor
    row is mined by itself. A score beyond 62 bits raises an error. No rows or no anchors give an empty table.
    """
    spark = df.sparkSession
    rows = df.select("vec_id", "label", "vec", F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("sq"))
    rows = rows.repartitionByRange(partitions(spark), F.desc("sq"), "vec_id").sortWithinPartitions(F.desc("sq"), "vec_id")
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    dims, n_anchors = rows.agg(F.max(F.size("vec")), F.count_if(is_anchor)).first()
    n_rounds = math.ceil(n_anchors * max(1, dims or 0) / round_values)
    vectors, parts = rows.select("vec_id", "label", "vec"), []
    for turn in range(n_rounds):
        picked = rows.filter(is_anchor).filter(F.pmod(F.xxhash64("row"), F.lit(n_rounds)) == turn).select(*vectors.columns).toArrow()  # about round_values components
        if not picked.num_rows:
            continue
        held = picked.combine_chunks()
        own = [held.column(0).to_numpy(), held.column(1).to_numpy(), _matrix(held.column(2).combine_chunks(), dims)]
        shared = spark.sparkContext.broadcast(own)
        near = vectors.mapInArrow(lambda batches: _positives(batches, Anchors(*shared.value), dims, n_positives), "anchor long, id long, score long")
        first = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
        near = near.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= n_positives)
        found: list[list[tuple[int, int]]] = [[] for _ in own[0]]
        for r in near.orderBy("anchor", "n").collect():  # n_positives rows an anchor of the round
            found[r.anchor].append((r.id, r.score))
        shared.destroy()
        shared = spark.sparkContext.broadcast([*own, found])
        hard = vectors.mapInArrow(lambda batches: _negatives(batches, Anchors(*shared.value), dims, n_negatives, low, high),
                                  "anchor long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        parts.append(cut_lineage(hard.withColumn("turn", F.lit(turn))))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    best = W.partitionBy("turn", "anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
