"""Exact nearest neighbours; with many queries an all-pairs product in blocks.

Vectors are compared inside tasks as matrices; only the k best of each query leave
a task. ``l2`` is the squared distance and ascends, ``dot`` and ``cosine`` descend.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

# Queries that are sent to every task at once, and their largest total size.
MAX_QUERIES = 4096
MAX_QUERY_VALUES = 16_000_000
# Rows of a block: two of them as matrices, and 1024 rows of their product, in a task.
MAX_BLOCK_ROWS = 20_000
RESULT = "query_id bigint, vec_id bigint, score double"


def _matrix(vectors: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(vectors, pa.Array):
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
        return flat.reshape(len(vectors), -1)
    return np.stack(vectors.to_numpy()).astype("float64")


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; a zero vector stays zero, so that its similarity is 0."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def _scores(queries: np.ndarray, base: np.ndarray, metric: str) -> np.ndarray:
    """Similarity matrix (queries x base), larger is nearer."""
    if metric == "cosine":
        queries, base = _unit(queries), _unit(base)
    dots = queries @ base.T
    if metric == "l2":
        return -(np.sum(queries**2, axis=1)[:, None] + np.sum(base**2, axis=1)[None, :] - 2 * dots)
    return dots


def _local_best(qids: np.ndarray, ids: np.ndarray, near: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k best per query of one block, ties by id."""
    near = np.round(near, 9)
    if exclude_self:
        near[qids[:, None] == ids[None, :]] = -np.inf
    n = len(ids)
    cut = np.partition(near, n - min(k, n), axis=1)[:, n - min(k, n)]
    rows, cols = np.nonzero((near >= cut[:, None]) & np.isfinite(near))
    return _first_k(pd.DataFrame({"query_id": qids[rows], "vec_id": ids[cols], "score": near[rows, cols]}), k)


def _first_k(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ranked = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return ranked[ranked.groupby("query_id").cumcount() < k]


def _global_best(found: DataFrame, k: int, metric: str) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    sign = -1 if metric == "l2" else 1
    return ranked.withColumn("score", F.col("score") * sign)


def knn_exact(base: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2", exclude_self: bool = False) -> DataFrame:
    """query_id, vec_id, score, rank for ``base(vec_id, embedding)`` and ``queries(query_id, embedding)``.

    Up to MAX_QUERIES queries go to every task and the base is scanned once, in place.
    A larger query table takes the blocked form.
    """
    head = queries.select("query_id", "embedding").limit(MAX_QUERIES + 1).toPandas()
    if len(head) == 0:
        return base.sparkSession.createDataFrame([], RESULT + ", rank int")
    if len(head) > MAX_QUERIES or len(head) * len(head["embedding"].iloc[0]) > MAX_QUERY_VALUES:
        return knn_blocked(base, queries, k, metric, exclude_self)
    context = base.sparkSession.sparkContext
    shared = context.broadcast((head["query_id"].to_numpy(), _matrix(head["embedding"])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, matrix = shared.value
        best = None
        for batch in batches:
            if batch.num_rows:
                near = _scores(matrix, _matrix(batch.column(1)), metric)
                found = _local_best(qids, batch.column(0).to_numpy(), near, k, exclude_self)
                best = found if best is None else _first_k(pd.concat([best, found]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    found = base.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(search, RESULT)
    return _global_best(found, k, metric)


def knn_blocked(base: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2", exclude_self: bool = False,
                block_rows: int = MAX_BLOCK_ROWS) -> DataFrame:
    """The same for any number of queries.

    Both sides are cut into hash blocks and each pair of blocks meets in one task as two
    matrices. A side is copied once per block of the other, and a pair of blocks sends
    on k rows per query. Blocks have ``block_rows`` or, once the pairs of blocks are four
    to a core, up to MAX_BLOCK_ROWS, so that copies do not grow with every few rows.
    """
    enough = 2 * math.ceil(math.sqrt(base.sparkSession.sparkContext.defaultParallelism))

    def blocks(df: DataFrame) -> int:
        n = df.count()
        return max(1, -(-n // MAX_BLOCK_ROWS), min(enough, -(-n // block_rows)))

    n_base, n_query = blocks(base), blocks(queries)

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("query_id", "embedding", block("query_id", n_query).alias("qb"), every(n_base).alias("bb"))
    right = base.select(F.col("vec_id").cast("bigint"), "embedding", block("vec_id", n_base).alias("bb"), every(n_query).alias("qb"))

    def search(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        parts = []
        for at in range(0, len(q), 1024):
            part = q.iloc[at:at + 1024]
            near = _scores(_matrix(part["embedding"]), _matrix(b["embedding"]), metric)
            parts.append(_local_best(part["query_id"].to_numpy(), b["vec_id"].to_numpy(), near, k, exclude_self))
        return pd.concat(parts)

    found = left.groupBy("qb", "bb").cogroup(right.groupBy("qb", "bb")).applyInPandas(search, RESULT)
    return _global_best(found, k, metric)
