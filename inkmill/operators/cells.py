"""Exact nearest neighbours through an inverted index of cells.

Every base row lies in the cell of its nearest centre, and a cell knows how near and how far from the centre its rows
are. By the triangle inequality no row of a cell can be nearer to a query than ``distance to the centre - farthest``
or ``nearest - distance to the centre``. A query is first compared with its nearest cells that hold k rows; the k-th
distance found there rules out all cells whose bound is larger, and only the others are visited. Centres, and so the
number of cells, decide how much is skipped and never what is found: without any structure in the vectors all cells
are visited. So other cells are visited by shelves, blocks of cells: a query goes to a shelf once, with a bit for each
of its cells, and meets the shelf as a matrix; only rows within its k-th distance are looked at one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from ..session import cut_lineage
from .knn import RESULT, _first_k, _global_best, _local_best, _matrix, _scores

MAX_CELLS = 4096
MAX_CENTRE_VALUES = 16_000_000  # numbers in all centres together, which go to every task
BLOCK = 20_000  # rows of a cell, and of its visitors, that meet in one group
AT_ONCE = 1024


@dataclass(frozen=True)
class Cells:
    """An index: ``rows`` (vec_id, embedding, cell, radius), the centres, and per cell its rows and radii."""

    rows: DataFrame
    centres: np.ndarray
    counts: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(-_scores(vectors, centres, "l2"), 0))


def build_cells(base: DataFrame, n_cells: int | None = None) -> Cells:
    """The index of ``base(vec_id, embedding)``, written to the scratch folder; null and not finite vectors are left out, as nothing finds them.

    Centres are the rows with the smallest hash of the id: about the root of the number of rows, MAX_CELLS at most.
    """
    base = base.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter("embedding IS NOT NULL")
    total, width = base.agg(F.count("*"), F.max(F.size("embedding"))).first()
    n_cells = min(n_cells or round(total**0.5), MAX_CELLS, MAX_CENTRE_VALUES // max(width or 0, 1))
    chosen = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(n_cells, 1)).toPandas()  # bounded by both constants
    centres = _matrix(chosen["embedding"]) if total else np.zeros((0, 0))
    if len(centres):  # a vector with a missing or infinite number has no distance
        centres = centres[np.isfinite(centres).all(axis=1)] if np.isfinite(centres).all(axis=1).any() else np.zeros((1, centres.shape[1]))
    shared = base.sparkSession.sparkContext.broadcast(centres)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                away = _distances(_matrix(part.column(1)), shared.value)
                cell = away.argmin(axis=1)
                radius = away[np.arange(len(cell)), cell]
                rows = pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell, pa.int32()), pa.array(radius)], [*part.schema.names, "cell", "radius"])
                yield rows.filter(pa.array(np.isfinite(radius)))

    schema = StructType([*base.schema.fields, StructField("cell", IntegerType()), StructField("radius", DoubleType())])
    rows = cut_lineage(base.mapInArrow(place, schema))
    n = len(centres)
    counts, nearest, farthest = np.zeros(n, "int64"), np.zeros(n), np.zeros(n)
    for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("radius").alias("lo"), F.max("radius").alias("hi")).collect():
        counts[r.cell], nearest[r.cell], farthest[r.cell] = r.n, r.lo, r.hi
    return Cells(rows, centres, counts, nearest, farthest)


def _home(away: np.ndarray, counts: np.ndarray, need: int) -> np.ndarray:
    """Cells in the order of their centres until they hold ``need`` rows, as a mask."""
    order = np.argsort(away, axis=1, kind="stable")
    held = np.cumsum(counts[order], axis=1)
    wanted = np.concatenate([np.ones((len(away), 1), bool), held[:, :-1] < need], axis=1)
    mask = np.zeros(away.shape, bool)
    np.put_along_axis(mask, order, wanted, axis=1)
    return mask & (counts > 0)


def _route(queries: DataFrame, cells: Cells, need: int) -> DataFrame:
    """query_id, embedding, cell: the home cells."""
    shared = queries.sparkSession.sparkContext.broadcast((cells.centres, cells.counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                row, cell = np.nonzero(_home(_distances(_matrix(part.column(1)), centres), counts, need))
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(cell, pa.int32())], ["query_id", "embedding", "cell"])

    schema = StructType([*queries.schema.fields[:2], StructField("cell", IntegerType())])
    return cut_lineage(queries.mapInArrow(run, schema))


def _shelves(cells: Cells, parallelism: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(the cells of each shelf, the first shelf and the number of shelves of each cell).

    A shelf has up to BLOCK rows, fewer while the pairs of blocks would be fewer than four to a core; a larger cell has
    several shelves for itself. Cells that are near each other stand together.
    """
    size = min(BLOCK, max(AT_ONCE, -(-int(cells.counts.sum()) // (2 * math.ceil(math.sqrt(parallelism))))))
    members, first, parts, room = [], np.zeros(len(cells.counts), "int64"), np.ones(len(cells.counts), "int64"), 0
    for cell in np.argsort(_distances(cells.centres, cells.centres[:1])[:, 0], kind="stable"):
        n = int(cells.counts[cell])
        parts[cell] = max(1, -(-n // size))
        if parts[cell] > 1 or n > room:
            first[cell] = len(members)
            members += [[cell]] * parts[cell]
            room = 0 if parts[cell] > 1 else size - n
        else:
            first[cell] = len(members) - 1
            members[-1] = [*members[-1], cell]
            room -= n
    return [np.array(sorted(m)) for m in members], first, parts


def _route_shelves(queries: DataFrame, cells: Cells, need: int, members: list[np.ndarray], first: np.ndarray) -> DataFrame:
    """query_id, embedding, reach, shelf, visited, pairs: the shelves that hold cells, other than the home cells, within ``reach``.

    ``visited`` has a bit for each cell of the shelf, ``pairs`` counts their rows, once for a cell of several shelves.
    """
    shared = queries.sparkSession.sparkContext.broadcast((cells.centres, cells.counts, cells.nearest, cells.farthest, members, first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, counts, nearest, farthest, members, first = shared.value
        sizes = np.linalg.norm(centres, axis=1) + farthest
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                vectors = _matrix(part.column(1))
                away = _distances(vectors, centres)
                # Room for the rounding of distances, and for scores that are equal once rounded.
                limit = np.sqrt(part.column(2).to_numpy() + 2e-9)[:, None]
                room = 1e-6 * (1 + np.linalg.norm(vectors, axis=1)[:, None] + sizes)
                visit = ~_home(away, counts, need) & (counts > 0) & (np.maximum(away - farthest, nearest - away) <= limit + room)
                for shelf, own in enumerate(members):
                    rows = np.flatnonzero(visit[:, own].any(axis=1))
                    if len(rows):
                        seen = visit[np.ix_(rows, own)]
                        taken = part.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays([
                            *taken.columns, pa.array(np.full(len(rows), shelf), pa.int32()), pa.array([r.tobytes() for r in np.packbits(seen, axis=1)], pa.binary()),
                            pa.array(seen @ np.where(first[own] == shelf, counts[own], 0), pa.int64())], [*taken.schema.names, "shelf", "visited", "pairs"])

    schema = StructType([*queries.schema.fields, StructField("shelf", IntegerType()), StructField("visited", BinaryType()), StructField("pairs", LongType())])
    return cut_lineage(queries.mapInArrow(run, schema))


def _nearer(q: pd.DataFrame, b: pd.DataFrame, own: np.ndarray, k: int, exclude_self: bool) -> Iterator[pd.DataFrame]:
    """The k best rows of each query among the visited cells of a shelf, within its reach.

    One product tells which rows may be that near, with room for its rounding; their distances are worked out anew.
    """
    b = b.sort_values("cell", kind="stable")
    base, ids, cell = _matrix(b["embedding"]), b["vec_id"].to_numpy(), np.searchsorted(own, b["cell"].to_numpy())
    bounds = np.searchsorted(cell, np.arange(len(own) + 1))
    squares = np.sum(base**2, axis=1)
    longer = np.concatenate([base, -squares[:, None] / 2], axis=1).T.copy()
    for at in range(0, len(q), AT_ONCE):
        part = q.iloc[at:at + AT_ONCE]
        vectors, qids, reach = _matrix(part["embedding"]), part["query_id"].to_numpy(), part["reach"].to_numpy()
        visited = np.unpackbits(np.stack([np.frombuffer(v, "uint8") for v in part["visited"]]), axis=1)[:, :len(own)].astype(bool)
        lengths = np.sum(vectors**2, axis=1)
        least = (lengths - reach - 2e-9 - 1e-9 * (1 + lengths + np.max(squares, initial=0))) / 2
        with_one = np.concatenate([vectors, np.ones((len(part), 1))], axis=1)
        dense = (visited @ np.diff(bounds)).sum() >= 0.3 * len(part) * len(base)
        for low, high, rows in [(0, len(base), np.arange(len(part)))] if dense else [
                (bounds[c], bounds[c + 1], np.flatnonzero(visited[:, c])) for c in range(len(own)) if visited[:, c].any()]:
            near, col = np.nonzero(with_one[rows] @ longer[:, low:high] >= least[rows][:, None])
            row, col = rows[near], col + low
            if dense:
                keep = visited[row, cell[col]]
                row, col = row[keep], col[keep]
            for some in range(0, len(row), 100_000):  # distances of so many pairs at once
                r, c = row[some:some + 100_000], col[some:some + 100_000]
                score = np.round(-np.sum((vectors[r] - base[c]) ** 2, axis=1), 9)
                keep = np.isfinite(score) & (score >= -reach[r])
                if exclude_self:
                    keep &= qids[r] != ids[c]
                yield _first_k(pd.DataFrame({"query_id": qids[r[keep]], "vec_id": ids[c[keep]], "score": score[keep]}), k)


def _compare_shelves(visits: DataFrame, cells: Cells, k: int, exclude_self: bool, members: list[np.ndarray], first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """The k best rows of each visit to a shelf. Shelves with many visitors meet them in blocks."""
    spark = visits.sparkSession
    size = max(AT_ONCE, int(max((cells.counts[m].sum() // parts[m].max() for m in members), default=0)))
    shared = spark.sparkContext.broadcast(members)
    n_blocks = F.broadcast(visits.groupBy("shelf").agg(F.ceil(F.count("*") / size).cast("int").alias("n")))  # a row per shelf
    place = F.broadcast(spark.createDataFrame([(i, int(f), int(p)) for i, (f, p) in enumerate(zip(first, parts))], "cell int, first int, parts int"))
    left = visits.join(n_blocks, "shelf").select("query_id", "embedding", "reach", "visited", "shelf", F.pmod(F.xxhash64("query_id"), "n").cast("int").alias("qb"))
    rows = cells.rows.join(place, "cell").withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    right = rows.join(n_blocks, "shelf").select("vec_id", "embedding", "cell", "shelf", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("qb"))

    def search(key, q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = [f for f in _nearer(q, b, shared.value[key[0]], k, exclude_self) if len(f)] if len(q) and len(b) else []
        return _first_k(pd.concat(found), k) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return left.groupBy("shelf", "qb").cogroup(right.groupBy("shelf", "qb")).applyInPandas(search, RESULT)


def _compare(visits: DataFrame, cells: Cells, k: int, exclude_self: bool) -> DataFrame:
    """The k best rows of each visit. Large cells and cells with many visitors are cut into blocks on both sides."""
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return F.broadcast(df.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name)))  # a row per cell

    parts = blocks(cells.rows, "n_base").join(blocks(visits, "n_query"), "cell")
    parts = F.broadcast(parts)

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = visits.join(parts, "cell").select(
        "query_id", "embedding", "cell", F.pmod(F.xxhash64("query_id"), "n_query").cast("int").alias("qb"), every("n_base").alias("bb"))
    right = cells.rows.join(parts, "cell").select(
        "vec_id", "embedding", "cell", F.pmod(F.xxhash64("vec_id"), "n_base").cast("int").alias("bb"), every("n_query").alias("qb"))

    def search(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        base, ids = _matrix(b["embedding"]), b["vec_id"].to_numpy()
        return pd.concat([
            _local_best(part["query_id"].to_numpy(), ids, _scores(_matrix(part["embedding"]), base, "l2"), k, exclude_self)
            for part in (q.iloc[at:at + AT_ONCE] for at in range(0, len(q), AT_ONCE))])

    key = ("cell", "qb", "bb")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, RESULT)


def cell_visits(queries: DataFrame, cells: Cells, k: int = 5, exclude_self: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The visits to home cells, what they found, and the visits to the shelves of all other cells that may hold a nearer row."""
    queries = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "embedding").filter("embedding IS NOT NULL")
    home = _route(queries, cells, k + exclude_self)
    found = cut_lineage(_global_best(_compare(home, cells, k, exclude_self), k, "l2"))
    last = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("reach"))
    asked = queries.join(last, "query_id", "left").withColumn("reach", F.greatest(F.coalesce("reach", F.lit(float("inf"))), F.lit(0.0)))
    members, first, _ = _shelves(cells, queries.sparkSession.sparkContext.defaultParallelism)
    return home, found, _route_shelves(asked, cells, k + exclude_self, members, first)


def share_compared(home: DataFrame, more: DataFrame, cells: Cells, n_queries: int) -> float:
    """Pairs of query and row that were compared, as a share of all pairs."""
    visits = home.groupBy("cell").count().collect()  # a row per cell
    pairs = sum(r["count"] * int(cells.counts[r.cell]) for r in visits) + (more.agg(F.sum("pairs")).first()[0] or 0)
    return pairs / max(1, n_queries * int(cells.counts.sum()))


def knn_cells(base: DataFrame, queries: DataFrame, k: int = 5, exclude_self: bool = False, n_cells: int | None = None) -> DataFrame:
    """query_id, vec_id, score (squared distance) and rank, as knn_exact gives them, from an index of cells.

    Null vectors find nothing and are not found. Nothing is collected but centres and one row per cell.
    """
    cells = build_cells(base, n_cells)
    if not len(cells.centres):
        return base.sparkSession.createDataFrame([], RESULT + ", rank int")
    _, found, more = cell_visits(queries, cells, k, exclude_self)
    near = found.select("query_id", "vec_id", (-F.col("score")).alias("score"))
    shelves = _shelves(cells, base.sparkSession.sparkContext.defaultParallelism)
    return _global_best(near.unionByName(_compare_shelves(more, cells, k, exclude_self, *shelves)), k, "l2")
