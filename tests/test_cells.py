"""Neighbours through cells against the plain search: clusters, a hot vector, ties, blocks, too few rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.operators import cells, knn


def table(spark, vectors, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


def answers(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in df.collect())


def clustered(rng, n, width=6):
    middles = rng.normal(size=(12, width)) * 40
    return middles[rng.integers(0, 12, n)] + rng.normal(size=(n, width))


@pytest.mark.parametrize("k,exclude_self", [(1, False), (5, True)])
def test_equals_plain_search(spark, monkeypatch, k, exclude_self):
    monkeypatch.setattr(cells, "BLOCK", 40)
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 400)
    vectors[::3] = vectors[0]  # a third of all rows are one vector
    base = table(spark, vectors)
    queries = base.withColumnRenamed("vec_id", "query_id")
    want = answers(knn.knn_exact(base, queries, k, exclude_self=exclude_self))
    assert answers(cells.knn_cells(base, queries, k, exclude_self)) == want
    assert answers(cells.knn_cells(base, queries, k, exclude_self, n_cells=1)) == want


def test_most_cells_are_skipped(spark):
    rng = np.random.default_rng(4)
    base = table(spark, clustered(rng, 1500))
    queries = table(spark, clustered(rng, 100), 5000).withColumnRenamed("vec_id", "query_id")
    index = cells.build_cells(base)
    home, _, more = cells.cell_visits(base.limit(200).withColumnRenamed("vec_id", "query_id"), index, 5)
    assert cells.share_compared(home, more, index, 200) < 0.25
    assert answers(cells.knn_cells(base, queries, 5)) == answers(knn.knn_exact(base, queries, 5))


def test_few_rows_and_nulls(spark):
    base = table(spark, [[0, 0], [3, 4], [0, 0]])
    odd = base.unionByName(spark.createDataFrame([(9, None)], base.schema))
    queries = odd.withColumnRenamed("vec_id", "query_id")
    found = cells.knn_cells(odd, queries, 5)
    assert answers(found) == answers(knn.knn_exact(base, queries.filter("embedding IS NOT NULL"), 5))
    assert cells.knn_cells(base.filter(F.lit(False)), queries, 5).collect() == []
    assert cells.knn_cells(base, queries.filter(F.lit(False)), 5).collect() == []


def test_a_query_goes_to_a_shelf_once(spark, monkeypatch):
    """Without clusters all cells are visited: rows sent must not grow with the cells."""
    rng = np.random.default_rng(5)
    base = table(spark, rng.normal(size=(900, 16)))
    queries = base.withColumnRenamed("vec_id", "query_id")
    index = cells.build_cells(base)
    assert len(index.centres) == 30
    _, _, more = cells.cell_visits(queries, index, 5, True)
    assert more.count() <= 900
    monkeypatch.setattr(cells, "AT_ONCE", 64)
    monkeypatch.setattr(cells, "BLOCK", 100)
    assert answers(cells.knn_cells(base, queries, 5, True)) == answers(knn.knn_exact(base, queries, 5, exclude_self=True))


def test_vectors_without_distance(spark):
    rng = np.random.default_rng(6)
    vectors = clustered(rng, 200)
    vectors[::9, 0], vectors[1::9, 1] = np.nan, np.inf
    base = table(spark, vectors)
    queries = base.withColumnRenamed("vec_id", "query_id")
    finite = base.filter("forall(embedding, x -> abs(x) < 1e30 AND NOT isnan(x))")
    want = answers(knn.knn_exact(finite, finite.withColumnRenamed("vec_id", "query_id"), 5, exclude_self=True))
    assert len(want) == 5 * finite.count() and answers(cells.knn_cells(base, queries, 5, True)) == want
