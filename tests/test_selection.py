"""Cuts by counting against sorted lists, also with repeated ids, extremes and wide ranges of keys."""

import random

import pytest
from pyspark.sql import functions as F

from inkmill.operators import sampling, selection, shaping


@pytest.mark.parametrize("width", [10, 20_000, 1 << 63])
def test_cuts(spark, width, monkeypatch):
    monkeypatch.setattr(selection, "FAN_OUT", 16)
    rng = random.Random(width)
    keys = sorted(rng.randint(-width, width - 1) for _ in range(300))
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k long").repartition(5)
    places = [0, 1, 2, 150, 151, 300, 301]
    total, cuts = selection.find_cuts(df, F.col("k"), lambda n: places)
    assert total == 300 and cuts[0] is None and cuts[-1] is None
    for place, cut in zip(places[1:-1], cuts[1:-1]):
        assert cut.key == keys[place - 1]
        assert cut.taken == place - sum(k < cut.key for k in keys) and cut.tied == keys.count(cut.key)


def test_no_rows_and_all_rows(spark):
    empty = spark.createDataFrame([], "id long, t string")
    assert sampling.sample_n(empty, "id", 3, 1).collect() == [] and shaping.row_slice(empty, "id", 0, 3).collect() == []
    ten = spark.range(10)
    assert sampling.sample_n(ten, "id", 0, 1).count() == 0 and sampling.sample_n(ten, "id", 99, 1).count() == 10
    assert {r.split for r in sampling.train_test_split_abs(ten, "id", 0, 10, 1).collect()} == {"test"}
    assert {r.split for r in sampling.train_test_split_frac(ten, "id", 1.0, 1).collect()} == {"train"}


def test_repeated_ids_keep_sizes(spark):
    """An id that a cut divides gives the exact number of its copies to each side; null ids are an id."""
    df = spark.createDataFrame([(i % 3 if i % 5 else None, i) for i in range(100)], "id long, n long")
    for n in (1, 17, 50, 99):
        rows = sampling.train_test_split_abs(df, "id", n, 100 - n, 4).collect()
        assert sum(r.split == "train" for r in rows) == n and sorted(r.n for r in rows) == list(range(100))


def test_slices(spark):
    df = spark.range(0, 900, 3).withColumn("x", F.col("id") / 2).repartition(7)
    for start, stop in ((0, 5), (120, 130), (295, 400), (300, 310), (7, 7), (9, 2)):
        want = list(range(0, 900, 3))[start:stop]
        assert sorted(r.id for r in shaping.row_slice(df, "id", start, stop).collect()) == want
    assert sorted(r.id for r in shaping.row_slice(df, "x", 4, 6).collect()) == [12, 15]


def test_rows_are_not_moved(spark):
    df = spark.range(1000).withColumn("text", F.repeat(F.lit("a"), 50))
    for out in (sampling.sample_n(df, "id", 10, 3), sampling.train_test_split_frac(df, "id", 0.5, 3), shaping.row_slice(df, "id", 3, 40)):
        assert "Exchange" not in out._jdf.queryExecution().toString()
