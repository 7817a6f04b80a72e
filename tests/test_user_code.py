"""User code per batch and per partition, alternating streams, subsequences of long lines."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from inkmill.operators import combine, metrics as M, user_code
from inkmill.plans.evaluation import ACCURACY_F1
from inkmill.streaming import streams


def test_collate_one_row_a_batch(spark):
    def padded(examples):
        width = max(len(e["ids"]) for e in examples)
        return [{"ids": [e["ids"] + [0] * (width - len(e["ids"])) for e in examples], "n": len(examples)}]

    df = spark.range(23).select("id", F.sequence(F.lit(1), F.col("id").cast("int") + 1).alias("ids"), (F.col("id") % 2).alias("split"))
    rows = user_code.collate_batches(df.repartition(3), 5, "id", padded, "ids array<array<int>>, n int", ["split"]).collect()
    assert len(rows) == 6 and sorted((r.split, r.batch_id, r.n) for r in rows) == [(0, 0, 5), (0, 1, 5), (0, 2, 2), (1, 0, 5), (1, 1, 5), (1, 2, 1)]
    first = next(r for r in rows if (r.split, r.batch_id) == (1, 0))
    assert [sum(x > 0 for x in ids) for ids in first.ids] == [2, 4, 6, 8, 10] and {len(ids) for ids in first.ids} == {10}
    assert user_code.collate_batches(df.limit(0), 5, "id", padded, "ids array<array<int>>, n int").collect() == []


def test_metric_object(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(500)]
    df = spark.createDataFrame(rows, "p int, quality int").repartition(9)
    got = user_code.evaluate(df, ACCURACY_F1).collect()
    want = M.accuracy_f1(df, "p", "quality").first()
    assert len(got) == 1 and abs(got[0].accuracy - want.accuracy) < 1e-8 and abs(got[0].f1 - want.f1) < 1e-8
    assert [tuple(r) for r in user_code.evaluate(df.limit(0), ACCURACY_F1).collect()] == [(None, 0.0)]


def test_streams_alternate_over_batches(spark, tmp_path):
    def files(name, ids, n):
        for i in range(n):
            spark.createDataFrame([(x,) for x in ids[i::n]], "id long").coalesce(1).write.mode("append").json(f"{tmp_path}/{name}")

    files("a", list(range(40)), 4)
    files("b", list(range(100, 117)), 3)
    sides = [streams.stream_scan(spark, f"{tmp_path}/{n}", "id long", files_per_trigger=1) for n in "ab"]
    out = streams.drain_alternating(sides, "id", f"{tmp_path}/out").orderBy("position").collect()
    assert [r.position for r in out] == list(range(34))
    assert sorted(r.id for r in out[1::2]) == list(range(100, 117)) and all(r.id < 40 for r in out[::2])
    one = [streams.stream_scan(spark, f"{tmp_path}/{n}", "id long") for n in "ab"]
    again = streams.drain_alternating(one, "id", f"{tmp_path}/again")
    want = combine.interleave_datasets([spark.read.schema("id long").json(f"{tmp_path}/{n}") for n in "ab"], "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))


def positions_by_table(ref, pred):
    table = np.zeros((len(ref) + 1, len(pred) + 1), int)
    for i, x in enumerate(ref, 1):
        for j, y in enumerate(pred, 1):
            table[i, j] = table[i - 1, j - 1] + 1 if x == y else max(table[i - 1, j], table[i, j - 1])
    found, i, j = set(), len(ref), len(pred)
    while i and j:
        if ref[i - 1] == pred[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif table[i, j - 1] > table[i - 1, j]:
            j -= 1
        else:
            i -= 1
    return found


def test_subsequence_of_bits():
    rng = random.Random(5)
    for _ in range(300):
        ref, pred = ([rng.randrange(5) for _ in range(rng.randint(0, 25))] for _ in range(2))
        assert M.lcs_positions(np.array(ref, "int64"), np.array(pred, "int64")) == positions_by_table(ref, pred)


def test_long_lines_stay_small():
    rng = np.random.default_rng(6)
    a, b = (rng.integers(0, 3000, 20_000) for _ in range(2))
    tracemalloc.start()
    found = M.lcs_positions(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and len(found) == M.lcs_length(a.tolist(), b.tolist())
