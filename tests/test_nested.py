"""Lists under a key of whole-file JSON objects, cut into pieces anywhere."""

import json
import random

import pytest

from inkmill.sources import readers, writers
from inkmill.sources.nested import list_items

TEXTS = ["", "plain", "}", "{", "[{\"data\": [{", '"', "\\", "\\\\", '\\"}', "a}b\"]}{", "ä€𝄞", "x" * 300 + "}" * 20, '"data": [']


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind < 2:
        return rng.choice(TEXTS)
    if kind == 2:
        return rng.choice([1, None, True])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["data", "k", "a}b", '\\"data'] + TEXTS): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def document(rng):
    """A file: the wanted list among other values, some of them lists of objects or objects that hold the same key."""
    items = [value(rng) if rng.random() < 0.2 else {"n": i, "v": value(rng)} for i in range(rng.randrange(30))]
    other = [(f"k{i}", rng.choice([value(rng), [{"n": -1}, {"data": [{"n": -2}]}], {"data": [{"n": -3}]}])) for i in range(4)]
    other.append(("}data", [{"n": -4}]))
    entries = [*other[:2], ("data", items), *other[2:]]
    rng.shuffle(entries)
    return dict(entries), [i for i in items if isinstance(i, dict)]


@pytest.fixture()
def small_pieces(spark):
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size,indent,ascii", [(23, None, True), (100, 2, False), (700, None, False), (1 << 20, 1, True)])
def test_items_of_pieces(spark, small_pieces, tmp_path, size, indent, ascii):
    rng = random.Random(size)
    want = []
    for f in range(6):
        whole, items = document(rng)
        (tmp_path / f"{f}.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=ascii) + "\n" * (f % 3), encoding="utf-8")
        want += items
    small_pieces(size)
    got = [json.loads(r.item) for r in list_items(spark, str(tmp_path), "data").collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_one_file_is_many_tasks(spark, small_pieces, tmp_path):
    data = {"version": "1", "data": [{"id": i, "text": "a}b" * (i % 5)} for i in range(500)]}
    (tmp_path / "x.json").write_text(json.dumps(data))
    small_pieces(1000)
    rows = readers.scan_json_field(spark, str(tmp_path / "x.json"), "data", "id: bigint, text: string")
    assert sorted((r.id, r.text) for r in rows.collect()) == [(d["id"], d["text"]) for d in data["data"]]
    assert sum(1 for n in rows.rdd.glom().map(len).collect() if n) > 8


def test_item_over_many_pieces(spark, small_pieces, tmp_path):
    long = {"id": 1, "parts": [{"s": "}" * 50} for _ in range(100)]}
    (tmp_path / "x.json").write_text(json.dumps({"data": [long, {"id": 2}, long]}))
    small_pieces(90)
    assert sorted(len(r.item) for r in list_items(spark, str(tmp_path), "data").collect()) == sorted(len(json.dumps(x)) for x in [long, {"id": 2}, long])


def test_odd_files(spark, small_pieces, tmp_path):
    """Empty files, empty lists, no such key, a list at the top, a key that stands twice."""
    for i, text in enumerate(["", "{}", '{"data": []}', '{"other": [{"id": 1}]}', '[{"data": [{"id": 2}]}]', '{"data": {"data": [{"id": 3}]}}',
                              '{"data":[{"id":4}],"x":[{"id":5}],"data":[{"id":6}]}', '{"data" : [ 1, null, "s", [{"id": 7}], {"id": 8} ] }']):
        (tmp_path / f"{i}.json").write_text(text)
    for size in (7, 1 << 20):
        small_pieces(size)
        assert sorted(json.loads(r.item)["id"] for r in list_items(spark, str(tmp_path), "data").collect()) == [4, 6, 8]


def test_sink_round_trip(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "repeat('}\"', cast(id % 4 as int)) AS text").repartition(3)
    writers.sink_json_field(df, "rows", f"{tmp_path}/a")
    writers.sink_json_field(df.limit(0), "rows", f"{tmp_path}/b")
    schema = "id: bigint, text: string"
    assert sorted(readers.scan_json_field(spark, f"{tmp_path}/a", "rows", schema).collect()) == sorted(df.collect())
    assert readers.scan_json_field(spark, f"{tmp_path}/b", "rows", schema).count() == 0


@pytest.mark.parametrize("step", [1, 10, 100])
def test_steps_within_a_piece(monkeypatch, step):
    import pyarrow as pa

    from inkmill.sources import nested

    monkeypatch.setattr(nested, "STEP_BYTES", step)
    whole, items = document(random.Random(step))
    lines = json.dumps(whole).split("}")[:-1]
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(lines)), pa.array([0] * len(lines), pa.int64()), pa.array(lines)], ["a", "b", "c"])
    begins = nested._beginnings([type("P", (), r) for b in nested._describe(iter([batch])) for r in b.to_pylist()])
    got = [json.loads(r["item"]) for b in nested._items(begins, "data", False)(iter([batch])) for r in b.to_pylist()]
    assert got == items
