"""Sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from inkmill.functions.text import contains_any
from inkmill.operators import shaping
from inkmill.plans import streams as plan_streams
from inkmill.plans.shaping import KEYWORDS
from inkmill.session import cut_lineage, scratch_path
from inkmill.sources import readers, writers
from inkmill.streaming import streams

ROWS = [(1, 'He said "no",\nthen\tleft. '), (2, ""), (3, " plain ")]


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame(ROWS, "id bigint, text string")


@pytest.mark.parametrize("sep", [",", "\t"])
def test_csv_round_trip(spark, texts, sep, tmp_path):
    writers.sink_csv(texts, f"{tmp_path}/x", sep)
    back = readers.scan_csv(spark, {"train": f"{tmp_path}/x"}, "id bigint, text string", sep, multi_line=True).orderBy("id").collect()
    # An empty field is read as null.
    assert [(r.id, r.text, r.split) for r in back] == [(i, s or None, "train") for i, s in ROWS]


def test_json_field_of_whole_file(spark, tmp_path):
    data = {"data": [{"title": "a", "paragraphs": [{"context": "c", "n": 1}]}, {"title": "b", "paragraphs": []}]}
    (tmp_path / "x.json").write_text(json.dumps(data, indent=2))
    rows = readers.scan_json_field(spark, str(tmp_path / "x.json"), "data", "title: string, paragraphs: array<struct<context: string, n: int>>").collect()
    assert [r.title for r in rows] == ["a", "b"] and rows[0].paragraphs[0].n == 1


def test_zst_is_read(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    lines = "\n".join(json.dumps({"meta": {"pmid": i, "language": "eng"}, "text": f"t{i}"}) for i in range(5))
    (tmp_path / "x.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(lines.encode()))
    df = readers.scan_compressed(spark, str(tmp_path / "x.jsonl.zst"), "meta struct<pmid: bigint, language: string>, text string")
    assert sorted((r.pmid, r.text) for r in df.select("meta.pmid", "text").collect()) == [(i, f"t{i}") for i in range(5)]


def test_text_keeps_or_joins_lines(spark, texts, tmp_path):
    writers.sink_text(texts, "text", f"{tmp_path}/a")
    writers.sink_text(texts, "text", f"{tmp_path}/b", one_line_per_row=True)
    assert readers.scan_text(spark, f"{tmp_path}/a").count() == 4
    assert sorted(r.text for r in readers.scan_text(spark, f"{tmp_path}/b").collect()) == ["", " plain ", 'He said "no", then\tleft. ']


def test_profile(spark, texts, tmp_path):
    texts.repartition(3).write.parquet(f"{tmp_path}/p")
    row = readers.dataset_profile(spark, f"{tmp_path}/p").first()
    assert (row.n_rows, row.n_columns) == (3, 2) and row.n_files >= 1 and row.n_bytes > 0


def test_named_config_prunes(spark, texts, tmp_path):
    df = texts.withColumn("config", F.when(F.col("id") == 1, "en").otherwise("es")).withColumn("split", F.lit("train"))
    df.write.partitionBy("config", "split").parquet(f"{tmp_path}/reviews")
    out = readers.scan_named_config(spark, str(tmp_path), "reviews", "es", "train")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(config" in out._jdf.queryExecution().toString()


def test_local_rows(spark):
    assert readers.scan_local_rows(spark, {"a": [1, 2], "b": ["x", "y"]}, "a int, b string").collect() == [(1, "x"), (2, "y")]


def test_map_batches_may_change_rows(spark, texts):
    out = shaping.map_batches(texts, lambda f: f.loc[f.index.repeat(2)][["id"]], "id bigint")
    assert sorted(r.id for r in out.collect()) == [1, 1, 2, 2, 3, 3]


def test_keep_columns_is_strict(spark, texts):
    with pytest.raises(Exception):
        shaping.keep_columns(texts, ["id", "nope"]).collect()


def test_flag_filter_drops_nulls(spark):
    df = spark.createDataFrame([(1, False, ["a"]), (2, True, ["a"]), (3, False, []), (4, False, None)], "id int, pr boolean, c array<string>")
    assert [r.id for r in shaping.filter_bool_and_nonempty(df, "pr", "c").collect()] == [1]


def test_stream_equals_batch(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f{i}.json").write_text("\n".join(json.dumps({"id": i * 10 + k, "text": "pandas" if k % 3 == 0 else "x"}) for k in range(7)))
    schema = "id bigint, text string"
    stream = streams.stream_scan(spark, str(tmp_path), schema, pattern="*.json", files_per_trigger=2)
    batch = spark.read.schema(schema).json(str(tmp_path))
    drained = streams.drain_to_parquet(stream, scratch_path(spark, "s"))
    assert sorted(drained.collect()) == sorted(batch.collect())
    counts = streams.drain_latest(streams.stream_retention(stream, "text", ["pandas"]), scratch_path(spark, "s")).first()
    assert (counts.total, counts.kept) == (42, 18)


def test_cut_lineage_uses_the_shared_folder(spark, texts):
    table = cut_lineage(texts)
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in f for f in table.inputFiles()) and table.count() == 3


@pytest.mark.parametrize("files", [1, 3])
def test_stream_queries_read_tables_of_one_file_and_of_folders(spark, tmp_path, files):
    rows = [(i, "pandas" if i % 2 else "x", "en" if i % 3 else "fr", "s", 1) for i in range(12)]
    spark.createDataFrame(rows, plan_streams.DOCUMENTS).repartition(files).write.parquet(f"{tmp_path}/t/documents.parquet")
    if files == 1:
        part = next((tmp_path / "t" / "documents.parquet").glob("part-*.parquet"))
        (tmp_path / "one").mkdir()
        (tmp_path / "one" / "documents.parquet").write_bytes(part.read_bytes())
    d = f"{tmp_path}/{'one' if files == 1 else 't'}"
    assert sorted(r.doc_id for r in plan_streams.stream_scan(spark, d).collect()) == list(range(12))
    assert tuple(plan_streams.stream_keyword_filter(spark, d).first()) == (12, spark.read.parquet(f"{d}/documents.parquet").filter(
        contains_any("text", KEYWORDS)).count())
    both = plan_streams.stream_alternate(spark, d).orderBy("position").collect()
    assert [r.lang for r in both] == ["en", "fr"] * 4
