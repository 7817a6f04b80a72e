"""Sources and sinks: tables are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import uniform
from ..session import scratch_path
from ..sources import readers, writers
from . import tables as t
from .registry import query

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@query("scan_csv", """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'test' END AS split FROM orders""")
def scan_csv(spark, d):
    orders, path = t.read(spark, d, "orders"), scratch_path(spark, "tsv")
    writers.sink_csv(orders.filter("o_orderstatus = 'F'"), f"{path}/train", sep="\t")
    writers.sink_csv(orders.filter("o_orderstatus <> 'F'"), f"{path}/test", sep="\t")
    back = readers.scan_csv(spark, {"train": f"{path}/train", "test": f"{path}/test"}, ORDERS, sep="\t")
    return back.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
                       "o_orderpriority", "split")


@query("sink_csv", "SELECT doc_id, text, lang, 'all' AS split FROM documents")
def sink_csv(spark, d):
    path = scratch_path(spark, "csv")
    writers.sink_csv(t.documents(spark, d).select("doc_id", "text", "lang"), path)
    return readers.scan_csv(spark, {"all": path}, "doc_id bigint, text string, lang string", multi_line=True)


@query("scan_text", "SELECT line AS text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line")
def scan_text(spark, d):
    path = scratch_path(spark, "text")
    writers.sink_text(t.documents(spark, d), "text", path)
    return readers.scan_text(spark, path).groupBy("text").agg(F.count("*").alias("n"))


@query("sink_text", "SELECT replace(text, chr(10), ' ') AS text, count(*) AS n FROM documents GROUP BY 1")
def sink_text(spark, d):
    path = scratch_path(spark, "text")
    writers.sink_text(t.documents(spark, d), "text", path, one_line_per_row=True)
    return readers.scan_text(spark, path).groupBy("text").agg(F.count("*").alias("n"))


@query("scan_json", "SELECT event_id, event_type, value, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def scan_json(spark, d):
    path = scratch_path(spark, "json")
    events = t.read(spark, d, "events").withColumn("props", F.from_json("props", "k bigint"))
    writers.sink_json(events, path)
    back = readers.scan_json(spark, path, "event_id bigint, event_type string, value double, props struct<k: bigint>")
    return back.select("event_id", "event_type", "value", F.col("props.k").alias("k"))


@query("sink_json", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_json(spark, d):
    path = scratch_path(spark, "json")
    writers.sink_json(t.documents(spark, d), path)
    return readers.scan_json(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@query("scan_json_field", "SELECT conv_id, turn, role, text FROM conversations")
def scan_json_field(spark, d):
    """One object per line, its rows under ``data``; a list holds eight turns at most."""
    path = scratch_path(spark, "nested")
    turns = t.read(spark, d, "conversations").withColumn("part", F.floor(F.col("turn") / 8))
    nested = turns.groupBy("conv_id", "part").agg(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("data"))
    writers.sink_json(nested.select("data"), path)
    return readers.scan_json_field(spark, path, "data", "conv_id: bigint, turn: bigint, role: string, text: string", whole_file=False)


@query("scan_json_field_file", "SELECT doc_id, text, lang FROM documents")
def scan_json_field_file(spark, d):
    """Files that are one object each, however large."""
    path = scratch_path(spark, "whole")
    writers.sink_json_field(t.documents(spark, d).select("doc_id", "text", "lang"), "data", path)
    return readers.scan_json_field(spark, path, "data", "doc_id: bigint, text: string, lang: string")


@query("scan_compressed", "SELECT event_id, event_type, value, props FROM events")
def scan_compressed(spark, d):
    path = scratch_path(spark, "gz")
    writers.sink_json(t.read(spark, d, "events").drop("ts"), path, compression="gzip")
    return readers.scan_compressed(spark, path, "event_id bigint, event_type string, value double, props string")


@query("scan_sharded", f"""
SELECT doc_id, lang, CASE WHEN {t.sql_uniform('shard', 'doc_id')} < 0.9 THEN 'train' ELSE 'validation' END AS split FROM documents""")
def scan_sharded(spark, d):
    path = scratch_path(spark, "shards")
    docs = t.documents(spark, d).select("doc_id", "lang", (uniform("shard", "doc_id") < 0.9).alias("train"))
    writers.sink_json(docs.filter("train").repartition(6, "doc_id"), f"{path}/train")
    writers.sink_json(docs.filter("not train"), f"{path}/validation")
    return readers.scan_sharded(spark, {"train": f"{path}/train/part-*", "validation": [f"{path}/validation"]}, "doc_id bigint, lang string")


@query("scan_named_config", "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'es'")
def scan_named_config(spark, d):
    root = scratch_path(spark, "catalogue")
    docs = t.documents(spark, d).withColumn("config", F.col("lang")).withColumn("split", F.lit("train"))
    docs.write.partitionBy("config", "split").parquet(f"{root}/reviews")
    return readers.scan_named_config(spark, root, "reviews", "es", "train").select("doc_id", "source", "n_chars")


@query("scan_local_rows", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS language FROM documents""")
def scan_local_rows(spark, d):
    names = readers.scan_local_rows(spark, {"lang": ["en", "fr", "de", "es"], "language": ["English", "French", "German", "Spanish"]},
                                    "lang string, language string")
    return t.documents(spark, d).join(names, "lang", "left").select("doc_id", "language")


@query("scan_lazy_head", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 2")
def scan_lazy_head(spark, d):
    return readers.scan_lazy_head(t.documents(spark, d).select("doc_id", "lang"), 2, "doc_id")


@query("dataset_profile", "SELECT count(*) AS n_rows, 5 AS n_columns, 1::BIGINT AS n_files, true AS has_bytes FROM documents")
def dataset_profile(spark, d):
    profile = readers.dataset_profile(spark, f"{d}/documents.parquet")
    return profile.select("n_rows", "n_columns", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"))


@query("sink_save_reload", "SELECT doc_id, text, lang AS split FROM documents")
def sink_save_reload(spark, d):
    path = scratch_path(spark, "splits")
    writers.save_splits(t.documents(spark, d).select("doc_id", "text", F.col("lang").alias("split")), path)
    return writers.load_splits(spark, path)
