"""Sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.examples import pad_dynamic
from ..operators.ordering import global_row_number, shuffled_row_number


def save_splits(df: DataFrame, path: str) -> None:
    """One folder per split."""
    df.write.partitionBy("split").parquet(path)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    (df.write.option("header", True).option("escape", '"').option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def sink_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.json(path, compression=compression)


def sink_json_field(df: DataFrame, field: str, path: str) -> None:
    """Files that are one JSON object each, with the rows of a partition as a list under ``field``."""
    head = "{" + json.dumps(field) + ": ["

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = head
        for batch in batches:
            items = batch.column(0).to_pylist()
            if items:
                yield pa.RecordBatch.from_arrays([pa.array([before + items[0], *["," + i for i in items[1:]]])], ["value"])
                before = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]}" if before == "," else head + "]}"])], ["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(wrap, "value string").write.text(path)


def sink_text(df: DataFrame, text: str, path: str, one_line_per_row: bool = False) -> None:
    """Texts, one after the other; newlines inside a text stay unless every row must be one line."""
    column = F.regexp_replace(text, r"\R", " ") if one_line_per_row else F.col(text)
    df.select(column.alias("value")).write.text(path)


def training_batches(df: DataFrame, id_col: str, ids: str, batch_size: int, seed: int, pad_id: int = 0,
                     labels: str | None = None, shuffle: bool = True, groups: list[str] | None = None) -> DataFrame:
    """Shuffle, cut into batches and pad each batch to its longest row; batches are numbered in each group by itself."""
    if shuffle:
        ordered = shuffled_row_number(df, id_col, seed, groups, "_rn")
    else:
        ordered = global_row_number(df, id_col, groups, "_rn")
    batched = ordered.withColumn("batch_id", F.floor((F.col("_rn") - 1) / batch_size).cast("bigint")).drop("_rn")
    return pad_dynamic(batched, ids, [*(groups or []), "batch_id"], pad_id, labels)


def sink_training_batches(df: DataFrame, path: str, **options) -> None:
    """Padded batches of each split by itself, sorted so that the rows of a batch lie together."""
    training_batches(df, groups=["split"], **options).sortWithinPartitions("batch_id").write.partitionBy("split").parquet(path)
