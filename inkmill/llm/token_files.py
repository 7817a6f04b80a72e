"""Token ids in ORC files in ascending order of document ids.

ORC stores the ids of a stripe as run-length coded integers and keeps statistics per stripe and per row group, and
Bloom filters of the document ids. A reader takes stripes in parallel and skips those that cannot hold a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .byte_level import encoder
from .common import partitions, text_slices

END_ID = 0
ROWS_PER_GROUP = 1_000
STRIPE_BYTES = 32 << 20
ROWS, TEXT_BYTES = 5_000, 16 << 20  # texts and bytes of text encoded together


def write_token_files(df: DataFrame, folder: str, path: str, end_id: int = END_ID, rows_per_group: int = ROWS_PER_GROUP,
                      stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write ``doc_id``, ``part``, ``place`` and ``tokens`` (with ``end_id`` last) of every text below ``folder``.

    Files are numbered in ascending order of ids by ``part``, the rows of a file by ``place``. A null text is only the
    end id; a null id comes first; rows with equal ids are ordered by a hash of the text. An empty table gives files
    without rows. Texts, not ids, are shuffled, as they are smaller.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, place = encoder(path), 0
        for batch in (part for whole in batches for part in text_slices(whole, [2], ROWS, TEXT_BYTES)):
            ids, ends = own.encode_batch(batch.column(2))
            offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.insert(ids, ends, end_id), pa.int32()))
            places = pa.array(np.arange(place, place + batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), places, lists], ["doc_id", "part", "place", "tokens"])
            place += batch.num_rows

    spark = df.sparkSession
    ordered = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(partitions(spark), "doc_id")
    ordered = ordered.withColumn("part", F.spark_partition_id()).sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "part", "text")
    ordered.mapInArrow(encode, "doc_id long, part int, place long, tokens array<int>").write.options(**{
        "orc.bloom.filter.columns": "doc_id", "orc.row.index.stride": str(rows_per_group), "orc.stripe.size": str(stripe_bytes),
        "orc.create.index": "true", "compression": "zstd"}).orc(folder)


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``part``, ``place`` and ``tokens``; with ``doc_ids`` only these, pruned by statistics and Bloom filters."""
    table = spark.read.schema("doc_id long, part int, place long, tokens array<int>").orc(folder)
    return table if doc_ids is None else table.filter(F.col("doc_id").isin(doc_ids))


def describe_token_files(tokens: DataFrame) -> DataFrame:
    """doc_id, part, place, n_tokens and ids_crc32 of every row of the files; no rows give none, repeated ids a row each."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())],
                                             ["doc_id", "part", "place", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(check, "doc_id long, part int, place long, n_tokens long, ids_crc32 long")


def add_starts(rows: DataFrame) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens and ids_crc32 of rows that were written to a table before.

    Files are in order of ids, so sums per file (one small row each) and a running sum by place inside a file give
    ``start``; rows with equal ids have the starts of their own places.
    """
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("_before") + local).alias("start"), "n_tokens", "ids_crc32")
