"""Contiguous shards with the smallest possible largest shard, groups of equal texts kept whole.

Rows are ordered by (digest of the text, id), so a group of equal texts is one run of rows and a row's shard
follows from its running size alone. Range partitions split a large group of copies over many tasks; their
number and size sums, one small row per partition, turn running sums inside a partition into global ones.

The smallest feasible capacity is searched between two bounds. A greedy check of a capacity needs, for each
shard, the last group end within reach: one aggregate over the few group ends of a narrow range, which the
Parquet statistics of the sorted table prune. One scan answers ``FAN`` capacities, so the search takes
log2(FAN) bits a pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage
from .common import partitions, text_of, without

FAN = 32


def _greedy(ends: DataFrame, capacities: list[int], n_shards: int, largest: int, total: int) -> list[list[int]]:
    """For each capacity the ends of its shards, filled one after the other."""
    at = [0] * len(capacities)
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(n_shards):
        reach = [min(total, a + c) for a, c in zip(at, capacities)]
        near = ends.filter((F.col("_end") > min(reach) - largest) & (F.col("_end") <= max(reach)))
        found = near.agg(*[F.max(F.when(F.col("_end") <= r, F.col("_end"))).alias(f"r{i}") for i, r in enumerate(reach)]).first()
        at = [a if f is None else max(a, f) for a, f in zip(at, found)]
        for own, a in zip(cuts, at):
            own.append(a)
    return cuts


def smallest_capacity(ends: DataFrame, n_shards: int, largest: int, total: int) -> tuple[int, list[int]]:
    """The smallest capacity with which ``n_shards`` shards hold everything, and the shard ends it gives."""
    low = max(largest, -(-total // n_shards))
    high = max(low, -(-total // n_shards) + largest)
    known: dict[int, list[int]] = {}
    while low < high:
        tried = sorted({low + (high - low) * i // FAN for i in range(FAN)})
        for capacity, cuts in zip(tried, _greedy(ends, tried, n_shards, largest, total)):
            if cuts[-1] >= total:
                high, known[capacity] = capacity, cuts
                break
            low = capacity + 1
    return high, known.get(high) or _greedy(ends, [high], n_shards, largest, total)[0]


def minimax_shards(df: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard`` and ``slot`` (from 0 without gaps in a shard).

    A null text has size 1 and checksum 0; null texts are a group of their own. A null id is ordered first.
    Repeated rows stay repeated and get a slot each. A group larger than an even share makes its shard that
    large; fewer groups than shards leave the last shards empty. An empty table gives an empty table. Other
    columns are not read.
    """
    spark = df.sparkSession
    text = text_of(text_col)
    narrow = cut_lineage(df.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col(text_col)), F.lit("")).alias("_group")))
    ranged = cut_lineage(narrow.repartitionByRange(partitions(spark), "_group", "_id").withColumn("_part", F.spark_partition_id()))
    by_part = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows")).select(
        "_part", *[F.coalesce(F.sum(c).over(by_part), F.lit(0)).alias(f"_before{c}") for c in ("_bytes", "_rows")])
    inside = W.partitionBy("_part").orderBy("_group", "_id").rowsBetween(W.unboundedPreceding, 0)
    placed = cut_lineage(ranged.join(F.broadcast(offsets), "_part").select(
        "_id", "size", "text_crc32", "_group",
        (F.col("_before_bytes") + F.sum("size").over(inside)).alias("_end"), (F.col("_before_rows") + F.count("*").over(inside)).alias("_rank")))
    groups = placed.groupBy("_group").agg(F.max("_end").alias("_end"), F.max("_rank").alias("_rank"), F.sum("size").alias("_size"))
    ends = cut_lineage(groups.repartitionByRange(partitions(spark), "_end").sortWithinPartitions("_end"))
    largest, total = ends.agg(F.max("_size"), F.max("_end")).first()
    cuts, ranks = [0] * (n_shards - 1), [0] * (n_shards - 1)
    if total:
        cuts = smallest_capacity(ends, n_shards, largest, total)[1][:-1]
        ranks = list(ends.filter(F.col("_end").isin(*{*cuts, total})).agg(
            *[F.max(F.when(F.col("_end") <= c, F.col("_rank"))).alias(f"k{i}") for i, c in enumerate(cuts)]).first()) if cuts else []
    shard, first = F.lit(0), F.lit(0).cast("long")
    for i, (cut, rank) in enumerate(zip(cuts, ranks)):
        shard = F.when(F.col("_end") > cut, i + 1).otherwise(shard)
        first = F.when(F.col("_end") > cut, F.lit(rank).cast("long")).otherwise(first)
    return placed.select(F.col("_id").alias(id_col), "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("_rank") - 1 - first).alias("slot"))


def bytes_law(df: DataFrame, n_shards: int = 8) -> DataFrame:
    """``minimax_shards`` with the name of its law."""
    return without(minimax_shards(df, n_shards), "law", "grown_shard").withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
