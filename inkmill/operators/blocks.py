"""Values for the items of arrays: documents as blocks with a dictionary of their own.

An item is neither shuffled nor counted by itself. A block holds some rows, the distinct
items of its arrays and each array as places in that list. The distinct items of all
blocks get their values in one table, these go back to the blocks that hold the item,
and each block looks its arrays up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..session import cut_lineage

# Items of a block, but for a single longer array, and items of its dictionary per row.
BLOCK_ITEMS, PART = 2_000_000, 8_192


def _cuts(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``size`` items, or of one row."""
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield start, stop
        start = stop


def _write_blocks(df: DataFrame, id_col: str, items: Column, size: int) -> DataFrame:
    """_block, and either _id and _codes of a row or _start and _items of a part of the block's dictionary."""
    rows = df.select(F.col(id_col).alias("_id"), items.alias("_items"))
    id_type, array_type = rows.schema["_id"].dataType, rows.schema["_items"].dataType
    kinds = [pa.int64(), to_arrow_type(id_type), pa.list_(pa.int32()), pa.int32(), pa.list_(to_arrow_type(array_type.elementType))]
    names = ["_block", "_id", "_codes", "_start", "_items"]

    def batch_of(*columns: pa.Array | None) -> pa.RecordBatch:
        n = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else c.cast(k) for c, k in zip(columns, kinds)], names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = pc.fill_null(batch.column(1), pa.scalar([], batch.column(1).type))
            offsets = lists.offsets.to_numpy()
            for start, stop in _cuts(offsets, size):
                at = offsets[start:stop + 1]
                coded = lists.values.slice(int(at[0]), int(at[-1] - at[0])).dictionary_encode(null_encoding="encode")
                codes = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), coded.indices)
                yield batch_of(pa.array([number] * (stop - start)), batch.column(0).slice(start, stop - start), codes, None, None)
                n = len(coded.dictionary)
                parts = np.arange(0, n, PART, dtype=np.int32)
                if n:
                    own = pa.ListArray.from_arrays(pa.array(np.append(parts, n), pa.int32()), coded.dictionary)
                    yield batch_of(pa.array([number] * len(parts)), None, None, pa.array(parts), own)
                number += 1

    returns = f"_block bigint, _id {id_type.simpleString()}, _codes array<int>, _start int, _items {array_type.simpleString()}"
    return cut_lineage(rows.mapInArrow(blocks, returns))


def look_up(df: DataFrame, id_col: str, items: Column, values: Callable[[DataFrame], DataFrame], returns: str, out: str,
            size: int = BLOCK_ITEMS) -> DataFrame:
    """id_col, ``out``: one row per id with the value of each of its items, in order, as an array of ``returns``.

    ``values`` gets the distinct items as ``_item`` and an unknown number of other columns, and returns all rows with
    ``_value`` in place of ``_item``; ``returns`` is the array type of a value. Rows of one id are put together by
    place and value.
    """
    blocks = _write_blocks(df, id_col, items, size)
    listed = blocks.filter("_items IS NOT NULL").select("_block", "_start", F.posexplode("_items").alias("_at", "_item"))
    distinct = listed.groupBy("_item").agg(F.collect_list(F.struct("_block", (F.col("_start") + F.col("_at")).alias("_code"))).alias("_places"))
    valued = values(distinct).select(F.explode("_places").alias("_place"), "_value").select("_place._block", "_place._code", "_value")
    arrays = blocks.filter("_items IS NULL").select("_block", "_id", "_codes")
    id_type, kind = arrays.schema["_id"].dataType, to_arrow_type(DataType.fromDDL(f"array<{returns}>"))

    def decode(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:  # a block of empty arrays
            return pa.table({"_id": left.column("_id"), "_values": pa.array([[]] * left.num_rows, kind)})
        codes = left.column("_codes").combine_chunks()
        own = right.column("_value").combine_chunks().take(pc.sort_indices(right.column("_code").combine_chunks()))
        taken = own.take(codes.flatten())
        lists = pa.ListArray.from_arrays(pc.subtract(codes.offsets, codes.offsets[0]).cast(pa.int32()), taken)
        return pa.table({"_id": left.column("_id"), "_values": lists.cast(kind)})

    schema = f"_id {id_type.simpleString()}, _values array<{returns}>"
    done = arrays.groupBy("_block").cogroup(valued.groupBy("_block")).applyInArrow(decode, schema)
    repeated = cut_lineage(arrays.groupBy(F.col("_id").alias("_again")).count().filter("count > 1").select("_again"))
    if not repeated.isEmpty():
        done, again = cut_lineage(done), F.col("_id").eqNullSafe(F.col("_again"))
        entries = F.flatten(F.collect_list(F.transform("_values", lambda v, i: F.struct(i.alias("at"), v.alias("value")))))
        joined = done.join(repeated, again, "left_semi").groupBy("_id").agg(F.sort_array(entries).alias("_all"))
        done = done.join(repeated, again, "left_anti").unionByName(joined.select("_id", F.transform("_all", lambda e: e["value"]).alias("_values")))
    return done.select(F.col("_id").alias(id_col), F.col("_values").alias(out))


def table_values(table: DataFrame, key: str, value: str, rest: Column) -> Callable[[DataFrame], DataFrame]:
    """``values`` by a left join with a table: all values of an item, or ``rest`` where it has none or a null."""
    listed = table.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_item")).agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce(F.col(value), rest).alias("v")))).alias("_found"))

    def values(distinct: DataFrame) -> DataFrame:
        found = distinct.join(listed, "_item", "left")
        return found.withColumn("_value", F.coalesce(F.transform("_found", lambda f: f["v"]), F.array(rest))).drop("_item", "_found")

    return values
