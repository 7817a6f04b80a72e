"""Collate functions and metric objects of the user, run by Spark with results of a declared type."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .ordering import batch_ranges

Example = dict[str, Any]
FAN_IN = 256


def _values(column: pa.ChunkedArray) -> list:
    """``to_pylist``; lists of numbers go by way of numpy, without a scalar object for each number."""
    column = column.combine_chunks()
    if not pa.types.is_list(column.type) or not (pa.types.is_integer(column.type.value_type) or pa.types.is_floating(column.type.value_type)):
        return column.to_pylist()
    flat = column.flatten()
    numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(object)
    numbers[flat.is_null().to_numpy(zero_copy_only=False)] = None
    numbers = numbers.tolist()
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy()).tolist()
    return [numbers[start:end] if valid else None for start, end, valid in zip([0, *ends], ends, column.is_valid().to_pylist())]


def _examples(table: pa.Table) -> list[Example]:
    return [dict(zip(table.column_names, row)) for row in zip(*[_values(c) for c in table.columns])]


def collate_batches(df: DataFrame, batch_size: int, order_col: str, collate: Callable[[list[Example]], list[Example]], schema: str,
                    groups: list[str] | None = None) -> DataFrame:
    """``collate`` on each batch of consecutive rows, per group: the group's columns, batch_id and ``schema``.

    It gets the examples of one batch in order, without the columns of the groups, and returns any number of rows, one
    for each example or one for the whole batch. ``order_col`` is unique within a group. Rows are shuffled once, to the
    range of batches that they lie in; a task cuts it into its batches.
    """
    keys = [*(groups or []), "batch_id"]
    ranged = batch_ranges(df, batch_size, order_col, groups, "_range_start")
    kinds = StructType([*[df.schema[g] for g in groups or []], StructField("batch_id", LongType())])
    out = StructType([*kinds.fields, *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(out)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        *own, first = (v.as_py() for v in key)
        table = table.drop_columns([*(groups or []), "_range_start"])
        table = table.take(pc.sort_indices(table, [(order_col, "ascending")], null_placement="at_start"))
        parts = []
        for n, at in enumerate(range(0, table.num_rows, batch_size)):
            examples = _examples(table.slice(at, batch_size).sort_by(order_col))
            named = dict(zip(keys, [*own, first + n]))
            parts.append(pa.Table.from_pylist([row | named for row in collate(examples)], arrow))
        return pa.concat_tables(parts)

    return ranged.groupBy(*(groups or []), "_range_start").applyInArrow(run, out)


@dataclass(frozen=True)
class Metric:
    """A user's aggregate. A state is a dict of the fields in ``state``, its size independent of the rows.

    ``start`` is the state of no rows, ``partial`` the state of a list of examples, ``merge`` joins two states in any
    order, and ``finish`` gives the fields in ``result``.
    """

    state: str
    result: str
    start: Callable[[], Example]
    partial: Callable[[list[Example]], Example]
    merge: Callable[[Example, Example], Example]
    finish: Callable[[Example], Example]


def evaluate(df: DataFrame, metric: Metric) -> DataFrame:
    """One row, the metric over all rows, also of an empty table.

    Every partition folds its batches into one state; states are joined in FAN_IN groups and then in one, so only a
    state a partition is shuffled.
    """
    state = StructType.fromDDL(metric.state)
    grouped = StructType([*state.fields, StructField("_group", IntegerType())])
    plain, with_group, result = to_arrow_schema(state), to_arrow_schema(grouped), StructType.fromDDL(metric.result)
    shown = to_arrow_schema(result)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reduce(metric.merge, (metric.partial(b.to_pylist()) for b in batches if b.num_rows), metric.start())
        place = TaskContext.get().partitionId() % FAN_IN
        yield pa.RecordBatch.from_pylist([own | {"_group": place}], with_group)

    def join(table: pa.Table) -> Example:
        return reduce(metric.merge, table.select(plain.names).to_pylist(), metric.start())

    states = df.mapInArrow(fold, grouped).groupBy("_group").applyInArrow(lambda t: pa.Table.from_pylist([join(t)], plain), state)
    none = df.sparkSession.createDataFrame([tuple(metric.start()[n] for n in plain.names)], state)
    return states.unionByName(none).groupBy().applyInArrow(lambda t: pa.Table.from_pylist([metric.finish(join(t))], shown), result)
