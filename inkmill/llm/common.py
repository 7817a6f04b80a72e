"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space that ends a word.
BLANKS = "\t\n\x0b\x0c\r"


def text_of(col: str) -> Column:
    """A text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D.

    Plain replacements and a split at one character need no pattern matcher.
    """
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def squeezed(text: Column) -> Column:
    """A text without its white space."""
    for blank in (*BLANKS, " "):
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    """Tasks of one shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, columns: list[int], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of at most ``rows`` rows and about ``size`` bytes of text; a longer text is a run of its own.

    What Python makes of texts takes many times their size, so it is made for one run at a time.
    """
    lengths = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
    ends, at = np.cumsum(sum(lengths)), 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = min(at + rows, max(at + 1, fits), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns that an operator is about to add."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def constant_array(values: list[int], kind: str) -> Column:
    """Numbers as one constant of the plan, folded once, in place of one expression per number."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def keeps_columns(*column_arguments: str) -> Callable:
    """For an operator on a table whose helper columns start with ``_``: columns of such names in the table are kept.

    They bear other names while the operator runs, also where one of ``column_arguments`` names them.
    """
    def decorate(operator: Callable) -> Callable:
        signature = inspect.signature(operator)

        @wraps(operator)
        def run(df: DataFrame, *args, **options) -> DataFrame:
            names = {c: f"__user{i}" for i, c in enumerate(df.columns) if c.startswith("_")}
            if not names:
                return operator(df, *args, **options)
            call = signature.bind(_renamed(df, names), *args, **options)
            given = call.arguments
            for where in (given, given.get("options", {})):
                where.update({a: names.get(where[a], where[a]) for a in column_arguments if a in where})
            return _renamed(operator(*call.args, **call.kwargs), {new: old for old, new in names.items()})

        return run

    return decorate
