"""Projections, filters and counts that shape a corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ..functions.text import contains_any, word_count
from ..session import spread
from .ordering import global_row_number
from .selection import rows_between


def keep_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Drop all but the listed columns; an unknown name is an error."""
    return df.select(*keep)


def map_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns, or replace those of the same name."""
    return df.withColumns(columns)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, parallel: bool = False) -> DataFrame:
    """Apply a batch function that expressions cannot replace; it may change the number of rows.

    ``parallel`` spreads a scan of few files over all cores first.
    """
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return (spread(df) if parallel else df).mapInPandas(batches, schema)


def filter_min_words(df: DataFrame, text: str, n: int) -> DataFrame:
    """Rows with more than n words."""
    return df.filter(word_count(text) > n)


def filter_bool_and_nonempty(df: DataFrame, flag: str, items: str) -> DataFrame:
    """Rows where the flag is false and the list has elements; nulls do not pass."""
    return df.filter(~F.col(flag) & (F.size(items) > 0))


def filter_keywords(df: DataFrame, text: str, keywords: list[str]) -> DataFrame:
    return df.filter(contains_any(text, keywords))


def keyword_retention(df: DataFrame, text: str, keywords: list[str]) -> DataFrame:
    """One row: rows in all, rows kept and the kept share (null for no rows)."""
    hit = contains_any(text, keywords)
    return df.agg(F.count("*").alias("total"), F.count_if(hit).alias("kept"),
                  F.avg(hit.cast("int")).alias("retained"))


def value_counts_topn(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Most frequent values, nulls aside, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(n)


def row_slice(df: DataFrame, order_col: str, start: int, stop: int) -> DataFrame:
    """Rows ``[start:stop]`` in the order of a unique numeric column; in no order.

    Whole numbers are cut by counting keys, without a shuffle of rows; with fractions or a null, rows are numbered.
    """
    whole = isinstance(df.schema[order_col].dataType, IntegralType)
    if whole and df.filter(F.col(order_col).isNull()).isEmpty():
        return rows_between(df, order_col, start, stop)
    ranked = global_row_number(df, order_col, out="_rn")
    return ranked.filter((F.col("_rn") > start) & (F.col("_rn") <= stop)).drop("_rn")


def preview(df: DataFrame, n_chars: int = 200) -> DataFrame:
    """The first characters of every column, under upper-case names."""
    return df.select(*[F.substring(F.col(c).cast("string"), 1, n_chars).alias(c.upper()) for c in df.columns])


def length_stats(df: DataFrame, size: Column) -> DataFrame:
    """Rows, total, mean, extremes and quartiles of a size."""
    return df.select(size.alias("_n")).agg(
        F.count("*").alias("n_rows"), F.sum("_n").alias("total"), F.avg("_n").alias("mean"),
        F.min("_n").alias("min"), F.max("_n").alias("max"),
        F.approx_percentile("_n", [0.25, 0.5, 0.75], 100000).alias("quartiles"))
