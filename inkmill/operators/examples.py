"""Model-ready examples: padding, packing, chunking and masking of token arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType

from ..functions.arrays import attention_mask, chunk_fixed, pad_array
from ..functions.once import compute_once
from ..functions.scalars import IGNORE_LABEL, row_draws, uniform
from .ordering import batch_assign, running_offset


def pad_dynamic(df: DataFrame, ids: str, batch_cols: list[str], pad_id: int = 0,
                labels: str | None = None) -> DataFrame:
    """Pad to the longest row of each batch; adds ``attention_mask``. Labels are filled with the ignored value."""
    width = F.max(F.size(ids)).over(W.partitionBy(*batch_cols))
    return _pad(df.withColumn("_width", width), ids, pad_id, labels)


def pad_max_length(df: DataFrame, ids: str, width: int, pad_id: int = 0, labels: str | None = None) -> DataFrame:
    """Pad to a constant width."""
    return _pad(df.withColumn("_width", F.lit(width)), ids, pad_id, labels)


def pad_global(df: DataFrame, ids: str, pad_id: int = 0, labels: str | None = None) -> DataFrame:
    """Pad to the longest row of the data set."""
    return _pad(df.withColumn("_width", df.agg(F.max(F.size(ids))).scalar()), ids, pad_id, labels)


def _pad(df: DataFrame, ids: str, pad_id: int, labels: str | None) -> DataFrame:
    out = {"attention_mask": attention_mask(ids, "_width"), ids: pad_array(ids, "_width", pad_id)}
    if labels:
        out[labels] = pad_array(labels, "_width", IGNORE_LABEL)
    return df.withColumns(out).drop("_width")


def group_texts(df: DataFrame, ids: str, order_col: str, chunk: int = 128, batch_rows: int = 1000,
                groups: list[str] | None = None) -> DataFrame:
    """Concatenate the token arrays of each batch and cut them into full chunks.

    Each row contributes one slice per chunk that it touches, so rows are regrouped,
    not single tokens. What is left of a batch after its last full chunk is dropped.
    Batch and chunk share the partitioning by batch: one shuffle serves both.
    """
    groups = groups or []
    keys = [*groups, "batch_id"]
    sized = batch_assign(df.select(*groups, order_col, ids), batch_rows, order_col, groups)
    placed = running_offset(sized, F.size(ids), keys, order_col, "_at").filter(F.size(ids) > 0)
    first = F.floor(F.col("_at") / chunk)
    last = F.floor((F.col("_at") + F.size(ids) - 1) / chunk)
    pieces = placed.withColumn("chunk_id", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("chunk_id") * chunk - F.col("_at"), F.lit(0)).cast("int")
    stop = F.least((F.col("chunk_id") + 1) * chunk - F.col("_at"), F.size(ids)).cast("int")
    pieces = pieces.select(*keys, "chunk_id", F.struct(
        (F.col("_at") + start).alias("at"), F.slice(ids, start + 1, stop - start).alias("part")).alias("piece"))
    packed = pieces.groupBy(*keys, "chunk_id").agg(F.sort_array(F.collect_list("piece")).alias("_pieces"))
    joined = packed.withColumn(ids, F.flatten(F.transform("_pieces", lambda p: p["part"]))).drop("_pieces")
    return joined.filter(F.size(ids) == chunk).withColumn("labels", F.col(ids))


def chunk_overflow(df: DataFrame, ids: str, context: int = 128) -> DataFrame:
    """Cut each row into chunks and keep the full ones; ``chunk_id`` numbers them within the row."""
    chunks = compute_once(df, ids).select("*", F.posexplode_outer(chunk_fixed(ids, context)).alias("chunk_id", "_chunk"))
    return chunks.drop(ids).withColumnRenamed("_chunk", ids).filter(F.size(ids) == context)


def mlm_mask(df: DataFrame, ids: str, key: list[str], mask_id: int, vocab_size: int, seed: int = 42,
             probability: float = 0.15, special_ids: tuple[int, ...] = (), epoch: int = 0) -> DataFrame:
    """Random token masking with reproducible draws.

    Chosen positions keep their id as label and become the mask id in 80 % of the
    cases, a random id in 10 % and stay in 10 %. Draws depend on seed, epoch, key and
    position.
    """
    def draw(kind: str, i: Column) -> Column:
        return uniform(f"{seed}:{epoch}:{kind}", *key, i)

    def chosen(x: Column, i: Column) -> Column:
        hit = draw("m", i) < probability
        return hit & ~x.isin(*special_ids) if special_ids else hit

    def masked(x: Column, i: Column) -> Column:
        action = draw("a", i)
        other = F.floor(draw("r", i) * vocab_size).cast("int")
        return F.when(~F.get("_hit", i), x).when(action < 0.8, F.lit(mask_id)).when(action < 0.9, other).otherwise(x)

    return (
        compute_once(compute_once(df, ids), _hit=F.transform(ids, chosen))
        .withColumn("labels", F.transform(ids, lambda x, i: F.when(F.get("_hit", i), x).otherwise(F.lit(IGNORE_LABEL))))
        .withColumn(ids, F.transform(ids, masked))
        .drop("_hit")
    )


def _word_numbers(word_ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of the rows, number of the word of each position or -1), over the flat Arrow buffer."""
    bounds = word_ids.offsets.to_numpy().astype("int64")
    bounds = bounds - bounds[0]
    flat = word_ids.flatten()
    named = flat.is_valid().to_numpy(zero_copy_only=False)
    words = flat.drop_null().dictionary_encode().indices.to_numpy()
    row = np.repeat(np.arange(len(word_ids)), np.diff(bounds))[named]
    first = np.diff(row, prepend=-1) > 0
    changed = first.copy()
    changed[1:] |= words[1:] != words[:-1]
    count, starts = np.cumsum(changed), np.flatnonzero(first)
    index = np.full(len(named), -1, "int32")
    index[named] = count - np.repeat(count[starts], np.diff(np.append(starts, len(row))))
    return bounds, index


@F.arrow_udf(ArrayType(IntegerType()))
def _word_index(word_ids: pa.Array) -> pa.Array:
    bounds, index = _word_numbers(word_ids)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(index, mask=index < 0), mask=word_ids.is_null())


def add_word_index(df: DataFrame, word_ids: str, out: str) -> DataFrame:
    """Add the index of the word of each position, null for positions without a word.

    The index grows whenever a word id differs from the last one that was not null.
    """
    return df.withColumn(out, _word_index(word_ids))


def _word_hits(probability: float):
    """Column function (key as text, word ids) -> whether the word of each position is drawn, one draw per word."""
    @F.arrow_udf(ArrayType(BooleanType()))
    def hits(prefixes: pa.Array, word_ids: pa.Array) -> pa.Array:
        bounds, index = _word_numbers(word_ids)
        hit = np.zeros(len(index), bool)
        for prefix, start, end in zip(prefixes.to_pylist(), bounds[:-1], bounds[1:]):
            own = index[start:end]
            draws = row_draws(prefix, int(own.max(initial=-1)) + 1)
            hit[start:end] = np.append(draws < probability, False)[own]  # the last one is for positions without a word
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hit), mask=word_ids.is_null())

    return hits


def whole_word_mask(df: DataFrame, ids: str, labels: str, word_ids: str, key: list[str], mask_id: int,
                    seed: int = 42, probability: float = 0.2, epoch: int = 0) -> DataFrame:
    """Mask whole words: one draw per word, all its tokens masked, labels only there."""
    prefix = F.concat_ws(":", F.lit(f"{seed}:{epoch}:w"), *[F.col(k).cast("string") for k in key])
    drawn = df.withColumn("_hit", _word_hits(probability)(prefix, word_ids))
    return (
        compute_once(drawn, ids, labels)
        .withColumn(labels, F.transform(labels, lambda x, i: F.when(F.get("_hit", i), x).otherwise(F.lit(IGNORE_LABEL))))
        .withColumn(ids, F.transform(ids, lambda x, i: F.when(F.get("_hit", i), F.lit(mask_id)).otherwise(x)))
        .drop("_hit")
    )


def training_step_count(df: DataFrame, batch_size: int, epochs: int, drop_last: bool = False) -> DataFrame:
    """One row: optimiser steps for a number of epochs."""
    batches = F.count("*") / F.lit(batch_size)
    whole = F.floor(batches) if drop_last else F.ceil(batches)
    return df.agg((whole * epochs).cast("bigint").alias("steps"))
