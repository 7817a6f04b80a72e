"""Batch inference and what follows it: labels, entities, mask filling."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions.arrays import argmax_array, entity_spans, softmax, topk_array
from ..functions.once import compute_once


def batch_score(df: DataFrame, inputs: list[str], make_predict_fn: Callable, out: str, return_type=None,
                batch_size: int = 1024, input_shapes: list | None = None) -> DataFrame:
    """Add ``out`` by a caller's model; the model is loaded once per Python worker."""
    udf = predict_batch_udf(make_predict_fn, return_type=return_type or ArrayType(FloatType()),
                            batch_size=batch_size, input_tensor_shapes=input_shapes)
    return df.withColumn(out, udf(*[F.col(c) for c in inputs]))


def linear_scorer(n_features: int, n_classes: int) -> Callable:
    """A fixed linear model for tests: weight of feature i for class c is ((i + c) mod 7) - 3."""
    def make():
        i, c = np.meshgrid(np.arange(n_features), np.arange(n_classes), indexing="ij")
        weights = ((i + c) % 7 - 3).astype("float64")
        return lambda batch: batch.astype("float64") @ weights

    return make


def hashed_bag_scorer(n_dims: int) -> Callable:
    """A stand-in for a text model: per text two position vectors, the first with hashed word counts."""
    import hashlib

    def make():
        def predict(texts):
            hidden = np.zeros((len(texts), 2, n_dims), dtype="float32")
            for row, text in enumerate(texts):
                for word in text.split():
                    hidden[row, 0, int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % n_dims] += 1
            return hidden

        return predict

    return make


def embed_text(df: DataFrame, text: str, make_predict_fn: Callable, out: str = "embedding", batch_size: int = 256) -> DataFrame:
    """Embed texts by a caller's model that returns (texts, positions, dims); the first position is the embedding."""
    def pooled():
        predict = make_predict_fn()
        return lambda texts: predict(texts)[:, 0, :]

    return batch_score(df, [text], pooled, out, ArrayType(FloatType()), batch_size)


def classify_label(df: DataFrame, logits: str, names: Column) -> DataFrame:
    """Add ``label`` and ``score`` of the best class."""
    scored = df.withColumn("_probs", softmax(logits)).withColumn("_best", argmax_array(logits))
    return scored.withColumn("label", F.get(names, F.col("_best"))).withColumn(
        "score", F.get("_probs", F.col("_best"))).drop("_probs", "_best")


def ner_token_output(df: DataFrame, logits: str, tokens: str, names: Column) -> DataFrame:
    """One row per token whose best label is not O: entity, score, word, start, end.

    ``logits`` is one class vector per token, ``tokens`` an array of (token, start, end).
    """
    fixed = compute_once(df, logits, tokens)
    rows = fixed.select("*", F.posexplode(F.arrays_zip(F.col(logits).alias("l"), F.col(tokens).alias("t"))).alias("index", "_z"))
    rows = rows.withColumn("_logits", F.col("_z.l"))
    labelled = classify_label(rows, "_logits", names).filter("label <> 'O'")
    return labelled.select(*[c for c in df.columns if c not in (logits, tokens)], "index", F.col("label").alias("entity"),
                           "score", F.col("_z.t.token").alias("word"), F.col("_z.t.start").alias("start"),
                           F.col("_z.t.end").alias("end"))


def ner_group_entities(df: DataFrame, tags: str, scores: str, tokens: str) -> DataFrame:
    """One row per run of tokens of one type: entity_group, mean score, word, start, end."""
    fixed = compute_once(df, tags, scores, tokens)
    spans = compute_once(fixed, _spans=entity_spans(tags)).select("*", F.explode("_spans").alias("_s"))
    length = F.col("_s.end") - F.col("_s.start") + 1
    part = F.slice(scores, F.col("_s.start") + 1, length)
    words = F.transform(F.slice(tokens, F.col("_s.start") + 1, length), lambda t: t["token"])
    return spans.select(
        *[c for c in df.columns if c not in (tags, scores, tokens)],
        F.col("_s.type").alias("entity_group"),
        (F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / length).alias("score"),
        F.array_join(words, " ").alias("word"),
        F.get(tokens, F.col("_s.start"))["start"].alias("start"),
        F.get(tokens, F.col("_s.end"))["end"].alias("end"))


def fill_mask_topk(df: DataFrame, text: str, ids: str, logits: str, mask_id: int, vocab: DataFrame, k: int = 5,
                   mask_token: str = "[MASK]") -> DataFrame:
    """The k best tokens at the mask position, rendered into the text.

    ``logits`` is one vocabulary vector per position. Rows without a mask give nothing.
    """
    at = F.array_position(ids, mask_id)
    masked = df.filter(at > 0).withColumn("_logits", F.get(logits, (at - 1).cast("int")))
    best = masked.select("*", F.posexplode(topk_array("_logits", k)).alias("rank", "id"))
    named = best.join(vocab.select("id", "token"), "id", "left")
    drop = [c for c in (ids, logits) if c != text]
    return named.withColumn("score", F.get("_logits", F.col("id"))).withColumn(
        "filled", mask_fill_render(F.col(text), F.col("token"), mask_token)).drop("_logits", *drop)


def mask_fill_render(text: Column, token: Column, mask_token: str = "[MASK]") -> Column:
    return F.replace(text, F.lit(mask_token), token)
