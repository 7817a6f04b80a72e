"""Extractive question answering: windows, span labels and answer selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import topk_array
from ..functions.once import compute_once
from ..functions.text import substring_by_offset


def qa_windows(df: DataFrame, question: str, context: str, max_length: int = 384, stride: int = 128) -> DataFrame:
    """One row per window over the context tokens.

    ``question`` and ``context`` are arrays of (token, start, end). A window holds
    ``max_length - |question| - 3`` context tokens and overlaps the one before by
    ``stride``. Adds ``window``, ``ctx_from`` (first context token) and ``ctx`` (its tokens).
    A question that leaves no step is an error.
    """
    cap = F.lit(max_length - 3) - F.size(question)
    step = F.when(cap > stride, cap - stride).otherwise(
        F.raise_error(F.lit("question too long for this max_length and stride")).cast("int"))
    extra = F.greatest(F.size(context) - cap, F.lit(0))
    sized = df.withColumn("_cap", cap).withColumn("_step", step).withColumn(
        "_n", (F.ceil(extra / F.col("_step")) + 1).cast("int"))
    windows = sized.withColumn("window", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    windows = windows.withColumn("ctx_from", F.col("window") * F.col("_step"))
    return windows.withColumn("ctx", F.slice(context, F.col("ctx_from") + 1, F.col("_cap"))).drop("_cap", "_step", "_n")


def window_tokens(question: str, ctx: str, cls: str = "[CLS]", sep: str = "[SEP]") -> Column:
    """Tokens of a window: question and context between special tokens."""
    names = [F.transform(c, lambda t: t["token"]) for c in (question, ctx)]
    return F.concat(F.array(F.lit(cls)), names[0], F.array(F.lit(sep)), names[1], F.array(F.lit(sep)))


def sequence_ids(question: str, ctx: str) -> Column:
    """0 for question tokens, 1 for context tokens, null for special tokens."""
    none = F.array(F.lit(None).cast("int"))
    return F.concat(none, F.array_repeat(F.lit(0), F.size(question)), none,
                    F.array_repeat(F.lit(1), F.size(ctx)), none)


def offset_mapping(question: str, ctx: str) -> Column:
    """(start, end) of every token; (0, 0) for special tokens."""
    def spans(tokens: str) -> Column:
        return F.transform(tokens, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))

    zero = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")))
    return F.concat(zero, spans(question), zero, spans(ctx), zero)


def eval_offsets(offsets: str, seq_ids: str) -> Column:
    """Offsets with everything outside the context set to null."""
    return F.zip_with(offsets, seq_ids, lambda o, s: F.when(s == 1, o))


def span_labels(df: DataFrame, question: str, ctx: str, answer_start: str, answer_end: str) -> DataFrame:
    """Add ``start_position`` and ``end_position``; (0, 0) where the window does not hold the whole answer."""
    df = compute_once(df, question, ctx, answer_start, answer_end)
    base = F.size(question) + 2
    first, last = F.get(ctx, F.lit(0)), F.get(ctx, F.size(ctx) - 1)
    outside = F.coalesce((first["start"] > F.col(answer_start)) | (last["end"] < F.col(answer_end)), F.lit(True))
    starts = F.size(F.filter(ctx, lambda t: t["start"] <= F.col(answer_start)))
    ends = F.size(F.filter(ctx, lambda t: t["end"] >= F.col(answer_end)))
    return df.withColumn("start_position", F.when(outside, 0).otherwise(base + starts - 1)).withColumn(
        "end_position", F.when(outside, 0).otherwise(base + F.size(ctx) - ends))


def best_spans(features: DataFrame, n_best: int = 20, max_answer: int = 30) -> DataFrame:
    """example_id, best: the best admissible span of each feature that has one.

    At most n_best * n_best candidates are looked at inside the row; none leaves it.
    ``best`` orders by score, then earlier feature, start rank and end rank.
    """
    def ranked(logits: str) -> Column:
        tops = F.transform(topk_array(logits, n_best), lambda i, rank: F.struct(
            i.alias("at"), (-rank).alias("rank"), F.get(logits, i).cast("double").alias("logit"),
            F.get("offset_mapping", i).alias("span")))
        return F.filter(tops, lambda c: c["span"].isNotNull())

    fixed = compute_once(features, "start_logits", "end_logits", "offset_mapping")
    fixed = compute_once(fixed, _starts=ranked("start_logits"), _ends=ranked("end_logits"))

    def pair(s: Column, e: Column) -> Column:
        allowed = (e["at"] >= s["at"]) & (e["at"] - s["at"] + 1 <= max_answer)
        return F.when(allowed, F.struct(
            (s["logit"] + e["logit"]).alias("score"), (-F.col("feature_id")).alias("feature"), s["rank"].alias("srank"),
            e["rank"].alias("erank"), s["span"]["start"].alias("start"), e["span"]["end"].alias("end")))

    spans = F.flatten(F.transform("_starts", lambda s: F.transform("_ends", lambda e: pair(s, e))))
    best = F.array_max(F.filter(spans, lambda c: c.isNotNull()))
    return compute_once(fixed.select("example_id", best.alias("best")), "best").filter("best is not null")


def join_features_to_examples(examples: DataFrame, features: DataFrame, key: str = "example_id") -> DataFrame:
    """Every example with its features; examples without any stay."""
    return examples.join(features, key, "left")


def qa_nbest_span(examples: DataFrame, features: DataFrame, n_best: int = 20, max_answer: int = 30) -> DataFrame:
    """example_id, prediction_text, score: the best span over all features of each example.

    ``examples(example_id, context)``, ``features(feature_id, example_id, start_logits,
    end_logits, offset_mapping)``. The best span of each feature is found in its row,
    the best feature by a partial aggregate, and only then the context is joined.
    Ties go to the earlier feature, start rank and end rank; no span gives "".
    """
    best = best_spans(features, n_best, max_answer).groupBy("example_id").agg(F.max("best").alias("best"))
    joined = join_features_to_examples(examples, best)
    text = substring_by_offset("context", F.col("best.start"), F.col("best.end"))
    return joined.select("example_id", F.coalesce(text, F.lit("")).alias("prediction_text"),
                         F.col("best.score").alias("score"))
