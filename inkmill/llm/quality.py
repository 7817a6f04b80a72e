"""Word-level base rules and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into a fixed number of buckets. The raw multinomial counts every document; the
target multinomial counts the trusted ones, a bounded set of ids chosen by the hash of the id. A document's
score is the mean over its n-grams of log(p_target / p_raw), in millionths, so sums are exact whatever the order.
Both sides are smoothed by the same mass: a rare n-gram tells nothing, one that is common only in raw text counts
against the document. The mass is a number of n-grams of the target, whose sampling noise it damps; raw counts are
scaled to the target's size, so a corpus that grows around the same target keeps its weights. Mass and threshold
were set on held-out labelled documents of several corpus sizes, so that clean documents outside the target
stay above the threshold.

Nothing but bucket counts is shuffled. The weights, one number per bucket, are a constant of the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import compute_once
from .common import constant_array, keeps_columns, squeezed, text_of, without, words

BUCKETS = 1 << 16
TRUSTED = 20_000  # labelled rows that make up the target, at most
TARGET_MASS = 15.0  # smoothing, in n-grams of the target
THRESHOLD = -0.13
WINDOW = 5
MICRO = 1_000_000


def _bucket(n_buckets: int, *grams: Column) -> Column:
    return F.xxhash64(*grams).bitwiseAND(F.lit(n_buckets - 1).cast("long"))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """At most ``limit`` distinct ids of good, harmless documents, those with the smallest hash of the id."""
    good = labels.filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def bucket_weights(df: DataFrame, labels: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS, trusted: int = TRUSTED,
                   smoothing: float | None = None) -> list[int]:
    """log(p_target / p_raw) of each bucket in millionths; all 0 without trusted documents.

    ``smoothing`` is a mass in raw n-grams; by default that of ``TARGET_MASS`` n-grams of the target.
    """
    chosen = F.broadcast(trusted_ids(labels, trusted).withColumn("_trusted", F.lit(1)))
    marked = df.select("doc_id", F.col(text_col).alias("_text")).join(chosen, "doc_id", "left")
    split = compute_once(marked.select(F.coalesce("_trusted", F.lit(0)).alias("_t"), "_text"), _w=words(text_of("_text"))).drop("_text")
    pairs = F.transform(F.sequence(F.lit(0), F.size("_w") - 2), lambda i: _bucket(n_buckets, F.get("_w", i), F.get("_w", i + 1)))
    grams = F.concat(F.transform("_w", lambda w: _bucket(n_buckets, w)),
                     F.when(F.size("_w") >= 2, pairs).otherwise(F.array().cast("array<bigint>")))
    counts = split.select("_t", F.explode_outer(grams).alias("_b")).groupBy("_b").agg(F.count("_b").alias("raw"), F.sum("_t").alias("target"))
    raw, target = [0] * n_buckets, [0] * n_buckets
    for row in counts.filter("_b IS NOT NULL").collect():  # n_buckets rows at most
        raw[row["_b"]], target[row["_b"]] = row["raw"], row["target"]
    total, good = sum(raw), sum(target)
    if not good:
        return [0] * n_buckets
    mass = TARGET_MASS * total / good if smoothing is None else smoothing
    return [round(MICRO * math.log((t * total / good + mass) / (r + mass))) for r, t in zip(raw, target)]


def _covered(positions: str) -> Column:
    """Words under windows that start at these ascending positions."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, i + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


@keeps_columns("text_col")
def quality_rules(df: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, n_buckets: int = BUCKETS,
                  trusted: int = TRUSTED, smoothing: float | None = None) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept.

    A null or empty text has no words and fails. Columns of these names are replaced; all others stay, and so do
    repeated rows and null ids (which are never trusted). A score at the threshold is kept. Without trusted rows
    the score is 0, so the base rules alone decide. An empty table gives an empty table.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    weights = constant_array(bucket_weights(df, labels, text_col, n_buckets, trusted, smoothing), "int")
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda x: squeezed(x) != "")
    step = compute_once(
        without(df, *added), _w=words(text), _lines=lines, word_chars=F.length(squeezed(text)).cast("long"),
        n_symbols=F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
    n = F.size("_w")
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)]))
    weigh = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0).cast("long"),
        lambda a, i: a + F.get(weights, _bucket(n_buckets, F.get("_w", i)).cast("int"))
        + F.when(i + 1 < n, F.get(weights, _bucket(n_buckets, F.get("_w", i), F.get("_w", i + 1)).cast("int"))).otherwise(0))
    step = compute_once(
        step, n_words=n.cast("long"), n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        _sum=F.when(n > 0, weigh).otherwise(0),
        _h=F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))).drop("_w", "_lines")
    # Only texts with a repeated window sort their windows.
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    step = compute_once(step, _s=F.when(repeats, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_h")
    twice = F.filter("_s", lambda x, i: (F.get("_s", i - 1)["h"] == x["h"]) | (F.get("_s", i + 1)["h"] == x["h"]))
    step = compute_once(step, _p=F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("_s")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        step.withColumn("n_repeat_words", F.coalesce(_covered("_p"), F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("score", F.when(F.col("n_words") > 0, F.col("_sum") / (2 * F.col("n_words") - 1) / MICRO).otherwise(0.0))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .drop("_p", "_sum")
    )
