"""Token counts of texts in two tiers on the map side.

The lengths of frequent pre-tokens are broadcast as one compact table. Each worker looks pre-tokens up there; what
is missing is encoded by the tokenizers library once and kept in the worker's bounded cache. No pre-token is ever
shuffled: the table comes from a bounded sample of texts, and it changes speed only, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .byte_level import CACHED, PATTERN, Cache, load, spell
from .common import text_of, without

SAMPLE_TEXTS = 2_000
FREQUENT = 32_768
LIMIT = 1024
_CACHES: dict = {}


def frequent_lengths(df: DataFrame, path: str, text_col: str = "text", sample_texts: int = SAMPLE_TEXTS, frequent: int = FREQUENT) -> dict[str, int]:
    """Number of tokens of the ``frequent`` commonest pre-tokens of ``sample_texts`` texts: the first tier."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(PATTERN.findall(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    counted = df.select(text_col).limit(sample_texts).mapInArrow(count, "token string, n long")
    best = counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(frequent)
    model = load(path).model
    return {row["token"]: len(model.tokenize(spell(row["token"]))) for row in best.collect()}  # ``frequent`` rows at most


def count_tokens(df: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT, sample_texts: int = SAMPLE_TEXTS,
                 frequent: int = FREQUENT, cached: int = CACHED) -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    ``path`` names a byte-level vocabulary file of the tokenizers library, the same on every machine. Strings of its
    special tokens inside a text are one token each. A null text counts as empty: no bytes, no tokens. Columns of
    these names are replaced, all others stay; repeated rows stay repeated.
    """
    context = df.sparkSession.sparkContext
    table = context.broadcast(frequent_lengths(df, path, text_col, sample_texts, frequent))

    @F.arrow_udf("long")
    def lengths(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load(path)
        key = (path, table.id if hasattr(table, "id") else id(table), cached)
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = Cache(lambda token: len(tokenizer.model.tokenize(spell(token))), table.value, cached)
        get = _CACHES[key].__getitem__
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

        def count(text: str) -> int:
            n = sum(text.count(s) for s in specials)
            if n:
                for s in specials[1:]:
                    text = text.replace(s, specials[0])
                return n + sum(sum(map(get, PATTERN.findall(part))) for part in text.split(specials[0]))
            return sum(map(get, PATTERN.findall(text)))

        for part in parts:
            yield pa.array([count(text) if text else 0 for text in part.to_pylist()], pa.int64())

    counted = without(df, "n_bytes", "n_tokens", "over_limit").withColumns({
        "n_bytes": F.octet_length(text_of(text_col)).cast("long"), "n_tokens": lengths(F.col(text_col))})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
