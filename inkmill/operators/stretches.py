"""Unigram training on stretches of words: the parts between places that no token of two or more characters spans.

Every path of tokens passes through such a place, so the best path of a word is that of its stretches one after the
other, with and without a token. Distinct stretches are fewer and shorter than distinct words, and those of a smaller
vocabulary are stretches of those of a larger one. A single character has one path, if any, and is left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Bytes of words looked at together, and distinct stretches that a task sums before it hands them on.
BYTES_AT_ONCE, HELD_STRETCHES = 4_000_000, 200_000
# Bits of a code point.
POINT = 21


class Tokens:
    """Tokens of two or more characters as a tree: a state and the next code point give the next state."""

    def __init__(self, tokens: Iterable[str]):
        steps: dict[int, int] = {}
        last = {0: False}
        for token in tokens:
            if len(token) > 1:
                state = 0
                for char in token:
                    state = steps.setdefault(state << POINT | ord(char), len(steps) + 1)
                    last.setdefault(state, False)
                last[state] = True
        self.codes = np.array(sorted(steps), "int64")
        self.states = np.array([steps[c] for c in sorted(steps)], "int64")
        self.last = np.array([last[s] for s in range(len(last))], bool)

    def spanned(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a token spans the place before each character; ``ends`` says where the word of a character ends."""
        change = np.zeros(len(points) + 1, "int64")
        at, state, size = np.arange(len(points)), np.zeros(len(points), "int64"), 0
        while len(at) and len(self.codes):
            within = at + size < ends[at]
            at, state = at[within], state[within]
            code = state << POINT | points[at + size]
            step = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = self.codes[step] == code
            at, state, size = at[known], self.states[step[known]], size + 1
            found = at[self.last[state]]
            change[found + 1] += 1
            change[found + size] -= 1
        return np.cumsum(change[:-1]) > 0


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about BYTES_AT_ONCE together; a longer word stands alone."""
    start, ends = 0, np.cumsum(pc.binary_length(batch.column(0)).to_numpy())
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BYTES_AT_ONCE, side="right")))
        yield batch.slice(start, end - start)
        start = end


def stretch_sums(batches: Iterator[pa.RecordBatch], tokens: Tokens) -> Iterator[pa.RecordBatch]:
    """word, freq: the stretches of two or more characters of (word, freq), summed as far as they are held together."""
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["word", "freq"])

    sums: Counter[str] = Counter()
    for batch in batches:
        for part in _parts(batch):
            words = part.column(0).to_pylist()
            text = "".join(words)
            points = np.frombuffer(text.encode("utf-32-le"), "uint32").astype("int64")
            sizes = np.fromiter(map(len, words), "int64", len(words))
            starts = np.flatnonzero(~tokens.spanned(points, np.repeat(np.cumsum(sizes), sizes)))
            stops = np.append(starts[1:], len(points))
            freqs = np.repeat(part.column(1).to_numpy(), sizes)[starts]
            longer = stops - starts > 1
            for a, b, n in zip(starts[longer].tolist(), stops[longer].tolist(), freqs[longer].tolist()):
                sums[text[a:b]] += n
            if len(sums) > HELD_STRETCHES:
                yield rows()
                sums.clear()
    yield rows()


def stretches(words: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """word, freq: the distinct stretches of ``words(word, freq)`` under a vocabulary that holds every character."""
    shared = words.sparkSession.sparkContext.broadcast(Tokens(tokens))
    plain = words.select("word", F.col("freq").cast("long").alias("freq"))
    parts = plain.mapInArrow(lambda batches: stretch_sums(batches, shared.value), "word string, freq long")
    return parts.groupBy("word").agg(F.sum("freq").alias("freq"))
