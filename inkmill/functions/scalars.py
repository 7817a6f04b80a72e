"""Reproducible randomness and small numeric helpers."""

from __future__ import annotations

import math

try:
    from _md5 import md5  # half the time of OpenSSL's on short texts
except ImportError:
    from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType

ColumnOrName = Column | str

# Ignored by every loss and metric: the label of positions without a target.
IGNORE_LABEL = -100


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(seed: int | str, *cols: ColumnOrName) -> Column:
    """Hex digest of ``seed:col1:col2..``; a stable, uniformly spread sort key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))


def hex_to_long(digest: Column, digits: int = 8) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def uniform(seed: int | str, *cols: ColumnOrName) -> Column:
    """A number in [0, 1) that depends only on the seed and the key columns."""
    return hex_to_long(md5_key(seed, *cols)).cast("double") / F.lit(4294967296.0)


def row_draws(prefix: str, count: int) -> np.ndarray:
    """``uniform`` for one key, given as ``seed:col1:col2..``, and the numbers 0 to count - 1 behind it."""
    text = f"{prefix}:".encode().replace(b"%", b"%%") + b"%d"
    digests = b"".join([md5(text % i).digest() for i in range(count)])
    return np.frombuffer(digests, ">u4")[::4] / 4294967296.0


# Digests made together: the arrays of one step stay in the cache. Keys and numbers laid out together.
LANES, KEYS_AT_ONCE = 32_768, 131_072
_SHIFTS = [(np.uint32(s), np.uint32(32 - s)) for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_PLACES = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]


def _first_words(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The first 32 bits of the MD5 digests of messages of one block: a row of ``words`` per word of it, ``bits`` the lengths; the other words are 0."""
    n, used = len(bits), len(words)
    a, b, c, d = (np.full(n, x, "uint32") for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, g = np.empty(n, "uint32"), np.empty(n, "uint32")
    for i in range(64):
        kind, place = i // 16, _PLACES[i]
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, _SINES[i], out=f)
        if place == 14:
            np.add(f, bits, out=f)
        elif place < used:
            np.add(f, words[place], out=f)
        left, right = _SHIFTS[i]
        np.left_shift(f, left, out=g)
        np.right_shift(f, right, out=f)
        np.bitwise_or(f, g, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    return a + np.uint32(0x67452301)


def many_draws(prefixes: list[str], counts: list[int]) -> np.ndarray:
    """``row_draws`` of many keys one after the other. Digests of short keys are made in arrays, all of a step at once."""
    sizes = np.array(counts, "int64")
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    heads = [f"{p}:".encode() for p in prefixes]
    values = np.empty(bounds[-1])
    last = int(sizes.max(initial=0)) - 1
    short = np.array([len(h) + len(str(last)) < 56 for h in heads], bool)
    for k in np.flatnonzero(~short):
        values[bounds[k]:bounds[k + 1]] = row_draws(prefixes[k], counts[k])
    rows = np.flatnonzero(short & (sizes > 0))
    if not len(rows):
        return values
    lengths = np.array([len(heads[k]) for k in rows], "int64")
    width = (int(lengths.max()) + len(str(last)) + 4) // 4 * 4  # a byte behind the number marks the end
    table = np.frombuffer(b"".join(heads[k].ljust(width, b"\0") for k in rows), "uint8").reshape(len(rows), width)
    ends = np.cumsum(sizes[rows])
    starts = ends - sizes[rows]
    for low in range(0, int(ends[-1]), KEYS_AT_ONCE):
        at = np.arange(low, min(low + KEYS_AT_ONCE, int(ends[-1])))
        near = np.arange(np.searchsorted(ends, at[0], side="right"), np.searchsorted(ends, at[-1], side="right") + 1)
        row = np.repeat(near, np.minimum(ends[near], at[-1] + 1) - np.maximum(starts[near], low))
        number = at - starts[row]
        block, size = table[row], lengths[row] + 1
        for k in range(1, len(str(last))):
            size += number >= 10 ** k
        flat, stop = block.reshape(-1), (at - low) * width + size
        flat[stop] = 0x80
        rest, here = number.astype("uint32"), stop - 1
        for k in range(len(str(last))):
            flat[here] = rest % 10 + 48
            more = rest > 9
            rest, here = rest[more] // 10, here[more] - 1
        words = np.ascontiguousarray(block.view("<u4").T)
        bits = (size * 8).astype("uint32")
        first = np.concatenate([_first_words(words[:, i:i + LANES], bits[i:i + LANES]) for i in range(0, len(at), LANES)])
        values[bounds[rows][row] + number] = first.byteswap() / 4294967296.0
    return values


def draw_lists(prefixes: pa.Array, counts: pa.Array, numbers) -> pa.Array:
    """A list per row of ``numbers(prefixes, counts)``; null without a count."""
    sizes = [n or 0 for n in counts.to_pylist()]
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(numbers(prefixes.to_pylist(), sizes)), mask=counts.is_null())


@F.arrow_udf(ArrayType(DoubleType()))
def _draw_arrays(prefixes: pa.Array, counts: pa.Array) -> pa.Array:
    return draw_lists(prefixes, counts, many_draws)


def draw_prefix(seed: int | str, *cols: ColumnOrName) -> Column:
    """What stands before the number in the key of a draw."""
    return F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols])


def uniform_array(count: Column, seed: int | str, *cols: ColumnOrName) -> Column:
    """``uniform(seed, *cols, i)`` for i from 0 to count - 1; null without a count."""
    return _draw_arrays(draw_prefix(seed, *cols), count.cast("int"))


def neg_log_prob(freq: ColumnOrName, total: ColumnOrName) -> Column:
    return -F.log(_col(freq).cast("double") / _col(total).cast("double"))


def round_pct(value: ColumnOrName, digits: int = 2) -> Column:
    """Share as a percentage, rounded half to even."""
    return F.bround(_col(value).cast("double") * 100, digits)


def perplexity(loss: ColumnOrName) -> Column:
    """Aggregate: exp of the mean loss."""
    return F.exp(F.avg(_col(loss)))


def token_perplexity(total_loss: ColumnOrName, n_tokens: ColumnOrName) -> Column:
    """Aggregate: exp of the token-weighted mean loss."""
    return F.exp(F.sum(_col(total_loss)) / F.sum(_col(n_tokens)))
