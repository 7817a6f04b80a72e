"""Column functions on arrays: logits, token ids, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .once import compute_once
from .scalars import IGNORE_LABEL, ColumnOrName, _col


def as_doubles(values: ColumnOrName) -> Column:
    return F.transform(_col(values), lambda x: x.cast("double"))


def softmax(logits: ColumnOrName) -> Column:
    """Softmax, shifted by the maximum. Maximum and sum enter as arrays, so they are computed once."""
    x = as_doubles(logits)
    n = F.size(_col(logits))
    powers = F.zip_with(x, F.array_repeat(F.array_max(x), n), lambda v, peak: F.exp(v - peak))
    mass = F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v)
    return F.zip_with(powers, F.array_repeat(mass, n), lambda v, m: v / m)


def argmax_array(values: ColumnOrName) -> Column:
    """0-based index of the largest element, the first on ties."""
    values = _col(values)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def topk_array(values: ColumnOrName, k: int) -> Column:
    """0-based indexes of the k largest elements, largest first, ties to the lower index."""
    ranked = F.sort_array(F.transform(_col(values), lambda x, i: F.struct((-x).alias("neg"), i.alias("idx"))))
    return F.transform(F.slice(ranked, 1, k), lambda s: s["idx"])


def chunk_fixed(values: ColumnOrName, n: int) -> Column:
    """Pieces of n elements; the last may be short and an empty array has none.

    ``values`` should be a stored column or one fixed by compute_once.
    """
    values = _col(values)
    n_chunks = F.ceil(F.size(values) / F.lit(n)).cast("int")
    starts = F.when(n_chunks > 0, F.sequence(F.lit(0), n_chunks - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(values, i * n + 1, n))


def repeat_to(value: Column, count: Column) -> Column:
    return F.array_repeat(value, F.greatest(count.cast("int"), F.lit(0)))


def pad_array(values: ColumnOrName, width: ColumnOrName, pad: int) -> Column:
    """Fill up with ``pad`` to the width; longer arrays are left as they are."""
    values = _col(values)
    return F.concat(values, repeat_to(F.lit(pad).cast("int"), _col(width) - F.size(values)))


def attention_mask(values: ColumnOrName, width: ColumnOrName) -> Column:
    """1 for each token, 0 for each pad."""
    size = F.size(_col(values))
    return F.concat(F.array_repeat(F.lit(1), size), repeat_to(F.lit(0), _col(width) - size))


def truncate(ids: ColumnOrName, max_length: int, n_special: int = 2) -> Column:
    """Keep what leaves room for the special tokens."""
    return F.slice(_col(ids), 1, max(max_length - n_special, 0))


def truncate_pair_longest(a: ColumnOrName, b: ColumnOrName, max_length: int, n_special: int = 3) -> tuple[Column, Column]:
    """Take tokens off the longer side until both fit.

    Taking one token at a time from the longer array (from the second on a tie)
    ends at sizes that have a closed form.
    """
    a, b = _col(a), _col(b)
    room = max(max_length - n_special, 0)
    na, nb = F.size(a), F.size(b)
    first, second = F.lit(room - room // 2), F.lit(room // 2)
    fits = na + nb <= room
    keep_a = F.when(fits | (na <= first), na).when(nb <= second, room - nb).otherwise(first)
    keep_b = F.when(fits | (nb <= second), nb).when(na <= first, room - na).otherwise(second)
    return F.slice(a, F.lit(1), keep_a), F.slice(b, F.lit(1), keep_b)


def template_single(a: ColumnOrName, cls: Column, sep: Column) -> Column:
    return F.concat(F.array(cls), _col(a), F.array(sep))


def template_pair(a: ColumnOrName, b: ColumnOrName, cls: Column, sep: Column) -> Column:
    return F.concat(F.array(cls), _col(a), F.array(sep), _col(b), F.array(sep))


def pair_type_ids(a: ColumnOrName, b: ColumnOrName) -> Column:
    """0 for the first sequence with its two special tokens, 1 for the second with its one."""
    return F.concat(F.array_repeat(F.lit(0), F.size(_col(a)) + 2), F.array_repeat(F.lit(1), F.size(_col(b)) + 1))


def align_labels(df: DataFrame, word_ids: str, labels: str, out: str) -> DataFrame:
    """Add ``out``: word labels spread over sub-tokens.

    Positions without a word are ignored; a further piece of the same word turns
    an odd (B-) label into the following even (I-) one.
    """
    fixed = compute_once(df, word_ids, labels)

    def label(w, i):
        own = F.get(labels, w)
        continues = (i > 0) & w.eqNullSafe(F.get(word_ids, i - 1))
        return F.when(w.isNull(), F.lit(IGNORE_LABEL)).when(continues, own + own % 2).otherwise(own)

    return fixed.withColumn(out, F.transform(word_ids, label))


def clm_labels(ids: ColumnOrName, pad_id: int) -> Column:
    """Causal labels: the inputs, with pads ignored (the model does the shift)."""
    return F.transform(_col(ids), lambda x: F.when(x == pad_id, F.lit(IGNORE_LABEL)).otherwise(x))


def shift_right(labels: ColumnOrName, start_id: int, pad_id: int) -> Column:
    """Decoder inputs: start token, then the labels without the last, ignored ones as pads."""
    labels = _col(labels)
    body = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))
    shifted = F.when(F.size(labels) > 0, F.concat(F.array(F.lit(start_id)), body)).otherwise(labels)
    return F.transform(shifted, lambda x: F.when(x == IGNORE_LABEL, F.lit(pad_id)).otherwise(x))


def unignore(labels: ColumnOrName, pad_id: int) -> Column:
    """Ignored labels back to the pad id, so that they can be decoded."""
    return F.transform(_col(labels), lambda x: F.when(x == IGNORE_LABEL, F.lit(pad_id)).otherwise(x))


def invert_map(mapping: Column) -> Column:
    return F.map_from_entries(F.transform(F.map_entries(mapping), lambda e: F.struct(e["value"], e["key"])))


def entity_spans(tags: ColumnOrName) -> Column:
    """Spans (type, start, end inclusive) of a tag sequence such as B-PER I-PER O.

    A span opens at B-x, and at I-x after O or another type. Each position is laid
    beside its neighbours, opening and closing positions are filtered out and paired in
    order: linear, and inside the row.
    """
    tags = _col(tags)
    n, outside = F.size(tags), F.array(F.lit("O"))
    before = F.concat(outside, F.slice(tags, F.lit(1), F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice(tags, F.lit(2), F.greatest(n - 1, F.lit(0))), outside)

    def kind(t):
        return F.substring(t, 3, 1 << 20)

    def opens(here, previous):
        follows = (previous != "O") & (kind(previous) == kind(here))
        return (here != "O") & (here.startswith("B-") | ~follows)

    beside = F.zip_with(F.zip_with(before, tags, lambda b, t: F.struct(b.alias("b"), t.alias("t"))), after,
                        lambda z, a: F.struct(z["b"].alias("b"), z["t"].alias("t"), a.alias("a")))
    marks = F.transform(beside, lambda z, i: F.struct(
        kind(z["t"]).alias("type"), i.alias("at"), opens(z["t"], z["b"]).alias("first"),
        ((z["t"] != "O") & ((z["a"] == "O") | opens(z["a"], z["t"]))).alias("last")))
    return F.zip_with(
        F.filter(marks, lambda m: m["first"]), F.filter(marks, lambda m: m["last"]),
        lambda s, e: F.struct(s["type"].alias("type"), s["at"].alias("start"), e["at"].alias("end")))


def ngrams(tokens: ColumnOrName, n: int) -> Column:
    """Space-joined n-grams in order: n shifted copies laid side by side."""
    tokens = _col(tokens)
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), count)
    for shift in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(tokens, F.lit(shift), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams
