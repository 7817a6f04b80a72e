"""Cuts in a row order, found without moving rows.

The value at a place of an order is found by counting: each pass counts the keys in at most ``FAN_OUT`` equal ranges
of the range that must hold it, and goes on inside one of them. The passes read the key column only, what reaches the
driver is bounded by ``FAN_OUT`` counts a cut, and afterwards rows are labelled or filtered where they are scanned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import hex_to_long, md5_key
from .ordering import shuffled_row_number

FAN_OUT = 1 << 14
DIGITS = 15  # hex digits of a digest in one key


@dataclass(frozen=True)
class Cut:
    """Rows with a key below ``key`` and ``taken`` of the ``tied`` rows at it lie before the cut."""

    key: int
    taken: int
    tied: int


def _narrowed(counts: list[tuple[int | None, int]], rank: int) -> tuple[int, int, int]:
    """The range that holds the rank, the rank inside it, and its rows."""
    for value, n in sorted(counts):
        if rank <= n:
            return value, rank, n
        rank -= n
    raise ValueError("the input changed between two passes over it")


def find_cuts(df: DataFrame, key: Column, places_of: Callable[[int], list[int]]) -> tuple[int, list[Cut | None]]:
    """The number of rows, and the cut behind each of the 1-based places that ``places_of`` names for that number.

    There is no cut where a place is below 1 or beyond all rows. ``key`` is a number; rows with a null key are no rows
    here. The input must give the same rows each time it is read.
    """
    keys = df.select(key.cast("bigint").alias("key")).filter("key IS NOT NULL")
    low, high, total = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    places = places_of(total)
    cuts: dict[int, Cut | None] = {p: None for p in places}
    shift = 0
    while total and (high >> shift) - (low >> shift) >= FAN_OUT:
        shift += 1
    # Place -> (range above the current shift, rank inside it); before the first pass all keys are one range.
    open_ = {p: (None, p) for p in cuts if 1 <= p <= total}
    above = None
    while open_:
        bucket = F.shiftright("key", shift)
        parent = F.lit(0) if above is None else F.shiftright("key", above)
        wanted = sorted({r for r, _ in open_.values() if r is not None})
        part = keys if above is None else keys.filter(parent.isin(wanted))
        counts: dict = {}
        for up, value, n in part.groupBy(parent.alias("up"), bucket.alias("value")).agg(F.count("*")).collect():
            counts.setdefault(None if above is None else up, []).append((value, n))
        sizes = {}
        for place, (up, rank) in open_.items():
            value, rank, n = _narrowed(counts.get(up, []), rank)
            open_[place], sizes[value] = (value, rank), n
            if shift == 0:
                cuts[place] = Cut(value, rank, n)
        if shift == 0:
            break
        # A range of few rows has few keys: count them one by one.
        above, shift = shift, 0 if max(sizes.values()) <= FAN_OUT else max(0, shift - FAN_OUT.bit_length() + 1)
    return total, [cuts[p] for p in places]


def _digest_key(id_col: str, seed: int) -> Column:
    return hex_to_long(md5_key(seed, id_col), DIGITS)


def label_by_digest(df: DataFrame, id_col: str, seed: int, parts: list[tuple[int, str]], cuts: list[Cut | None],
                    out: str) -> DataFrame:
    """The name of the first part that reaches a row's place, null behind all parts.

    ``parts`` are (place, name) by place, ``cuts`` what find_cuts gave for them; a part without a cut whose place is 1
    or more holds all rows that are left. Only rows that share the key at a cut, and are cut apart by it, get a rank.
    """
    key = _digest_key(id_col, seed)
    split = {c.key for c in cuts if c and c.taken < c.tied}

    def label(reaches) -> Column:
        found = F.lit(None).cast("string")
        for (place, name), cut in reversed(list(zip(parts, cuts))):
            if place >= 1:
                found = F.lit(name) if cut is None else F.when(reaches(cut), name).otherwise(found)
        return found

    plain = df.filter(~key.isin(*split)) if split else df
    plain = plain.withColumn(out, label(lambda c: key <= c.key))
    for value in sorted(split):
        tied = shuffled_row_number(df.filter(key == value), id_col, seed, out="_place")
        done = label(lambda c: F.lit(value < c.key) if value != c.key else F.col("_place") <= c.taken)
        plain = plain.unionByName(tied.withColumn(out, done).drop("_place"))
    return plain


def label_places(df: DataFrame, id_col: str, seed: int, parts_of: Callable[[int], list[tuple[int, str]]], out: str) -> DataFrame:
    """Labels rows by their place in the seeded order; ``parts_of`` gives the (place, name) parts for a number of rows.

    Ids name one row each; of an id that repeats at a cut, which copies lie before it is not defined, their number is.
    """
    parts: list[tuple[int, str]] = []

    def places(total: int) -> list[int]:
        parts.extend(parts_of(total))
        return [p if p < total else 0 for p, _ in parts]  # the last row needs no search

    _, cuts = find_cuts(df, _digest_key(id_col, seed), places)
    return label_by_digest(df, id_col, seed, parts, cuts, out)


def rows_between(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """Rows ``[start:stop]`` in the order of a column of distinct whole numbers without nulls."""
    _, (first, last) = find_cuts(df, F.col(key), lambda total: [start, stop if stop < total else 0])
    if stop <= start or start > 0 and first is None:
        return df.filter(F.lit(False))
    keep = F.lit(True) if first is None else F.col(key) > first.key
    return df.filter(keep if last is None else keep & (F.col(key) <= last.key))
