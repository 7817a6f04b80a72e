"""Records of delimited files whose quoted fields hold newlines, read in pieces by many tasks.

A line ends a record if an even number of quotes stands before its end. Two passes read the lines of each piece of a
file. The first returns, per piece, whether its number of quotes is odd and whether a record would end in it if it
began inside quotes. Put together in file order, these tell how each piece begins. The second pass joins lines to
records; only what is left at both ends of a piece is shuffled, to the piece where its record began. The rest of the
records do not move, so the lines are read once more for these ends instead of being written in between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

PIECE = "path string, start bigint, odd boolean, closes boolean"
RECORD = "path string, owner bigint, start bigint, first boolean, record string"
WHOLE, OPEN, REST = range(3)


def by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """(path, start) and lines, one piece of a file after the other; a piece may come in several steps."""
    for batch in batches:
        path, start, lines = batch.columns
        path, at = path.dictionary_encode(), start.to_numpy()
        file = path.indices.to_numpy()
        cuts = np.flatnonzero((at[1:] != at[:-1]) | (file[1:] != file[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(at)]):
            if b > a:
                yield (path.dictionary[int(file[a])].as_py(), int(at[a])), lines.slice(a, b - a)


def _parity(lines: pa.Array, odd: bool) -> np.ndarray:
    """Whether an odd number of quotes stands before the end of each line, counted from the given state."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    return (np.cumsum(quotes, dtype=np.int64) + odd) % 2 == 1


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece, odd, closes = None, False, False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([piece[0]]), pa.array([piece[1]], pa.int64()), pa.array([bool(odd)]), pa.array([bool(closes)])],
            names=["path", "start", "odd", "closes"])

    for key, lines in by_piece(batches):
        if key != piece:
            if piece is not None:
                yield row()
            piece, odd, closes = key, False, False
        state = _parity(lines, odd)
        odd, closes = state[-1], closes or state.any()
    if piece is not None:
        yield row()


def _beginnings(pieces: list) -> dict[tuple[str, int], int]:
    """The pieces that begin inside quotes, with the start of the piece where that record began."""
    inside, path, odd, owner = {}, None, False, 0
    for p in sorted(pieces, key=lambda p: (p.path, p.start)):
        if p.path != path:
            path, odd = p.path, False
        if odd:
            inside[(p.path, p.start)] = owner
        if not odd or p.closes:
            owner = p.start
        odd = odd != p.odd
    return inside


def _join_lines(known: set, inside: dict, broken: bool):
    """Whole records, or with ``broken`` what stands at both ends of a piece: a record that goes on, or the rest of one."""
    def rows(key: tuple[str, int], side: int, records: pa.Array, first: bool) -> pa.RecordBatch:
        n = len(records)
        owner = inside[key] if side == REST else key[1]
        return pa.RecordBatch.from_arrays(
            [pa.repeat(key[0], n), pa.repeat(pa.scalar(owner, pa.int64()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n),
             pa.array([first and key[1] == 0 and side != REST] + [False] * (n - 1)), records],
            names=["path", "owner", "start", "first", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, odd, side, held, first = None, False, WHOLE, [], True

        def rest() -> Iterator[pa.RecordBatch]:
            if held and broken:
                yield rows(piece, side or OPEN, pa.array(["\n".join(held)]), first)

        for key, lines in by_piece(batches):
            if key != piece:
                yield from rest()
                if key not in known:
                    raise ValueError(f"{key[0]} was cut at other places in the second pass")
                piece, odd, held, first = key, key in inside, [], True
                side = REST if odd else WHOLE
            state = _parity(lines, odd)
            odd, ends = bool(state[-1]), np.flatnonzero(~state) + 1
            if held or side == REST:  # a record that earlier lines began
                if not len(ends):
                    held += lines.to_pylist()
                    continue
                cut = int(ends[0])
                if broken == (side == REST):
                    yield rows(piece, side, pa.array(["\n".join(held + lines.slice(0, cut).to_pylist())]), first)
                first, side, held, lines, ends = first and side == REST, WHOLE, [], lines.slice(cut), ends[1:] - cut
            if len(ends):
                if not broken:
                    groups = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), lines.slice(0, int(ends[-1])))
                    yield rows(piece, WHOLE, pc.binary_join(groups, "\n"), first)
                first = False
            held = lines.slice(int(ends[-1]) if len(ends) else 0).to_pylist()
        yield from rest()

    return run


def quoted_records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """One row per record, in a column ``record``: its lines, joined by newlines, without the last line end.

    Quotes stand around whole fields, doubled inside them. Empty lines outside quotes are no records; with ``header``
    the first record of each file goes. A quote that is never closed makes one record of the rest of its file. The
    first pass runs when the function is called; its rows, one per piece, are held by the driver as the pieces are.
    Compressed files are one piece each. A record is one row, so it must fit in a task.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    pieces = lines.mapInArrow(_describe, PIECE).collect()
    known, inside = {(p.path, p.start) for p in pieces}, _beginnings(pieces)
    whole = lines.mapInArrow(_join_lines(known, inside, broken=False), RECORD).select("first", "record")
    ends = lines.mapInArrow(_join_lines(known, inside, broken=True), RECORD).groupBy("path", "owner").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "record"))).alias("_parts"))
    records = whole.unionByName(ends.select("first", F.array_join("_parts.record", "\n").alias("record")))
    if header:
        records = records.filter("not first")
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")
