"""Rows kept as a list under one key of a JSON object that is a whole file, read in pieces by many tasks.

The text is cut at ``}``, so an item ends where a line does. How a piece begins (inside a string, how deep, in which
list, in whose item) follows from what all pieces before it hold: per piece the change of depth, for a beginning
outside and inside a string, is put together in file order. A second look at the few pieces that reach the outer
levels tells in which of them the list opens. Items are then cut out where they stand; only what is left at both
ends of a piece is shuffled, to the piece where its item began.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .quoted import by_piece

PIECE = "path string, start bigint, flips boolean, depth array<bigint>, least array<bigint>"
ITEM = "path string, owner bigint, start bigint, item string"
KEY = re.compile(rb'(?<!\\)("(?:[^"\\]|\\.)*")\s*:\s*$')
STEP_BYTES = 2 << 20
LIST_LEVEL = 2  # brackets that are open inside the list


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """(path, start) and text, some megabytes at a time or one line."""
    for key, lines in by_piece(batches):
        step = np.cumsum(pc.binary_length(lines).to_numpy(), dtype=np.int64) // STEP_BYTES
        cuts = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(lines)]):
            yield key, ("}".join(lines.slice(a, b - a).to_pylist()) + "}").encode()


def _quotes(chars: np.ndarray) -> np.ndarray:
    """Quotes that begin or end a string: those without an odd run of backslashes before them."""
    quote = chars == ord('"')
    slash = np.flatnonzero(chars == ord("\\"))
    if len(slash):
        begins = np.concatenate([[True], np.diff(slash) != 1])
        place = np.arange(len(slash)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        after = slash[place % 2 == 0] + 1
        quote[after[after < len(quote)]] = False
    return quote


def _steps(chars: np.ndarray, quote: np.ndarray, inside: bool) -> np.ndarray:
    """1 where a bracket opens outside strings, -1 where one closes, else 0."""
    opens = (chars == ord("{")) | (chars == ord("["))
    closes = (chars == ord("}")) | (chars == ord("]"))
    string = (np.cumsum(quote) + inside) % 2 == 1
    return np.where(string, 0, opens.astype(np.int64) - closes)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece, flips, depth, least = None, False, [0, 0], [0, 0]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"path": piece[0], "start": piece[1], "flips": flips, "depth": depth, "least": least}],
            pa.schema([("path", pa.string()), ("start", pa.int64()), ("flips", pa.bool_()), ("depth", pa.list_(pa.int64())),
                       ("least", pa.list_(pa.int64()))]))

    for key, raw in _text(batches):
        if key != piece:
            if piece is not None:
                yield row()
            piece, flips, depth, least = key, False, [0, 0], [0, 0]
        chars = np.frombuffer(raw, np.uint8)
        quote = _quotes(chars)
        for begin in (0, 1):
            levels = depth[begin] + np.cumsum(_steps(chars, quote, bool(begin) ^ flips))
            depth[begin], least[begin] = int(levels[-1]), min(least[begin], int(levels.min()))
        flips ^= bool(quote.sum() % 2)
    if piece is not None:
        yield row()


class _Begin:
    """How a piece begins."""

    def __init__(self, inside: bool, depth: int, owner: int, shallow: bool):
        self.inside, self.depth, self.owner, self.shallow, self.listed = inside, depth, owner, shallow, False


def _beginnings(pieces: list) -> dict[tuple[str, int], _Begin]:
    begins, path, inside, depth, owner = {}, None, False, 0, 0
    for p in sorted(pieces, key=lambda p: (p.path, p.start)):
        if p.path != path:
            path, inside, depth, owner = p.path, False, 0, 0
        least = depth + p.least[inside]
        begins[(p.path, p.start)] = _Begin(inside, depth, owner, least < LIST_LEVEL)
        if least <= LIST_LEVEL:
            owner = p.start
        inside, depth = inside != p.flips, depth + p.depth[inside]
    return begins


def _marks(raw: bytes, begin_inside: bool, begin_depth: int, field: str) -> tuple[list[tuple[int, str]], bool, int]:
    """Places where the wanted list opens (``list``), another value of the object does (``other``), an item begins or ends."""
    chars = np.frombuffer(raw, np.uint8)
    quote = _quotes(chars)
    step = _steps(chars, quote, begin_inside)
    depth = begin_depth + np.cumsum(step)
    brackets = np.flatnonzero((step != 0) & (depth <= LIST_LEVEL + 1))
    marks = []
    for at in brackets[((step[brackets] > 0) & (depth[brackets] >= LIST_LEVEL)) | ((step[brackets] < 0) & (depth[brackets] == LIST_LEVEL))]:
        level, char = int(depth[at]), chr(chars[at])
        if step[at] > 0 and level == LIST_LEVEL:
            before = np.searchsorted(brackets, at) - 1
            key = KEY.search(raw[brackets[before] + 1 if before >= 0 else 0:at])
            marks.append((int(at), "list" if char == "[" and key and json.loads(key.group(1)) == field else "other"))
        elif step[at] > 0 and char == "{":
            marks.append((int(at), "begin"))
        elif step[at] < 0:
            marks.append((int(at), "end" if char == "}" else "skip"))
    return marks, begin_inside != bool(quote.sum() % 2), int(depth[-1])


def _last_list(begins: dict, field: str):
    """Per piece, whether the last value that opens in it is the wanted list; no row without one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, inside, depth, found = None, False, 0, {}
        for key, raw in _text(batches):
            if key != piece:
                piece, inside, depth = key, begins[key].inside, begins[key].depth
            marks, inside, depth = _marks(raw, inside, depth, field)
            for _, kind in marks:
                if kind in ("list", "other"):
                    found[key] = kind == "list"
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found]), pa.array([k[1] for k in found], pa.int64()),
                                              pa.array(list(found.values()))], names=["path", "start", "listed"])

    return run


def _items(begins: dict, field: str, broken: bool):
    """Items that lie in one piece, or with ``broken`` the parts of all others (and of lists as items, without a first part)."""
    def rows(key: tuple[str, int], owner: int, items: list[bytes]) -> pa.RecordBatch:
        n = len(items)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(key[0], n), pa.repeat(pa.scalar(owner, pa.int64()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n),
             pa.array([i.decode() for i in items], pa.string())], names=["path", "owner", "start", "item"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, inside, depth, listed, rest, held = None, False, 0, False, False, []

        def left() -> Iterator[pa.RecordBatch]:
            if held and broken:
                yield rows(piece, begins[piece].owner if rest else piece[1], [b"".join(held)])

        for key, raw in _text(batches):
            if key != piece:
                yield from left()
                if key not in begins:
                    raise ValueError(f"{key[0]} was cut at other places in a later pass")
                begin = begins[key]
                piece, inside, depth, listed, held = key, begin.inside, begin.depth, begin.listed, []
                rest = listed and depth > LIST_LEVEL
            marks, inside, depth = _marks(raw, inside, depth, field)
            at, items = (0 if held or rest else None), []
            for place, kind in marks:
                if kind == "begin" and listed:
                    at = place
                elif kind == "end" and at is not None:
                    item = b"".join([*held, raw[at:place + 1]])
                    if rest and broken:
                        yield rows(key, begins[key].owner, [item])
                    elif not rest and not broken:
                        items.append(item)
                    at, rest, held = None, False, []
                elif kind == "skip":  # a list as an item
                    at, rest, held = None, False, []
                elif kind in ("list", "other"):
                    listed = kind == "list"
            if items:
                yield rows(key, key[1], items)
            if at is not None:
                held.append(raw[at:])
        yield from left()

    return run


def list_items(spark: SparkSession, path: str | list[str], field: str) -> DataFrame:
    """One row per object of the list under ``field``, in a column ``item``, as JSON text.

    Each file is one JSON object in UTF-8. Items that are no objects are left out, and so are lists of this name deeper
    in the file. If the key stands twice, both lists count. The passes that find out how pieces begin run when the
    function is called; the driver holds one row per piece. An item is one row, so it must fit in a task.
    """
    if "}" in field:
        raise ValueError("a key with } is not supported")
    lines = spark.read.option("lineSep", "}").text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    begins = _beginnings(lines.mapInArrow(_describe, PIECE).collect())
    shallow = spark.createDataFrame([k for k, b in begins.items() if b.shallow], "file_path string, file_block_start bigint")
    outer = lines.join(F.broadcast(shallow), ["file_path", "file_block_start"], "left_semi").select("file_path", "file_block_start", "value")
    last = {(r.path, r.start): r.listed for r in outer.mapInArrow(_last_list(begins, field), "path string, start bigint, listed boolean").collect()}
    listed, file = False, None
    for key in sorted(begins):
        listed = listed and key[0] == file
        begins[key].listed, file = listed, key[0]
        listed = last.get(key, listed)
    whole = lines.mapInArrow(_items(begins, field, broken=False), ITEM).select("item")
    parts = lines.mapInArrow(_items(begins, field, broken=True), ITEM).groupBy("path", "owner")
    joined = parts.agg(F.array_sort(F.collect_list(F.struct("start", "item"))).alias("_parts")).filter("_parts[0].start = owner")
    return whole.unionByName(joined.select(F.array_join("_parts.item", "").alias("item")))
