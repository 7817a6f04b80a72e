"""Byte-pair training on words as lists of symbol ids: pairs and runs over the flat Arrow buffers of a task.

Rows are freq, rank and syms, a list of two or more ids from 1 on. What is done per word is done in arrays; only
distinct runs of a chunk are ever seen one by one, and only where their merged form is not known yet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .merging import apply_merges

SYMBOLS_AT_ONCE = 1_000_000


def pair_code(left, right):
    """Two ids as one number."""
    return (left << 32) | right


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their symbols, the bounds of each row) of batches put together up to SYMBOLS_AT_ONCE symbols; a larger one stands alone."""
    def joined():
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bounds = batch.column("syms").offsets.to_numpy().astype("int64")
        return batch, batch.column("syms").flatten().to_numpy(), bounds - bounds[0]

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            n = len(batch.column("syms").flatten())
            if held and size + n > SYMBOLS_AT_ONCE:
                yield joined()
                held, size = [], 0
            held.append(batch)
            size += n
    if held:
        yield joined()


def _codes(flat: np.ndarray) -> np.ndarray:
    return pair_code(flat[:-1].astype("int64"), flat[1:].astype("int64"))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values, as whole numbers."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values[order], starts)


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """code, freq: the pairs of neighbours, summed per chunk."""
    for batch, flat, bounds in _chunks(batches):
        within = np.ones(len(flat) - 1, bool)
        within[bounds[1:-1] - 1] = False
        freqs = np.repeat(batch.column("freq").to_numpy(), np.diff(bounds))[:-1]
        code, freq = _summed(_codes(flat)[within], freqs[within])
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(freq)], ["code", "freq"])


class _Cut:
    """Words cut wherever a pair stands that is not in ``frequent`` (sorted codes): runs of two or more symbols."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray, frequent: np.ndarray):
        joined = np.zeros(len(flat), bool)  # whether a symbol belongs to the run of the next one
        codes = _codes(flat)
        at = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
        joined[:-1] = frequent[at] == codes
        joined[bounds[1:] - 1] = False
        before = np.concatenate([[False], joined[:-1]])
        self.inside = joined | before
        self.begin = np.flatnonzero(joined & ~before)
        ends = np.concatenate([[0], np.cumsum(np.flatnonzero(before & ~joined) - self.begin + 1)]) * 4
        runs = pa.Array.from_buffers(pa.binary(), len(self.begin), [None, pa.py_buffer(ends.astype("int32")), pa.py_buffer(flat[self.inside].astype("int32"))])
        coded = runs.dictionary_encode()
        self.kind, self.runs = coded.indices.to_numpy(), coded.dictionary


def run_sums(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, stride: int) -> Iterator[pa.RecordBatch]:
    """syms (ids as bytes), freq, first: the distinct runs of a chunk, their frequency and first place."""
    for batch, flat, bounds in _chunks(batches):
        cut = _Cut(flat, bounds, frequent)
        row = np.searchsorted(bounds, cut.begin, side="right") - 1
        place = batch.column("rank").to_numpy()[row] * stride + cut.begin - bounds[row]
        freq, first = np.zeros(len(cut.runs), "int64"), np.full(len(cut.runs), np.iinfo("int64").max)
        np.add.at(freq, cut.kind, batch.column("freq").to_numpy()[row])
        np.minimum.at(first, cut.kind, place)
        yield pa.RecordBatch.from_arrays([cut.runs, pa.array(freq), pa.array(first)], ["syms", "freq", "first"])


class Merged:
    """The merged form of runs: of ``known`` ones (bytes) the lists at the same place, of others by the merges themselves."""

    def __init__(self, frequent: np.ndarray, ranks: dict[tuple[int, int], list[int]], tokens: list[int], known: pa.Array, lists: pa.Array):
        self.frequent, self.ranks, self.tokens, self.known, self.lists = frequent, ranks, tokens, known, lists

    def _of(self, runs: pa.Array) -> pa.Array:
        at = pc.index_in(runs, value_set=self.known)
        if not at.null_count:
            return self.lists.take(at)
        new = [apply_merges(np.frombuffer(r, "int32").tolist(), self.ranks, self.tokens) for r in runs.filter(at.is_null()).to_pylist()]
        place = at.to_numpy(zero_copy_only=False).copy()
        place[np.isnan(place)] = len(self.lists) + np.arange(len(new))
        return pa.concat_arrays([self.lists, pa.array(new, self.lists.type)]).take(pa.array(place.astype("int64")))

    def words(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words after the merges; words that are one symbol have no pair any more and are left out."""
        for batch, flat, bounds in _chunks(batches):
            cut = _Cut(flat, bounds, self.frequent)
            done = self._of(cut.runs)
            ends = done.offsets.to_numpy().astype("int64")
            # A unit is a run or a symbol outside of all runs.
            unit = ~cut.inside
            unit[cut.begin] = True
            number = np.cumsum(unit) - 1
            start = np.flatnonzero(unit)
            size, source = np.ones(len(start), "int64"), start.copy()
            size[number[cut.begin]] = np.diff(ends)[cut.kind]
            source[number[cut.begin]] = len(flat) + ends[:-1][cut.kind]
            out = np.concatenate([[0], np.cumsum(size)])
            values = np.concatenate([flat, done.values.to_numpy()])[np.repeat(source - out[:-1], size) + np.arange(out[-1])]
            bounds = out[np.concatenate([number[bounds[:-1]], [len(start)]])]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
            rows = pa.RecordBatch.from_arrays([batch.column("freq"), batch.column("rank"), lists], ["freq", "rank", "syms"])
            yield rows.filter(pa.array(np.diff(bounds) > 1))
