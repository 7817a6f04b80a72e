"""Two tokenizers side by side: which tokens cover the same bytes, and how often each pair of ids does so.

Both tokenizations of a text cover the same bytes. Between two neighbouring ends of tokens, of either side, lies one
stretch that belongs to one token of each side: one link. Where both sides end, a group ends. A batch of texts is
aligned at once, since both sides have the same number of bytes in each text.

Counting pairs of ids needs no shuffle of links. A first pass gathers the distinct pairs, and one task per shard of
them builds a minimal perfect hash: level by level, keys alone in their slot of a bit vector are placed, the others go
on. The number of a key is the number of set bits before its own, so keys of all shards share one dense range. Tasks
then count into dense vectors indexed by the hash, with the key of a slot verified, and the vectors are summed as a
tree of bounded fan-in. A second pass aligns the documents again and looks the counts up.

Vectors, hash and keys are sent to the tasks in rounds of whole shards, about ``ROUND_KEYS`` pairs each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .byte_level import BLANK, SPELLING, Encoder, Known, cut_at_spaces, gathered, in_text_order, load
from .common import text_slices

SHARD_KEYS = 1 << 14
ROUND_KEYS = 1 << 22
SLICE = 1 << 13  # counts of one row of a dense vector
FAN_IN = 16
CHUNK = 1 << 18
ROWS, TEXT_BYTES = 4_000, 3 << 20  # texts and bytes of text encoded before their ids leave the task
FAR_BLANKS = rf"\A |  | \z|{BLANK} {BLANK}"  # texts with words that may not stand alone
SPARE = 1.5  # slots per key of a level
CACHED = 100_000
KNOWN = 1 << 18  # words a worker keeps of each side
PIECED = 4_000  # words given to the piece model together
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


# Encoding.

@lru_cache(maxsize=2)
def _byte_side(path: str) -> tuple[Encoder, list[bytes]]:
    """The encoder of a byte-level vocabulary and the bytes of each id."""
    back = {c: b for b, c in SPELLING.items()}
    tokenizer = load(path)
    table = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return Encoder(path, CACHED, KNOWN), [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in table]


@lru_cache(maxsize=2)
def _piece_side(path: str) -> tuple[object, list[bytes], Known | None]:
    """The model, the bytes of each id, and a way to encode words by themselves if the model allows it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def own(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    def words(fresh: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(fresh), PIECED):
            coded = model.encode(fresh.slice(at, PIECED).to_pylist(), num_threads=1)
            lengths.append(np.fromiter(map(len, coded), np.int64, len(coded)))
            ids.append(np.fromiter(chain.from_iterable(coded), np.int32, int(lengths[-1].sum())))
        return np.concatenate(ids), np.concatenate(lengths)

    return model, [own(i) for i in range(model.get_piece_size())], Known(words, KNOWN) if _is_by_words(model) else None


def _is_by_words(model) -> bool:
    """Whether a word behind one space has the same pieces in any text: byte-pair merges, the text taken as it is, and
    no piece that goes on over a space behind another character."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # it needs protobuf
        return False
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    normal, trainer = proto.normalizer_spec, proto.trainer_spec
    plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces and not trainer.treat_whitespace_as_suffix
    return plain and trainer.model_type == trainer.BPE and not any("▁" in p.piece.lstrip("▁") for p in proto.pieces)


def _differs(want: list[bytes], ids: np.ndarray, lengths: np.ndarray, own: list[bytes]) -> np.ndarray:
    """Which words their ids do not give back."""
    out, spelled = np.zeros(len(want), bool), [own[i] for i in ids.tolist()]
    sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))])
    got, ends = b"".join(spelled), np.cumsum(lengths)
    ends_of_words = np.cumsum(np.fromiter(map(len, want), np.int64, len(want)))
    if np.array_equal(sizes[ends], ends_of_words) and got == b"".join(want):
        return out
    at = sizes[ends - lengths].tolist()
    out[:] = [got[a:b] != w for a, b, w in zip(at, sizes[ends].tolist(), want)]
    return out


def _width(n_ids: int) -> str:
    """How an id is kept: in two bytes where the vocabulary allows it."""
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def encode_both(df: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """doc_id, a and b: ids by a byte-level file of the tokenizers library and by a sentencepiece model, as little-endian
    numbers of two bytes, of four for vocabularies beyond 65,536.

    A's text is a space and the text, as B adds that space itself. Strings of special tokens are plain text. A text
    that is null or empty, or whose bytes either side does not give back, has no tokens.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (byte_level, bytes_a), (model, bytes_b, by_words) = _byte_side(path_a), _piece_side(path_b)

        def as_a_whole(text: str | None) -> tuple[np.ndarray, np.ndarray]:
            if text:
                want = (" " + text).encode("utf-8", "surrogatepass")
                ids_a, ids_b = np.frombuffer(byte_level.encode_plain(" " + text), "<i4"), model.encode(text, num_threads=1)
                if b"".join([bytes_a[i] for i in ids_a.tolist()]) == want == b"".join([bytes_b[i] for i in ids_b]):
                    return ids_a, np.array(ids_b, np.int32)
            return np.empty(0, np.int32), np.empty(0, np.int32)

        for batch in (part for all_ in batches for part in text_slices(all_, [1], ROWS, TEXT_BYTES)):
            texts = batch.column(1)
            whole = np.ones(len(texts), bool) if by_words is None else Encoder.uncut(texts, FAR_BLANKS)
            lists, pieces = cut_at_spaces(texts.filter(pa.array(~whole)))
            sides = [byte_level.spaced_ids(pieces.dictionary), by_words(pieces.dictionary)] if len(pieces) else [(np.empty(0, np.int32), np.empty(0, np.int64))] * 2
            index = pieces.indices.to_numpy()
            # A word that a side does not give back sends its texts through the plain way.
            want = [(" " + w).encode() for w in pieces.dictionary.to_pylist()]
            other = _differs(want, *sides[0], bytes_a) | _differs(want, *sides[1], bytes_b)
            if other.any():
                words = lists.value_lengths().to_numpy()
                again = np.add.reduceat(other[index], np.cumsum(words) - words) > 0
                lists, index = lists.filter(pa.array(~again)), index[np.repeat(~again, words)]
                whole[np.flatnonzero(~whole)[again]] = True
            rest = [as_a_whole(t) for t in texts.filter(pa.array(whole)).to_pylist()]
            order, ends = in_text_order(whole, lists, index, len(pieces.dictionary))
            columns = []
            for k, ((ids, lengths), own) in enumerate(zip(sides, (bytes_a, bytes_b))):
                others = [r[k] for r in rest]
                ids, to = gathered(np.concatenate([ids, *others]), np.concatenate([lengths, np.fromiter(map(len, others), np.int64, len(others))]), order)
                ids = ids.astype(_width(len(own)))
                offsets = np.concatenate([[0], np.concatenate([[0], to])[ends] * ids.itemsize])
                columns.append(pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "a", "b"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_col).mapInArrow(encode, "doc_id long, a binary, b binary")


# Alignment of a batch.

class Aligned:
    """Links of some documents: ``key`` (both ids in one number) of each, and per document the first link and so on."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.a, self.b, self.ends_a, self.ends_b = a, b, ends_a, ends_b
        at_a, at_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
        n = int(at_a[-1]) if len(at_a) else 0
        is_end = np.zeros((2, n + 1), bool)
        is_end[0, at_a], is_end[1, at_b] = True, True
        ends = np.flatnonzero(is_end[0] | is_end[1])
        self.of_a, self.of_b = is_end[0, ends], is_end[1, ends]
        self.link_a, self.link_b = np.cumsum(self.of_a) - self.of_a, np.cumsum(self.of_b) - self.of_b
        self.key = (a[self.link_a].astype(np.uint64) << _HALF) | b[self.link_b].astype(np.uint64)
        starts = np.concatenate([[0], at_a])[ends_a]  # bytes before the end of each document
        self.splits = np.searchsorted(ends, starts, "right")
        self.groups = np.cumsum(np.concatenate([[0], self.of_a & self.of_b]))

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a number per link."""
        return np.diff(np.concatenate([[0], np.cumsum(np.concatenate([[0], values]))[self.splits]]))

    def group_texts(self, names_a: tuple[np.ndarray, np.ndarray], names_b: tuple[np.ndarray, np.ndarray]) -> Iterator[str]:
        """`a1,a2|b1;a3|b2` of each document."""
        both = self.of_a & self.of_b
        closed = np.cumsum(both) - both  # the group of each link
        group_a, group_b = closed[self.of_a], closed[self.of_b]
        last_a, last_b = both[self.of_a], both[self.of_b]
        shown = np.concatenate([np.where(last_a, names_a[1][self.a], names_a[0][self.a]), np.where(last_b, names_b[1][self.b], names_b[0][self.b])])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown, ends = shown[order].tolist(), (self.ends_a + self.ends_b).tolist()
        for first, last in zip([0, *ends], ends):
            yield "".join(shown[first:last])[:-1]


def _ids(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids of a column, their number up to the end of each row)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(width) if at[-1] > at[0] else np.empty(0, width)
    return flat, (at[1:] - at[0]) // np.dtype(width).itemsize


def _chunks(batches: Iterator[pa.RecordBatch], sizes) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Runs of documents of about ``CHUNK`` ids of A, aligned; ``sizes`` are the bytes of each id, broadcast."""
    sizes_a, sizes_b = sizes.value
    for batch in batches:
        at_a, at_b = (batch.schema.get_field_index(c) for c in ("a", "b"))
        _, ends = _ids(batch.column(at_a), _width(len(sizes_a)))
        begin = 0
        for end in [*np.flatnonzero(np.diff(ends // CHUNK)) + 1, batch.num_rows]:
            if end > begin:
                part = batch.slice(begin, end - begin)
                a, ends_a = _ids(part.column(at_a), _width(len(sizes_a)))
                b, ends_b = _ids(part.column(at_b), _width(len(sizes_b)))
                yield part, Aligned(a, b, ends_a, ends_b, sizes_a, sizes_b)
            begin = end


# The minimal perfect hash.

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _ODD
    return x ^ (x >> np.uint64(31))


def _slots(keys: np.ndarray, level: int, slots) -> np.ndarray:
    """The slot of each key on a level, of ``slots`` (one number or one a key)."""
    return (((_mixed(keys * _ODD + np.uint64(level + 1)) >> _HALF) * np.asarray(slots, np.uint64)) >> _HALF).astype(np.int64)


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    return ((_mixed(keys ^ _MIX) & _LOW) * np.uint64(n_shards) >> _HALF).astype(np.int64)


def build_shard(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(slots of each level, all bits, keys in the order of their bits); every level is whole 64-bit words."""
    slots, bits, placed, left = [], [], [], np.unique(keys)
    while len(left):
        slots.append(64 * -(-int(SPARE * len(left)) // 64))
        at = _slots(left, len(slots) - 1, slots[-1])
        alone = np.bincount(at, minlength=slots[-1]) == 1
        bits.append(alone)
        placed.append(left[alone[at]][np.argsort(at[alone[at]])])
        left = left[~alone[at]]
    return slots, np.concatenate([np.empty(0, bool), *bits]), np.concatenate([np.empty(0, np.uint64), *placed])


class PerfectHash:
    """Numbers of keys among those of some shards; -1 for a key of other shards or none at all."""

    def __init__(self, rows: list[tuple[int, list[int], bytes, bytes]], n_shards: int):
        rows = sorted(rows, key=lambda r: r[0])
        self.n_shards, levels = n_shards, max((len(r[1]) for r in rows), default=0)
        self.slots, self.first = np.zeros((n_shards, levels), np.int64), np.zeros((n_shards, levels), np.int64)
        at = 0
        for shard, slots, _, _ in rows:
            for level, n in enumerate(slots):
                self.slots[shard, level], self.first[shard, level] = n, at
                at += n
        self.words = np.frombuffer(b"".join(r[2] for r in rows), "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.keys = np.frombuffer(b"".join(r[3] for r in rows), "<u8")

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out, shards, open_ = np.full(len(keys), -1, np.int64), shard_of(keys, self.n_shards), np.arange(len(keys))
        for level in range(self.slots.shape[1]):
            open_ = open_[self.slots[shards[open_], level] > 0]
            own = shards[open_]
            at = self.first[own, level] + _slots(keys[open_], level, self.slots[own, level])
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = self.before[at[hit] >> 6] + below
            open_ = open_[~hit]
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        out[~known] = -1
        return out


def _build(n_shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        slots, bits, keys = build_shard(pdf["key"].to_numpy().astype(np.int64).view(np.uint64))
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n": [len(keys)], "slots": [slots], "bits": [packed], "keys": [keys.astype("<u8").tobytes()]})

    return run


def pair_index(encoded: DataFrame, sizes, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """(shard, n, slots, bits, keys of each shard of the distinct pairs; number of shards)."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, links in _chunks(batches, sizes):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(links.key).view(np.int64))], ["key"])

    pairs = cut_lineage(encoded.select("a", "b").mapInArrow(distinct, "key long").distinct())
    n_shards = max(1, -(-pairs.count() // shard_keys))

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        return pa.array(shard_of(keys.to_numpy().view(np.uint64), n_shards), pa.int32())

    built = pairs.withColumn("shard", shard("key")).groupBy("shard").applyInPandas(_build(n_shards), "shard int, n long, slots array<int>, bits binary, keys binary")
    return cut_lineage(built), n_shards


def _tree_sum(slices: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """slice, counts (one row each) of the rows slice, part, counts: sums of at most ``fan_in`` vectors a group and step."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(c, "<i8") for c in pdf["counts"]))
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "part": [pdf["part"].iloc[0]], "counts": [total.tobytes()]})

    most = slices.agg(F.max("part")).first()[0] or 0
    while True:
        slices = slices.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("slice", "part").applyInPandas(add, "slice long, part long, counts binary")
        most //= fan_in
        if not most:
            return slices.select("slice", "counts")


def _count_round(encoded: DataFrame, rows: list, n_shards: int, sizes) -> np.ndarray:
    """How many links hold each pair of the round, in the order of the round's hash."""
    shared = encoded.sparkSession.sparkContext.broadcast(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = PerfectHash(shared.value, n_shards)
        dense = np.zeros(-(-len(known.keys) // SLICE) * SLICE, "<i8")
        for _, links in _chunks(batches, sizes):
            keys, n = np.unique(links.key, return_counts=True)
            at = known.numbers(keys)
            dense[at[at >= 0]] += n[at >= 0]
        used = [i for i in range(len(dense) // SLICE) if dense[i * SLICE:(i + 1) * SLICE].any()]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([part] * len(used), pa.int64()),
             pa.array([dense[i * SLICE:(i + 1) * SLICE].tobytes() for i in used], pa.binary())], ["slice", "part", "counts"])

    # Written before it is summed: the tree reads it once for the number of parts.
    vectors = cut_lineage(encoded.select("a", "b").mapInArrow(count, "slice long, part long, counts binary"))
    n_keys = sum(len(r[3]) // 8 for r in rows)
    out = np.zeros(-(-n_keys // SLICE) * SLICE, np.int64)
    for r in _tree_sum(vectors).collect():  # one vector as long as the round's keys
        out[r.slice * SLICE:(r.slice + 1) * SLICE] = np.frombuffer(r.counts, "<i8")
    shared.destroy()
    return out[:n_keys]


def _rounds(index: DataFrame, n_shards: int, round_shards: int) -> Iterator[list]:
    for first in range(0, n_shards, round_shards):
        rows = index.filter(F.col("shard").between(first, first + round_shards - 1)).select("shard", "slots", "bits", "keys").collect()  # bounded
        yield [(r[0], list(r[1]), bytes(r[2]), bytes(r[3])) for r in rows]


def align_tokens(df: DataFrame, path_a: str, path_b: str, text_col: str = "text", digest: bool = True, shard_keys: int = SHARD_KEYS,
                 round_keys: int = ROUND_KEYS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the groups of every row.

    Groups are `a1,a2|b1;a3|b2,b3`, as lowercase SHA-256 in ``groups_sha256``, or with ``digest`` off as text in
    ``groups``. A pair's count is the number of links of all rows that hold it; ``n_best`` links have the highest
    count of their B id. Null and empty texts and texts that a side does not give back have zeros and an empty string.
    Repeated rows count as often as they stand; null ids stay. An empty table gives an empty table.
    """
    spark = df.sparkSession
    sizes_a, sizes_b = (np.array([len(t) for t in side(path)[1]], np.int64) for side, path in ((_byte_side, path_a), (_piece_side, path_b)))
    sizes = spark.sparkContext.broadcast((sizes_a, sizes_b))
    encoded = cut_lineage(encode_both(df, path_a, path_b, text_col))
    index, n_shards = pair_index(encoded, sizes, shard_keys)
    round_shards = max(1, round_keys // shard_keys)
    best, counts = np.zeros(len(sizes_b), np.int64), []
    for rows in _rounds(index, n_shards, round_shards):
        own = _count_round(encoded, rows, n_shards, sizes)
        keys = PerfectHash(rows, n_shards).keys
        np.maximum.at(best, (keys & _LOW).astype(np.int64), own)
        counts.append(cut_lineage(spark.createDataFrame([(own.tobytes(),)], "counts binary")))
    state = encoded.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for turn, rows in enumerate(_rounds(index, n_shards, round_shards)):
        last = turn == len(counts) - 1
        shared = spark.sparkContext.broadcast((rows, counts[turn].first()[0], best))
        state = state.mapInArrow(_look_up(shared, n_shards, sizes, last, digest), _SHOWN[digest] if last else state.schema)
        if not last:
            state = cut_lineage(state)
            shared.destroy()
    return state


_SHOWN = {d: f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, {'groups_sha256' if d else 'groups'} string" for d in (True, False)}


def _look_up(shared, n_shards: int, sizes, last: bool, digest: bool):
    """Adds what the round's pairs give to n_best and count_sum; the last round also shows the groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts, best = shared.value
        known, counts = PerfectHash(rows, n_shards), np.frombuffer(counts, "<i8")
        names = [tuple(np.array([f"{i}{mark}" for i in range(len(own))], object) for mark in marks) for own, marks in zip(sizes.value, (",|", ",;"))] if last else []
        for part, links in _chunks(batches, sizes):
            keys, back = np.unique(links.key, return_inverse=True)
            at = known.numbers(keys)
            found = np.where(at >= 0, counts[at] if len(counts) else 0, 0)
            is_best = (at >= 0) & (found == best[(keys & _LOW).astype(np.int64)])
            sums = [part.column(i).to_numpy(zero_copy_only=False) + links.per_document(x[back].astype(np.int64)) for i, x in ((3, is_best), (4, found))]
            if not last:
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(3)], *map(pa.array, sums)], ["doc_id", "a", "b", "n_best", "count_sum"])
                continue
            texts = list(links.group_texts(*names))
            if digest:
                texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            n = [np.diff(np.concatenate([[0], e])) for e in (links.ends_a, links.ends_b)]
            groups = np.diff(np.concatenate([[0], links.groups[links.splits]]))
            n_links = np.diff(np.concatenate([[0], links.splits]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(np.asarray(x, np.int64)) for x in (*n, groups, n_links, *sums)], pa.array(texts, pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256" if digest else "groups"])

    return run
