"""Near duplicates by circulant MinHash, banding and an exact check of every link.

A text's set is its distinct word shingles, hashed to 64 bits. One fixed permutation sends a shingle to a place on
a circle of ``CIRCLE`` places, a second permutation fills the circle with ranks, and coordinate k of the signature
is the smallest rank found when the places are turned by k. The k turns of a place are neighbours on the circle, so
all coordinates of a shingle are one slice, and a signature is the minimum over slices.

Texts with equal sets form a class; only one of each goes on. Bands of coordinates give buckets. A bucket is never
expanded into all its pairs: its members are compared with the first of them, links are closed to components, and
only members outside the bucket's first component then meet members of other components, ``CENTRES`` a turn. Such a
pair is compared only if an exact bound allows a link: a bitmap marks the hash ranges a text has shingles in, and each
range that only one of two texts has is a shingle that they do not share. Every pair that shares a bucket is thus compared, out of reach,
or already in one component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import text_slices
from .components import connected_components

SHINGLE = 5
CIRCLE = 1 << 20
MISS = 1e-6
COORDINATES = 384
SEED = 20_260
BLOCK = 1024
ROWS, TEXT_BYTES = 1_000, 1 << 20  # texts and bytes of text turned to Python objects together
BROADCAST_IDS = 500_000
CENTRES = 256
WORDS = 16  # of 64 bits in the bitmap of a set
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_S27, _S31, _S44, _S54 = np.uint64(27), np.uint64(31), np.uint64(44), np.uint64(54)


def banding(threshold: float, miss: float = MISS, coordinates: int = COORDINATES) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold with probability ``miss`` at most."""
    best = (max(1, math.ceil(math.log(miss) / math.log(max(1e-12, 1 - threshold)))), 1) if threshold < 1 else (1, 1)
    for rows in range(1, coordinates + 1):
        share = threshold ** rows
        bands = 1 if share >= 1 else math.ceil(math.log(miss) / math.log1p(-share)) if share > 1e-12 else coordinates + 1
        if rows * bands <= coordinates:
            best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S31)) * _MIX
    x = (x ^ (x >> _S27)) * _ODD
    return x ^ (x >> _S31)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashed shingles in ascending order: runs of ``size`` words, or all words if there are fewer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, n)
    width = min(size, n)
    hashed = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        hashed = _mixed(hashed * _ODD + one[k:n - width + 1 + k])
    return np.unique(hashed)


@lru_cache(maxsize=2)
def _ranks(coordinates: int) -> np.ndarray:
    """Row p: the ranks at places p, p+1, .. of the circle, as a view without copies."""
    ring = np.random.Generator(np.random.PCG64(SEED)).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:coordinates]]), coordinates)


def signature(items: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set."""
    places = (items * _ODD) >> _S44  # the first permutation, cut to the circle
    ranks = _ranks(coordinates)
    out = np.full(coordinates, CIRCLE, np.uint32)
    for at in range(0, len(places), BLOCK):
        np.minimum(out, ranks[places[at:at + BLOCK]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sig.reshape(bands, rows).T:
        keys = _mixed(keys * _ODD + column.astype(np.uint64))
    return keys.view(np.int64)


def bitmap(items: np.ndarray) -> np.ndarray:
    """Which of 64 * WORDS ranges of the hash the set has an element in."""
    has = np.zeros(64 * WORDS, bool)
    has[items >> _S54] = True
    return np.packbits(has).view(np.int64)


def _sign(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_slices(whole, [1], ROWS, TEXT_BYTES)):
            counts, digests, keys, bits = [], [], [], []
            for text in batch.column(1).to_pylist():
                items = shingles(text, size)
                counts.append(len(items))
                digests.append(xxhash.xxh3_128_hexdigest(items.tobytes()) if len(items) else None)
                bits.append(bitmap(items))
                keys.append(band_keys(signature(items, bands * rows), bands, rows) if len(items) else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, keys)])
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *keys]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                 pa.ListArray.from_arrays(pa.array(range(0, WORDS * len(bits) + 1, WORDS), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *bits])))],
                ["doc_id", "n_shingles", "digest", "keys", "bits"])

    return run


def _compare(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.empty(0, np.uint64)
        for batch in (part for whole in batches for part in text_slices(whole, [2, 3], ROWS, TEXT_BYTES)):
            common, union = [], []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if b != last:
                    last, kept = b, shingles(b, size)
                own = shingles(a, size)
                both = len(np.intersect1d(own, kept, assume_unique=True))
                common.append(both)
                union.append(len(own) + len(kept) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "common", "union"])

    return run


def _next_pairs(buckets: DataFrame, bits: DataFrame, labels: DataFrame | None, turn: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs to compare, what is left of the buckets).

    The first turn takes the smallest id of a bucket as its centre; each later one about ``CENTRES`` members outside
    the smallest component, chosen by hash. Buckets whose members share a component are done.
    """
    placed = buckets.withColumn("comp", F.col("id")) if labels is None else buckets.join(labels, buckets["id"] == labels["node"], "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("comp"))
    stats = placed.groupBy("key").agg(F.min("id").alias("first"), F.max("comp").alias("hi"), F.min("comp").alias("lo"))
    mixed = placed.join(stats.filter("lo <> hi"), "key")
    if turn == 0:
        mixed = cut_lineage(mixed.select("key", "id", "n", "comp", (F.col("id") == F.col("first")).alias("centre")))
        reach = F.least("n", "nb")
    else:
        mixed = cut_lineage(mixed.select("key", "id", "n", "comp", (F.col("comp") != F.col("lo")).alias("other")))
        sizes = mixed.filter("other").groupBy("key").agg(F.ceil(F.count("*") / CENTRES).alias("share"))
        mixed = mixed.join(sizes, "key").join(bits, "id")
        mixed = cut_lineage(mixed.withColumn("centre", F.col("other") & (F.pmod(F.xxhash64("id", F.lit(turn)), F.col("share")) == 0)))
        apart = [F.bit_count(F.get("bits", F.lit(i)).bitwiseAND(F.bitwise_not(F.get("bitsb", F.lit(i))))) for i in range(WORDS)]
        reach = F.col("n") - reduce(lambda a, x: a + x, apart)
    own = ["key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("compb")] + ([F.col("bits").alias("bitsb")] if turn else [])
    pairs = mixed.join(mixed.filter("centre").select(*own), "key").filter("comp <> compb AND (id > b OR NOT centre)")
    pairs = pairs.filter(100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")).filter((100 + percent) * reach >= percent * (F.col("n") + F.col("nb")))
    return pairs.select(F.col("id").alias("a"), "b").distinct(), mixed.filter("NOT centre").select("key", "id", "n")


def near_duplicate_components(df: DataFrame, percent: int = 80, size: int = SHINGLE, miss: float = MISS, coordinates: int = COORDINATES,
                              broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    Two texts are linked if 100 * common >= percent * union of their shingles. A text without words has no set and
    is linked with nothing; its component is its own id. ``component_id`` is the smallest id that links reach,
    ``kept`` says that it is the row's own. Rows with the same id count as one document, and so share ``kept``. A
    row with a null id is linked with nothing and kept, with a null component. An empty table gives an empty table.
    """
    bands, rows = banding(percent / 100, miss, coordinates)
    plain = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed = cut_lineage(plain.mapInArrow(_sign(bands, rows, size), "doc_id long, n_shingles long, digest string, keys array<long>, bits array<long>"))
    classes = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(classes)
    # One row per class; a repeated id takes its first text's set and any other set of its own.
    single = signed.filter("n_shingles > 0").join(classes, (signed["doc_id"] == classes["rep"]) & (signed["digest"] == classes["digest"]), "left_semi")
    banded = single.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("key")
    buckets = cut_lineage(banded.join(shared, "key", "left_semi").select("key", "id", "n"))
    ids = buckets.select("id").distinct()
    ids = cut_lineage(ids)
    side = F.broadcast(ids) if ids.count() <= broadcast_ids else ids
    texts = cut_lineage(plain.join(side, plain["doc_id"] == side["id"], "left_semi").select(F.col("doc_id").alias("id"), "text"))
    bits = cut_lineage(single.select(F.col("doc_id").alias("id"), "bits").join(side, "id", "left_semi").dropDuplicates(["id"]))
    links, labels, done, turn = None, None, None, 0
    while not buckets.isEmpty():
        fresh, buckets = _next_pairs(buckets, bits, labels, turn, percent)
        turn += 1
        if done is not None:
            fresh = fresh.join(done, ["a", "b"], "left_anti")
        fresh = cut_lineage(fresh)
        if fresh.isEmpty():
            continue
        left = fresh.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
        judged = both.mapInArrow(_compare(size), "a long, b long, common long, union long").filter(F.col("common") * 100 >= F.col("union") * percent)
        found = cut_lineage(judged.select("a", "b"))
        links = found if links is None else cut_lineage(links.union(found))
        done = fresh if done is None else cut_lineage(done.union(fresh))
        labels = cut_lineage(connected_components(links, "a", "b"))
    by_class = classes if labels is None else classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "digest", F.coalesce("component", "rep").alias("rep"))
    out = signed.drop("keys", "bits").join(by_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, percent: int = 80, **options) -> DataFrame:
    """One document of each component: the one with the smallest id. Rows with a null id stay."""
    judged = cut_lineage(near_duplicate_components(df, percent, **options).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct())
    return df.join(judged, df["doc_id"] == judged["_gone"], "left_anti")
