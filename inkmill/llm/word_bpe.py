"""Byte-pair encoding of lower-cased words with word ends, and decoding.

A word starts as its bytes, the last one marked as a word end. A contiguous array holds the parts, a second one the
rank of each adjacent pair. While some pair has a rank, the smallest one (leftmost among equals) is merged: one
boundary goes, and the ranks on both sides of the new part are looked up again. Words of more than ``SHORT`` parts
use a heap over linked parts, with the same result in n log n. Encoded words stay in the worker's bounded cache.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .byte_level import SPELLING, Cache, spell
from .common import keeps_columns, without

SHORT = 64
CACHED = 120_000
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
NONE = 1 << 30
SHIFT = 20


def lower(text: str) -> str:
    """Composed and lower-cased, each character by itself (no final sigma)."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class WordBpe:
    def __init__(self, path: str, cached: int = CACHED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.token_of = {i: t for t, i in self.vocab.items()}
        self.ranks: dict[int, int] = {}  # left << SHIFT | right
        self.merged: list[int] = []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.ranks[self.vocab[left] << SHIFT | self.vocab[right]] = len(self.merged)
            self.merged.append(self.vocab[left + right])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of.update({i: t for t, i in self.specials.items()})
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.bytes_of = {i: i.to_bytes(4, "little") for i in self.token_of}
        self.bytes = {t: self.vocab[t] for t in SPELLING.values()}
        self.ends = {t: self.vocab[t + self.suffix] for t in SPELLING.values()}
        self.words = Cache(self._word, limit=cached)
        self.runs = Cache(self._run, limit=cached)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank, merged = self.ranks.get, self.merged
        near = [rank(a << SHIFT | b, NONE) for a, b in zip(parts, parts[1:])]
        while near:
            best = min(near)
            if best == NONE:
                break
            i = near.index(best)
            parts[i] = part = merged[best]
            del parts[i + 1], near[i]
            if i < len(near):
                near[i] = rank(part << SHIFT | parts[i + 1], NONE)
            if i:
                near[i - 1] = rank(parts[i - 1] << SHIFT | part, NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, n = self.ranks.get, len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] << SHIFT | parts[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = self.merged[r], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank(parts[k] << SHIFT | parts[after[k]], NONE)) != NONE:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p, a in zip(parts, alive) if a]

    def encode_word(self, word: str) -> list[int]:
        spelled = word if word.isalpha() and word.isascii() else spell(word)
        parts = list(map(self.bytes.__getitem__, spelled))
        parts[-1] = self.ends[spelled[-1]]
        return self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)

    def _word(self, word: str) -> tuple[bytes, str]:
        ids = self.encode_word(word)
        return b"".join(map(self.bytes_of.__getitem__, ids)), " ".join(map(self.token_of.__getitem__, ids))

    def _run(self, run: str) -> tuple[bytes, str]:
        """A stretch between blanks; no word reaches over a blank."""
        parts = list(map(self.words.__getitem__, WORD.findall(run)))
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        return list(map(self.runs.__getitem__, lower(text).replace("\n", " ").split(" ")))

    def _parts(self, text: str) -> list[tuple[bytes, str]]:
        if self.split is None or not any(s in text for s in self.specials):
            return self._plain(text)
        out = []
        for part in self.split.split(text):
            out.extend([(self.specials[part].to_bytes(4, "little"), part)] if part in self.specials else self._plain(part))
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join([p[0] for p in self._parts(text or "")])

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a space between them; special tokens are kept."""
        return " ".join([self.token_of[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def round_trip(self, text: str | None) -> tuple[bytes, str]:
        """Ids, and their decoded text; a stretch is decoded once, when it enters the cache."""
        parts = self._parts(text or "")
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[1]])


@lru_cache(maxsize=2)
def word_bpe(path: str, cached: int = CACHED) -> WordBpe:
    return WordBpe(path, cached)


RESULT = "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>"


@keeps_columns("text_col")
def encode_and_decode(df: DataFrame, path: str, text_col: str = "text", keep_ids: bool = False, cached: int = CACHED) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256, with ``keep_ids`` also ``ids`` and ``decoded``.

    ``path`` names the vocabulary file, the same on every machine. A null or empty text has no ids and decodes to an
    empty text. Columns of these names are replaced, all others stay; repeated rows stay repeated.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                      *([("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if keep_ids else [])])

    @F.arrow_udf(RESULT[:-1] + (",ids:array<int>,decoded:string>" if keep_ids else ">"))
    def code(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = word_bpe(path, cached)
        for part in parts:
            rows = []
            for text in part.to_pylist():
                ids, decoded = own.round_trip(text)
                row = {"n_tokens": len(ids) // 4, "ids_sha256": sha256(ids).hexdigest(), "decoded_sha256": sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()}
                if keep_ids:
                    row |= {"ids": np.frombuffer(ids, "<i4"), "decoded": decoded}
                rows.append(row)
            yield pa.array(rows, kind)

    names = [f.name for f in kind]
    return without(df, *names).withColumn("_code", code(F.col(text_col))).withColumns({n: F.col("_code")[n] for n in names}).drop("_code")
