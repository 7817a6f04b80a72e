"""License notices found through a positional index of rare words.

A template is the wording of a notice; its key phrases, in brackets below, are mandatory and stand word for word. The
index keeps for each template the places of its key words, rarest first; how rare a licence word is, is counted over
all texts. In a file, the licence words present are looked up from the rarest on: a template is reached through its
rarest key word, the places of its next rare word are intersected by relative position, and only what is left is
verified against the key phrases and the wording between them. Rarity decides the order of the work, never a result.

A template stands where its first key phrase does, if each other key phrase stands within ``SLACK`` words of its
relative place and ``LEAST`` of the template's words are found within ``SLACK`` words of theirs.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import without

SLACK = 8
LEAST = 0.8
#: Words of a text in UTF-8 whose ASCII letters are lower case: all but control, blank and punctuation characters of ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Labels and wordings of notices; the first three are the base phrases.
NOTICES = (
    ("mit", "[under the mit license]"),
    ("apache-2", "[apache license version 2]"),
    ("cc-by-nc", "[cc by nc]"),
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy] of this software and associated documentation files the software "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("apache-2", "[licensed under the apache license] version 2 0 the license you may not use this file [except in compliance with the license]"),
    ("bsd", "[redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met]"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted]"),
    ("zlib", "[this software is provided as is without any express or implied warranty] in no event will the authors be held liable for any damages "
             "arising from the use of this software [permission is granted to anyone to use this software for any purpose]"),
    ("unlicense", "[this is free and unencumbered software released into the public domain]"),
    ("gpl", "[under the terms of the gnu general public license] as published by the free software foundation"),
    ("gpl-2", "[gnu general public license version 2]"),
    ("gpl-2", "[under the terms of the gnu general public license] as published by the free software foundation [either version 2 of the license]"),
    ("gpl-3", "[gnu general public license version 3]"),
    ("gpl-3", "[under the terms of the gnu general public license] as published by the free software foundation [either version 3 of the license]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("agpl", "[gnu affero general public license]"),
    ("mpl-2", "[subject to the terms of the mozilla public license v 2 0]"),
    ("epl-2", "[eclipse public license v 2 0]"),
    ("cc-by", "[licensed under a creative commons attribution 4 0 international license]"),
    ("cc-by", "[licensed under cc by 4 0]"),
    ("cc-by-sa", "[licensed under a creative commons attribution sharealike 4 0 international license]"),
    ("cc-by-sa", "[cc by sa]"),
    ("cc-by-nc", "[licensed under a creative commons attribution noncommercial 4 0 international license]"),
    ("cc0", "[cc0 1 0 universal]"),
    ("mit", "[spdx license identifier mit]"),
    ("apache-2", "[spdx license identifier apache 2 0]"),
    ("bsd", "[spdx license identifier bsd]"),
    ("gpl-2", "[spdx license identifier gpl 2 0]"),
    ("gpl-3", "[spdx license identifier gpl 3 0]"),
    ("mpl-2", "[spdx license identifier mpl 2 0]"),
)
N_BASE = 3


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass(frozen=True)
class Template:
    """Words of a notice and its key phrases as (place, words)."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]

    @staticmethod
    def parse(label: str, notice: str) -> Template:
        words: list[bytes] = []
        phrases = []
        for i, part in enumerate(re.split(r"[\[\]]", notice)):
            own = words_of(part)
            if i % 2:
                phrases.append((len(words), tuple(own)))
            words += own
        return Template(label, tuple(words), tuple(phrases))


class Index:
    """Templates by their rarest key word, with the relative places of their two rarest ones."""

    def __init__(self, notices: tuple[tuple[str, str], ...], doc_freq: dict[bytes, int]):
        self.templates = [Template.parse(*n) for n in notices]
        self.vocabulary = {w for t in self.templates for w in t.words}
        self.rank = {w: i for i, w in enumerate(sorted(self.vocabulary, key=lambda w: (doc_freq.get(w, 0), w)))}
        self.by_word: dict[bytes, list[tuple[int, list[tuple[int, int, bytes]]]]] = {}
        for number, t in enumerate(self.templates):
            # (phrase, place in it, word), the rarest word first.
            rare = sorted(((k, i, w) for k, (_, own) in enumerate(t.phrases) for i, w in enumerate(own)), key=lambda x: (self.rank[x[2]], x[0], x[1]))
            self.by_word.setdefault(rare[0][2], []).append((number, rare[:2]))

    def find(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place, share of its words) of all notices in a text, in order of template and place."""
        places: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.rank:
                places.setdefault(w, []).append(i)
        found = []
        for w in sorted(places, key=self.rank.__getitem__):
            for number, rare in self.by_word.get(w, ()):
                found += [(number, at, share) for at, share in self._verified(self.templates[number], rare, words, places)]
        return sorted(found)

    def _verified(self, t: Template, rare: list[tuple[int, int, bytes]], words: list[bytes], places: dict[bytes, list[int]]) -> Iterator[tuple[int, float]]:
        (k, i, w), *more = rare
        offset = t.phrases[k][0]
        starts = [p - i for p in places[w]]
        for k2, i2, w2 in more:
            apart = t.phrases[k2][0] + i2 - offset
            loose = 0 if k2 == k else 2 * SLACK  # both phrases may be moved
            other = places.get(w2, [])
            starts = [s for s in starts if bisect_left(other, s + apart - loose) < bisect_right(other, s + apart + loose)]
        starts = [s for s in starts if self._stands(t.phrases[k][1], s, words)]
        firsts = starts
        if k:
            back, phrase = offset - t.phrases[0][0], t.phrases[0][1]
            near = {p for s in starts for p in range(s - back - SLACK, s - back + SLACK + 1)}
            firsts = sorted(p for p in near if self._stands(phrase, p, words))
        for first in firsts:
            base = first - t.phrases[0][0]
            if all(any(self._stands(own, base + at + d, words) for d in range(-SLACK, SLACK + 1)) for at, own in t.phrases[1:]):
                share = self._share(t, base, places)
                if share >= LEAST:
                    yield first, share

    @staticmethod
    def _stands(phrase: tuple[bytes, ...], at: int, words: list[bytes]) -> bool:
        return at >= 0 and tuple(words[at:at + len(phrase)]) == phrase

    @staticmethod
    def _share(t: Template, base: int, places: dict[bytes, list[int]]) -> float:
        near = 0
        for i, w in enumerate(t.words):
            own = places.get(w, [])
            near += bisect_left(own, base + i - SLACK) < bisect_right(own, base + i + SLACK)
        return near / len(t.words)


def licence_word_counts(df: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, text_col: str = "text") -> DataFrame:
    """word, n_docs of the licence words that occur, over all texts; as many rows as templates have words at most."""
    vocabulary = frozenset(w for n in notices for w in Template.parse(*n).words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n_docs"])

    return df.select(text_col).mapInArrow(count, "word string, n_docs long").groupBy("word").agg(F.sum("n_docs").alias("n_docs"))


def scan_licenses(df: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, text_col: str = "text") -> DataFrame:
    """Adds n_words and ``notices``: template number, label, start (in words from 0), n_words and share of every notice in the text.

    Words are lower-cased in A-Z only. A null or empty text has no words and no notices. Columns of these names are
    replaced, all others stay; repeated rows stay repeated, a repeated notice is listed at each place. Texts of any
    length are read whole. An empty table gives an empty table.
    """
    counts = {r["word"].encode(): r["n_docs"] for r in licence_word_counts(df, notices, text_col).collect()}  # the templates' words
    lengths = [len(Template.parse(*n).words) for n in notices]

    @F.arrow_udf("struct<n:bigint, found:array<struct<template:int, label:string, start:bigint, n_words:int, share:double>>>")
    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(notices, counts)
        kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int32()), ("share", pa.float64())]))
        for part in parts:
            n, found = [], []
            for text in part.to_pylist():
                words = words_of(text)
                n.append(len(words))
                found.append([{"template": t, "label": notices[t][0], "start": at, "n_words": lengths[t], "share": s} for t, at, s in index.find(words)])
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(found, kind)], ["n", "found"])

    kept = without(df, "n_words", "notices")
    own = next(f"_scan{i}" for i in range(len(kept.columns) + 1) if f"_scan{i}" not in {c.lower() for c in kept.columns})
    scanned = kept.withColumn(own, scan(F.col(text_col)))
    return scanned.withColumns({"n_words": F.col(f"{own}.n"), "notices": F.col(f"{own}.found")}).drop(own)


def _joined_labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")


def digest_licenses(scanned: DataFrame, n_base: int = N_BASE) -> DataFrame:
    """doc_id, n_words and, of the first ``n_base`` templates, n_base, first_word, last_word and base_labels; labels and score of all."""
    base = F.filter("notices", lambda x: x["template"] < n_base)
    starts = F.transform(base, lambda x: x["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined_labels(base).alias("base_labels"), _joined_labels(F.col("notices")).alias("labels"),
        F.coalesce(F.array_max(F.transform("notices", lambda x: x["share"])), F.lit(0.0)).alias("score"))
