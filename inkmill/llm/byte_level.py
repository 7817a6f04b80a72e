"""Worker-side encoding with a byte-level vocabulary: texts in pieces, pieces from a bounded cache.

A text is cut at single spaces into pieces that the tokenizer's own pattern never joins: a cut before a space that
follows a visible character, or that precedes one, is always a token boundary. Texts with a blank on both sides of
a space, or one before a space at the end, are cut by the pattern itself. Pieces not in the cache are cut into
pre-tokens, and pre-tokens that are not cached either are encoded by the model of the tokenizers library.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
CLOSE_BLANKS = regex.compile(r"\s (?:\s|\Z)")
BLANK = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # \s, spelled out for Arrow
CLOSE_BLANKS_OF_ARRAYS = rf"{BLANK} (?:{BLANK}|\z)"
BLANK_AT_END = rf"\A{BLANK}|{BLANK}\z"
LETTER_AND_MARK = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}][.,]\z"
JOINED = 2_000  # pieces encoded as one text
KNOWN = 1 << 20  # words whose ids a worker keeps in arrays
CACHED = 300_000  # entries of one generation of a worker's cache, the frequent ones not counted
MARKS = ".,"  # marks that stand alone behind letters
LONGEST_CACHED = 64  # characters; longer pieces are encoded each time, so that a cache is bounded in bytes too


def _spelling() -> dict[int, str]:
    """The printable character of each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


SPELLING = _spelling()


def spell(piece: str) -> str:
    if piece.isascii() and piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
        return piece.replace(" ", "Ġ")
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(SPELLING)


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class Cache(dict):
    """A dictionary that computes what is missing, bounded to two generations of ``limit`` entries.

    A full generation becomes the old one; entries of the old one come back when they are asked for again, so what is
    frequent stays. Entries of ``frequent`` always stay, keys of more than ``LONGEST_CACHED`` characters never do.
    """

    def __init__(self, compute, frequent: dict | None = None, limit: int = CACHED):
        super().__init__(frequent or {})
        self.compute, self.frequent, self.most, self.old = compute, frequent or {}, limit + len(frequent or {}), {}

    def __missing__(self, key):
        if len(key) > LONGEST_CACHED:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
            self.update(self.frequent)
        self[key] = value


class Known:
    """Ids of distinct words, kept from batch to batch as flat arrays; ``compute`` gives those of new words.

    When more than ``most`` words are known, only those of the last call stay. Words of more than ``LONGEST_CACHED``
    bytes are not kept.
    """

    def __init__(self, compute, most: int = KNOWN):
        self.compute, self.most = compute, most
        self._keep(pa.array([], pa.string()), np.empty(0, np.int32), np.empty(0, np.int64))

    def _keep(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        short = pc.less_equal(pc.binary_length(words), LONGEST_CACHED)
        ids, to = gathered(ids, lengths, np.flatnonzero(short.to_numpy(zero_copy_only=False)))
        self.words, self.ids, self.lengths = words.filter(short), ids, np.diff(to, prepend=0)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word)."""
        at = pc.index_in(words, value_set=self.words)
        is_new = pc.is_null(at)
        new = words.filter(is_new)
        fresh, n = self.compute(new)
        place, is_new = pc.fill_null(at, 0).to_numpy().astype(np.int64), is_new.to_numpy(zero_copy_only=False)
        place[is_new] = len(self.words) + np.arange(len(new))
        ids, lengths = np.concatenate([self.ids, fresh]), np.concatenate([self.lengths, n])
        out, to = gathered(ids, lengths, place)
        if len(lengths) > self.most:
            self._keep(words, out, np.diff(to, prepend=0))
        elif len(new):
            self._keep(pa.concat_arrays([self.words, new]), ids, lengths)
        return out, np.diff(to, prepend=0)


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes; special strings in a text are the special tokens."""

    def __init__(self, path: str, limit: int = CACHED, known: int = KNOWN):
        tokenizer = load(path)
        self.model = tokenizer.model
        # The pattern and the model alone, without added tokens or a normalizer.
        self.library = Tokenizer(tokenizer.model)
        self.library.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=True)
        self.opens = np.array([(self.library.id_to_token(i) or "").startswith(SPELLING[32]) for i in range(max(tokenizer.get_vocab().values(), default=-1) + 1)], bool)
        self.specials = {t.content: i.to_bytes(4, "little") for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.tokens = Cache(self._token, limit=limit)
        self.spaced = Cache(self._spaced, limit=limit)
        self.known = Known(self._fresh, known)

    def _token(self, token: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spell(token))])

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, PATTERN.findall(piece)))

    def _spaced(self, word: str) -> bytes:
        """A piece behind a space; letters alone, or with one mark after them, need no pattern."""
        if word.isalpha():
            return self.tokens[" " + word]
        if word[:-1].isalpha() and word[-1] in MARKS:
            return self.tokens[" " + word[:-1]] + self.tokens[word[-1]]
        return self._piece(" " + word)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if CLOSE_BLANKS.search(text):
            return b"".join(map(self.tokens.__getitem__, PATTERN.findall(text)))
        first, *rest = text.split(" ")
        return self._piece(first) + b"".join(map(self.spaced.__getitem__, rest))

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text in which the strings of special tokens are plain text."""
        return self._plain(text)

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.split is None or not any(s in text for s in self.specials):
            return self._plain(text)
        return b"".join([self.specials.get(part) or self._plain(part) for part in self.split.split(text)])

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of pieces behind a space, without blanks at their ends.

        They go through the library's own pattern and model many to a text. No other token begins with a space than
        the first of a piece, so these tokens part the pieces again; where they do not, pieces are encoded alone.
        """
        found, lengths, words = [np.empty(0, np.int32)], [np.empty(0, np.int64)], words.to_pylist()
        for at in range(0, len(words), JOINED):
            some = words[at:at + JOINED]
            ids = np.array(self.library.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, np.int32)
            starts = np.flatnonzero(self.opens[ids])
            n = np.diff(starts, append=len(ids))
            if len(starts) != len(some) or starts[0]:
                ids, n = _flat([self._piece(" " + w) for w in some])
            found.append(ids)
            lengths.append(n)
        return np.concatenate(found), np.concatenate(lengths)

    def spaced_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of distinct pieces behind a space.

        A mark behind a letter at the end of a piece is a token of its own, so pieces are looked up without it. Empty
        pieces and those with a blank at an end are encoded alone.
        """
        alone = pc.or_(pc.equal(words, ""), pc.match_substring_regex(words, BLANK_AT_END))
        marked = pc.match_substring_regex(words, LETTER_AND_MARK)
        bare = pc.if_else(alone, "x", pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)).dictionary_encode()
        ids, lengths = self.known(bare.dictionary)
        others = _flat([self._piece(" " + w) for w in words.filter(alone).to_pylist()])
        marks = _flat([self.tokens[m] for m in MARKS])
        code = bare.indices.to_numpy().astype(np.int64)
        alone, marked = (x.to_numpy(zero_copy_only=False) for x in (alone, marked))
        code[alone] = len(lengths) + np.arange(len(others[1]))
        # Each piece is one code, or two with its mark.
        at = np.cumsum(1 + marked)
        order = np.empty(int(at[-1]) if len(at) else 0, np.int64)
        order[at - 1 - marked] = code
        mark = pc.index_in(pc.utf8_slice_codeunits(words.filter(pa.array(marked)), -1), value_set=pa.array(list(MARKS))).to_numpy(zero_copy_only=False)
        order[at[marked] - 1] = len(lengths) + len(others[1]) + mark
        ids, to = gathered(np.concatenate([ids, others[0], marks[0]]), np.concatenate([lengths, others[1], marks[1]]), order)
        return ids, np.diff(to[at - 1], prepend=0)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text ends in them).

        The texts are cut at spaces and their distinct pieces found outside Python; each distinct piece is looked up
        once a batch. What ``encode`` does not cut at spaces goes through it as a whole.
        """
        texts = pa.array(texts, pa.string())
        whole = self.uncut(texts, CLOSE_BLANKS_OF_ARRAYS, self.specials)
        lists, pieces = cut_at_spaces(texts.filter(pa.array(~whole)))
        index = pieces.indices.to_numpy().astype(np.int64)
        ids, lengths = self.spaced_ids(pieces.dictionary)
        starts = lists.offsets.to_numpy()[:-1]
        firsts = [self._piece(w) for w in pieces.dictionary.take(pa.array(index[starts])).to_pylist()]
        index[starts] = len(lengths) + np.arange(len(firsts))
        others = _flat(firsts + [self.encode(t) for t in texts.filter(pa.array(whole)).to_pylist()])
        order, ends = in_text_order(whole, lists, index, len(lengths) + len(firsts))
        ids, to = gathered(np.concatenate([ids, others[0]]), np.concatenate([lengths, others[1]]), order)
        return ids, np.concatenate([[0], to])[ends]

    @staticmethod
    def uncut(texts: pa.Array, pattern: str, strings=()) -> np.ndarray:
        """Which texts are null or empty, match the pattern or hold one of the strings."""
        out = pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, pattern))
        for s in strings:
            out = pc.or_(out, pc.match_substring(texts, s))
        return pc.fill_null(out, True).to_numpy(zero_copy_only=False)


def _flat(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number of ids of each) of codes in bytes."""
    return np.frombuffer(b"".join(codes), "<i4"), np.fromiter(map(len, codes), np.int64, len(codes)) // 4


def cut_at_spaces(texts: pa.Array) -> tuple[pa.ListArray, pa.DictionaryArray]:
    """(the pieces of each text, all pieces as a dictionary)."""
    lists = pc.split_pattern(texts, " ")
    return lists, lists.flatten().dictionary_encode()


def in_text_order(whole: np.ndarray, lists: pa.ListArray, index: np.ndarray, first_whole: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each code in the order of the texts, where each text ends in it).

    ``index`` numbers the pieces of the texts that were cut; the others are one code each, from ``first_whole`` on.
    """
    counts = np.ones(len(whole), np.int64)
    counts[~whole] = lists.value_lengths().to_numpy()
    ends = np.cumsum(counts)
    at, is_piece = ends[whole] - 1, np.ones(int(counts.sum()), bool)
    is_piece[at] = False
    full = np.empty(len(is_piece), np.int64)
    full[is_piece], full[at] = index, first_whole + np.arange(len(at))
    return full, ends


def gathered(ids: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of the codes in this order, where each code ends in them); ``ids`` holds codes of these lengths."""
    n = lengths[order]
    to = np.cumsum(n)
    total = int(to[-1]) if len(to) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    places = np.repeat((np.cumsum(lengths) - lengths)[order].astype(kind) - (to - n).astype(kind), n)
    places += np.arange(total, dtype=kind)
    return ids[places], to


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
