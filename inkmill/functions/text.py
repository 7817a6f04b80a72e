"""Column functions on raw text."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, functions as F

from .scalars import ColumnOrName, _col

# Unicode white space and punctuation, written so that Java and
# RE2 read them alike.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_WHITESPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
SENTENCE_END = r"[.!?]"

# The longest first: an entity of this kind may have no semicolon and may be followed by letters.
OPEN_ENTITIES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def strip(text: ColumnOrName) -> Column:
    """Remove Unicode white space at both ends."""
    left = F.regexp_replace(_col(text), f"^{WHITESPACE}+", "")
    return F.regexp_replace(left, f"{WHITESPACE}+$", "")


def words(text: ColumnOrName) -> Column:
    """White-space separated words; an empty text has none."""
    return F.regexp_extract_all(_col(text), F.lit(NOT_WHITESPACE + "++"), F.lit(0))


def word_count(text: ColumnOrName) -> Column:
    return F.regexp_count(_col(text), F.lit(NOT_WHITESPACE + "++"))


def _code_point(number: Column) -> Column:
    """The character of a numeric entity: C1 controls are read as Windows-1252, what is no character goes or is replaced."""
    windows = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (F.when(number.isNull() | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF), "\ufffd")
            .when(number.between(0x80, 0x9F), F.substring(F.lit(windows), (number - 0x7F).cast("int"), F.lit(1)))
            .when(number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 0x7F) | number.between(0xFDD0, 0xFDEF)
                  | (number.bitwiseAND(0xFFFE) == 0xFFFE), "")
            .otherwise(char))


def html_unescape(text: ColumnOrName) -> Column:
    """All named, decimal and hexadecimal entities of HTML 5, also those that may lack their semicolon."""
    text = _col(text)
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def plain(piece: Column) -> Column:
        name = F.substring(piece, F.lit(2), F.length(piece))
        digits = F.regexp_extract(piece, "^&#([0-9]+)", 1)
        hexed = F.regexp_extract(piece, "^&#[xX]0*([0-9a-fA-F]+)", 1)
        number = F.when(digits != "", digits.try_cast("bigint")).when(F.length(hexed) <= 8, F.conv(hexed, 16, 10).try_cast("bigint"))
        head = F.regexp_extract(piece, f"^&({'|'.join(OPEN_ENTITIES)})", 1)
        return (F.when(~piece.startswith("&") | (piece == "&"), piece)
                .when(piece.startswith("&#"), _code_point(number))
                .otherwise(F.coalesce(
                    F.try_element_at(names, name),
                    F.when(head != "", F.concat(F.try_element_at(names, head), F.substring(piece, F.length(head) + 2, F.length(piece)))),
                    piece)))

    pieces = F.regexp_extract_all(text, F.lit(rf"{ENTITY}|[^&]++|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, plain), "")).otherwise(text)


def html_unescape_native(text: ColumnOrName) -> Column:
    """The same as html_unescape."""
    return html_unescape(text)


def sent_split(text: ColumnOrName) -> Column:
    """Sentences by rule: a break is white space after ``.``, ``!`` or ``?``."""
    parts = F.split(strip(text), f"(?<={SENTENCE_END}){WHITESPACE}+")
    return F.filter(parts, lambda s: s != "")


def lead_summary(text: ColumnOrName, k: int = 3) -> Column:
    """The first k sentences, one per line."""
    return F.array_join(F.slice(sent_split(text), 1, k), "\n")


def substring_by_offset(text: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> Column:
    """``text[start:end]`` with 0-based half-open code point offsets."""
    start, end = _col(start), _col(end)
    return F.substring(_col(text), start + 1, end - start)


def contains_any(text: ColumnOrName, keywords: list[str]) -> Column:
    """Case-sensitive substring test for any keyword.

    A balanced disjunction of ``contains``, which the Parquet scan can take over.
    """
    if not keywords:
        return F.lit(False)
    text = _col(text)
    hits = [text.contains(k) for k in keywords]
    while len(hits) > 1:
        hits = [a | b for a, b in zip(hits[::2], hits[1::2])] + hits[len(hits) & ~1:]
    return hits[0]


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one base plus marks."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        if parts != char and all(unicodedata.category(p) == "Mn" for p in parts[1:]):
            source.append(char)
            target.append(parts[0])
    return "".join(source), "".join(target)


def _jamo(text: Column) -> Column:
    """Hangul syllables as their letters, by the arithmetic of their code points; other texts are passed on."""
    first, middle, last = ["".join(map(chr, range(start, start + n))) for start, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))]

    def letters(c: Column) -> Column:
        at = F.ascii(c) - 0xAC00
        parts = [F.substring(F.lit(table), i.cast("int"), F.lit(1)) for table, i in (
            (first, F.floor(at / 588) + 1), (middle, F.floor((at % 588) / 28) + 1), (last, at % 28))]
        tail = F.when(at % 28 > 0, parts[2]).otherwise("")
        return F.when(c.between("\uac00", "\ud7a3"), F.concat(parts[0], parts[1], tail)).otherwise(c)

    return F.when(text.rlike("[\uac00-\ud7a3]"), F.array_join(F.transform(F.split(text, ""), letters), "")).otherwise(text)


def normalize_text(text: ColumnOrName) -> Column:
    """Lower-case, decompose canonically and drop accents.

    A lambda over one element binds the translated text, which else would be worked out again for each mention. Only
    texts with marks or Hangul go on from there, and plain ASCII texts need lower case only.
    """
    text = _col(text)
    source, target = _accent_table()

    def rest(base: Column) -> Column:
        return F.when(base.rlike("[\uac00-\ud7a3\\p{Mn}]"), _jamo(F.regexp_replace(base, r"\p{Mn}+", ""))).otherwise(base)

    full = F.get(F.transform(F.array(F.translate(F.lower(text), source, target)), rest), F.lit(0))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(full)


def normalize_text_full(text: ColumnOrName) -> Column:
    """The same as normalize_text."""
    return normalize_text(text)


def normalized_places(text: ColumnOrName) -> Column:
    """For each character of ``normalize_text`` the place of its source in the text; null where all stay in place."""
    def width(c: Column) -> Column:
        letters = F.when((F.ascii(c) - 0xAC00) % 28 > 0, 3).otherwise(2)
        return F.when(c.rlike(r"\p{Mn}"), 0).when(c.between("\uac00", "\ud7a3"), letters).otherwise(1)

    text = _col(text)
    places = F.flatten(F.transform(F.split(text, ""), lambda c, i: F.array_repeat(i, width(c))))
    return F.when(text.rlike("[\uac00-\ud7a3\\p{Mn}]"), places)
