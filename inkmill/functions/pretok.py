"""Pre-tokenisers as column functions, with character offsets on request."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .scalars import ColumnOrName, _col
from .text import WHITESPACE, words

# Character classes and patterns of the pre-tokenisers.
_WS = WHITESPACE[1:-1]
PUNCTUATION = r"!-/:-@\[-\x60{-~\p{P}"
WORD_CHARS = r"\p{L}\p{M}\p{N}\p{Pc}"
BERT_PATTERN = rf"[^{_WS}{PUNCTUATION}]++|[{PUNCTUATION}]"
BERT_COVER = rf"[^{_WS}{PUNCTUATION}]++|[{PUNCTUATION}]|[{_WS}]++"
WORD_PATTERN = rf"[{WORD_CHARS}]++|[^{_WS}{WORD_CHARS}]++"
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
    rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
SPACE_MARK = "▁"


def _extract(text: ColumnOrName, pattern: str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))


def pretok_bert(text: ColumnOrName) -> Column:
    """Split on white space and isolate every punctuation character."""
    return _extract(text, BERT_PATTERN)


def pretok_whitespace(text: ColumnOrName) -> Column:
    """Runs of word characters, or runs of anything else but white space."""
    return _extract(text, WORD_PATTERN)


def pretok_sequence(text: ColumnOrName) -> Column:
    """White-space split first, then punctuation isolated inside each word."""
    return F.flatten(F.transform(words(text), lambda w: _extract(w, rf"[^{PUNCTUATION}]++|[{PUNCTUATION}]")))


def pretok_metaspace(text: ColumnOrName) -> Column:
    """White-space words, each with a leading space marker."""
    return F.transform(words(text), lambda w: F.concat(F.lit(SPACE_MARK), w))


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character; bytes without a visible form get code points from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)}


def to_byte_level(text: ColumnOrName) -> Column:
    """UTF-8 bytes of the text, one printable character per byte."""
    table = {chr(b): c for b, c in byte_alphabet().items() if chr(b) != c}
    latin = F.decode(F.encode(_col(text), "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(table), "".join(table.values()))


def from_byte_level(text: ColumnOrName) -> Column:
    """Inverse of to_byte_level."""
    table = {c: chr(b) for b, c in byte_alphabet().items() if chr(b) != c}
    latin = F.translate(_col(text), "".join(table), "".join(table.values()))
    return F.decode(F.encode(latin, "ISO-8859-1"), "UTF-8")


def pretok_bytelevel_raw(text: ColumnOrName) -> Column:
    """Byte-level pieces before the byte alphabet is applied."""
    return _extract(text, BYTE_LEVEL_PATTERN)


def pretok_bytelevel(text: ColumnOrName) -> Column:
    """Pieces that keep their leading space, spelled in the byte alphabet."""
    return F.transform(pretok_bytelevel_raw(text), to_byte_level)


@F.arrow_udf(ArrayType(IntegerType()))
def running_starts(lengths: pa.Array) -> pa.Array:
    """Exclusive running sum inside every list, over the flat Arrow buffer."""
    bounds = lengths.offsets.to_numpy().astype("int64")
    bounds = bounds - bounds[0]
    flat = lengths.flatten().to_numpy(zero_copy_only=False).astype("int64")
    total = np.concatenate([[0], np.cumsum(flat)])
    starts = total[:-1] - np.repeat(total[bounds[:-1]], np.diff(bounds))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(starts, pa.int32()))


def with_offsets(tokens: Column, starts: Column) -> Column:
    """Zip tokens with their start and end (array of token, start, end)."""
    return F.zip_with(
        tokens, starts,
        lambda t, s: F.struct(t.alias("token"), s.alias("start"), (s + F.length(t)).alias("end")),
    )


# Items of a batch of lists that are looked at together.
ITEMS_AT_ONCE = 500_000


def row_slices(lists: pa.ListArray) -> Iterator[tuple[int, int]]:
    """(first row, rows) of parts of about ITEMS_AT_ONCE items; a longer list stands alone."""
    start, ends = 0, lists.offsets.to_numpy()
    while start < len(lists):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + ITEMS_AT_ONCE, side="right")) - 1)
        yield start, end - start
        start = end


def _blank(tokens: pa.Array) -> np.ndarray:
    """Whether each token begins with white space; only those that begin with a byte of a wide space meet the pattern."""
    ends = np.frombuffer(tokens.buffers()[1], "int32")[tokens.offset:tokens.offset + len(tokens) + 1]
    data = np.frombuffer(tokens.buffers()[2], "uint8") if tokens.buffers()[2] else np.zeros(0, "uint8")
    blank, some = np.zeros(len(tokens), bool), np.flatnonzero(ends[1:] > ends[:-1])
    first = data[ends[some]]
    blank[some] = ((first >= 0x09) & (first <= 0x0D)) | ((first >= 0x1C) & (first <= 0x20))
    wide = some[np.isin(first, np.array([0xC2, 0xE1, 0xE2, 0xE3], "uint8"))]
    if len(wide):
        blank[wide] = pc.match_substring_regex(tokens.take(pa.array(wide)), f"^{WHITESPACE}").to_numpy(zero_copy_only=False)
    return blank


@F.arrow_udf(ArrayType(StructType([StructField("token", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])))
def _located(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The tokens of covering lists that are not blank, with their places, over the flat buffers."""
    for batch in batches:
        for start, n in row_slices(batch):
            part = batch.slice(start, n)
            bounds, flat = part.offsets.to_numpy().astype("int64"), part.flatten()
            bounds = bounds - bounds[0]
            ends = np.cumsum(pc.utf8_length(flat).to_numpy().astype("int64"))
            before = np.concatenate([[0], ends])
            base = np.repeat(before[bounds[:-1]], np.diff(bounds))
            kept = ~_blank(flat)
            places = np.concatenate([[0], np.cumsum(kept)])[bounds]
            columns = [flat.filter(pa.array(kept)), *(pa.array((x - base)[kept], pa.int32()) for x in (before[:-1], ends))]
            found = pa.StructArray.from_arrays(columns, ["token", "start", "end"])
            yield pa.ListArray.from_arrays(pa.array(places, pa.int32()), found, mask=part.is_null() if part.null_count else None)


def piece_offsets(df, text: str, pattern: str = BERT_COVER, out: str = "pieces"):
    """Add ``out``: non-blank pieces of a covering pattern with offsets in the original text."""
    return df.withColumn(out, _located(_extract(text, pattern)))


def bytelevel_offsets(df, text: str, out: str = "pieces"):
    """Byte-level pieces; the pattern covers the whole text, so none is dropped."""
    located = df.withColumn("_cover", pretok_bytelevel_raw(text)).withColumn(
        "_starts", running_starts(F.transform("_cover", F.length)))
    pieces = F.transform(
        with_offsets(F.col("_cover"), F.col("_starts")),
        lambda p: F.struct(to_byte_level(p["token"]).alias("token"), p["start"], p["end"]),
    )
    return located.withColumn(out, pieces).drop("_cover", "_starts")


def metaspace_offsets(df, text: str, out: str = "pieces"):
    """Metaspace pieces; the span is the word alone, without its marker."""
    located = piece_offsets(df, text, rf"[^{_WS}]++|[{_WS}]++", "_words")
    marked = F.transform("_words", lambda p: F.struct(
        F.concat(F.lit(SPACE_MARK), p["token"]).alias("token"), p["start"], p["end"]))
    return located.withColumn(out, marked).drop("_words")
