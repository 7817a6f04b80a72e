"""The given tables and the inputs that queries derive from them, in Spark and in SQL."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.pretok import BERT_PATTERN, BYTE_LEVEL_PATTERN, PUNCTUATION, WORD_PATTERN
from ..functions.scalars import ColumnOrName, _col, draw_lists, draw_prefix, hex_to_long, many_draws
from ..functions.text import NOT_WHITESPACE, WHITESPACE, words
from ..session import spread

# Label names of the tagging examples.
LABEL_NAMES = ["O", "B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-MISC", "I-MISC"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on all cores, for CPU-heavy work on a corpus of few files."""
    return spread(documents(spark, sf_dir))


def joined(values: ColumnOrName, sep: str = " ") -> Column:
    """An array as one string, so that results compare as plain values."""
    return F.array_join(_col(values).cast("array<string>"), sep)


def token_id(word: Column) -> Column:
    """A stand-in id for a word without a vocabulary: 1000 to 29999 by digest."""
    return (hex_to_long(F.md5(word), 6) % 29000 + 1000).cast("int")


def token_ids(text: ColumnOrName) -> Column:
    return F.transform(words(F.lower(_col(text))), token_id)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """example_id, question, context: user turns with the assistant turn that follows.

    The join key (conversation, turn) is unique, so a long conversation is no hot key.
    """
    turns = read(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    reply = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context"))
    return user.join(reply, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("example_id"), "question", "context")


class _Draws:
    """Label ids by digest of the rows seen last: true and predicted labels of a batch are made of the same ones."""

    def __init__(self):
        self.key: tuple[list[str], list[int]] | None = None

    def tags(self, prefixes: list[str], counts: list[int]) -> np.ndarray:
        if self.key != (prefixes, counts):
            self.key = prefixes, counts
            self.values = np.floor(many_draws(prefixes, counts) * len(LABEL_NAMES)).astype("int32")
        return self.values


_DRAWS = _Draws()


@F.arrow_udf(ArrayType(IntegerType()))
def _tags(prefixes: pa.Array, counts: pa.Array) -> pa.Array:
    return draw_lists(prefixes, counts, _DRAWS.tags)


@F.arrow_udf(ArrayType(IntegerType()))
def _moved_tags(prefixes: pa.Array, errors: pa.Array, counts: pa.Array) -> pa.Array:
    def moved(keys: list[str], sizes: list[int]) -> np.ndarray:
        tags = _DRAWS.tags(keys, sizes)
        return np.where(many_draws(errors.to_pylist(), sizes) < 0.1, (tags + 1) % len(LABEL_NAMES), tags).astype("int32")

    return draw_lists(prefixes, counts, moved)


def word_tags(key: list[str], tokens: ColumnOrName, error: bool = False) -> Column:
    """A label id per token by digest; with ``error`` one in ten is moved to the next label."""
    size = F.size(_col(tokens)).cast("int")
    return _moved_tags(draw_prefix("tag", *key), draw_prefix("err", *key), size) if error else _tags(draw_prefix("tag", *key), size)


def label_name(label: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in LABEL_NAMES]), label)


@F.arrow_udf(ArrayType(StringType()))
def label_names(labels: pa.Array) -> pa.Array:
    """``label_name`` of every element, over the flat buffer."""
    bounds, flat = pc.subtract(labels.offsets, labels.offsets[0]), labels.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(LABEL_NAMES)))
    names = pa.array(LABEL_NAMES, pa.string()).take(pc.if_else(known, flat, pa.scalar(None, pa.int32())))
    return pa.ListArray.from_arrays(bounds, names, mask=labels.is_null() if labels.null_count else None)


@F.arrow_udf(StructType([StructField("word_ids", ArrayType(IntegerType())), StructField("piece_ids", ArrayType(IntegerType()))]))
def _three_chars(words: pa.Array) -> pa.Array:
    """Each distinct word of a batch is cut once; pieces and word numbers are laid out over the flat buffer."""
    flat = words.flatten().dictionary_encode()
    ids: dict[str, int] = {}
    codes, sizes = [], []
    for word in flat.dictionary.to_pylist():
        pieces = [word[i:i + 3] for i in range(0, len(word), 3)]
        for p in pieces:
            if p not in ids:
                ids[p] = int(md5(p.encode()).hexdigest()[:6], 16) % 29000 + 1000
            codes.append(ids[p])
        sizes.append(len(pieces))
    codes, sizes, word = np.array(codes, "int32"), np.array(sizes, "int64"), flat.indices.to_numpy()
    bounds = words.offsets.to_numpy().astype("int64")
    bounds = bounds - bounds[0]
    row = np.repeat(np.arange(len(words)), np.diff(bounds))
    n = sizes[word]
    ends = np.concatenate([[0], np.cumsum(n)])  # pieces before each word
    present = words.is_valid().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.diff(ends[bounds]) + 2 * present)])
    at = np.arange(ends[-1]) + np.repeat(starts[row] + 1 - ends[bounds[row]], n)
    piece_ids, word_ids, named = np.full(starts[-1], 101, "int32"), np.zeros(starts[-1], "int32"), np.zeros(starts[-1], bool)
    piece_ids[starts[1:][present] - 1] = 102
    piece_ids[at] = codes[np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], n)]
    word_ids[at], named[at] = np.repeat(np.arange(len(word)) - bounds[row], n), True

    def lists(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values, mask=words.is_null())

    return pa.StructArray.from_arrays([lists(pa.array(word_ids, mask=~named)), lists(pa.array(piece_ids))], ["word_ids", "piece_ids"])


def three_char_pieces(df: DataFrame, text: str) -> DataFrame:
    """Adds ``piece_ids`` and ``word_ids``: words cut into pieces of three characters between two special tokens."""
    cut = df.withColumn("_cut", _three_chars(words(text)))
    return cut.withColumns({"word_ids": F.col("_cut.word_ids"), "piece_ids": F.col("_cut.piece_ids")}).drop("_cut")


def rules_window():
    """Numbers a rule list of constant length."""
    return W.orderBy(F.desc("freq"), "left", "right")


def vocab_window():
    """Numbers a vocabulary."""
    return W.orderBy(F.desc("n"), "token")


# SQL counterparts.

def re2(pattern: str) -> str:
    """A pattern as a SQL literal; RE2 has no possessive quantifiers and needs none."""
    return "'" + pattern.replace("++", "+").replace("'", "''") + "'"


def sql_words(text: str) -> str:
    return f"regexp_extract_all({text}, {re2(NOT_WHITESPACE + '+')})"


def sql_strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, {re2('^' + WHITESPACE + '+')}, ''), {re2(WHITESPACE + '+$')}, '')"


def sql_hex(digest: str, digits: int = 8) -> str:
    return f"('0x' || substr({digest}, 1, {digits}))::BIGINT"


def sql_uniform(seed: str, *keys: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"({k})" for k in keys]])
    return f"({sql_hex(f'md5({text})')} / 4294967296.0::DOUBLE)"


def sql_token_id(word: str) -> str:
    return f"({sql_hex(f'md5({word})', 6)} % 29000 + 1000)::INTEGER"


def sql_token_ids(text: str) -> str:
    return f"list_transform({sql_words(f'lower({text})')}, lambda w: {sql_token_id('w')})"


def sql_joined(values: str, sep: str = "' '") -> str:
    return f"array_to_string({values}, {sep})"


SQL_PAIRS = """
SELECT u.conv_id * 1000000 + u.turn AS example_id, u.text AS question, a.text AS context
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""


def sql_tokens(table: str, key: str, tokens: str) -> str:
    """key, pos (from 0), token: one row per token."""
    return f"""SELECT {key}, i - 1 AS pos, token FROM (
      SELECT {key}, unnest(ts) AS token, generate_subscripts(ts, 1) AS i FROM (SELECT {key}, {tokens} AS ts FROM {table}))"""


def sql_tag(key: str, pos: str, error: bool = False) -> str:
    label = f"floor({sql_uniform('tag', key, pos)} * 9)::INTEGER"
    return f"CASE WHEN {sql_uniform('err', key, pos)} < 0.1 THEN ({label} + 1) % 9 ELSE {label} END" if error else label


SQL_LABEL_NAMES = "[" + ", ".join(f"'{n}'" for n in LABEL_NAMES) + "]"


def sql_byte_level(text: str) -> str:
    """Text spelled in the byte alphabet, from the code point ranges of UTF-8."""
    def shown(byte: str) -> str:
        return (f"chr((CASE WHEN {byte} <= 32 THEN {byte} + 256 WHEN {byte} BETWEEN 127 AND 160 THEN {byte} + 162"
                f" WHEN {byte} = 173 THEN 323 ELSE {byte} END)::INTEGER)")

    def tail(shift: int) -> str:
        return shown(f"(128 + (unicode(c) // {1 << shift}) % 64)")

    two = f"{shown('(192 + unicode(c) // 64)')} || {tail(0)}"
    three = f"{shown('(224 + unicode(c) // 4096)')} || {tail(6)} || {tail(0)}"
    four = f"{shown('(240 + unicode(c) // 262144)')} || {tail(12)} || {tail(6)} || {tail(0)}"
    return f"""array_to_string(list_transform(string_split({text}, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN {shown('unicode(c)')} WHEN unicode(c) < 2048 THEN {two}
           WHEN unicode(c) < 65536 THEN {three} ELSE {four} END), '')"""


def sql_byte_level_pieces(text: str) -> str:
    """Raw byte-level pieces without a look-ahead: a mark is set before the last white space ahead of a word."""
    ws = WHITESPACE[1:-1]
    marked = f"regexp_replace({text}, {re2(f'([{ws}])([^{ws}])')}, chr(1) || '\\1\\2', 'g')"
    pattern = "'s|'t|'re|'ve|'m|'ll|'d" + rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{ws}\p{{L}}\p{{N}}\x01]+|[{ws}]+"
    return f"regexp_extract_all({marked}, {re2(pattern)})"


SQL_BERT = re2(BERT_PATTERN)
SQL_WORD = re2(WORD_PATTERN)
SQL_PUNCT_SPLIT = re2(rf"[^{PUNCTUATION}]++|[{PUNCTUATION}]")
