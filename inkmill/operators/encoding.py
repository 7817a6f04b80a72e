"""Encoding and decoding with a trained vocabulary.

A vocabulary goes to every task, so its size is checked first. The small helpers
below work on the distinct words of an Arrow batch and are spread back by index;
text never moves between tasks. For vocabularies above the bound the ``_join`` forms
match the substrings of distinct words with the vocabulary, and each word is encoded
with the few entries found in it. Plain token -> id lookup is a join as well.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.pretok import byte_alphabet, row_slices
from ..functions.scalars import ColumnOrName, _col
from ..session import cut_lineage
from .blocks import look_up, table_values
from .merging import apply_merges

# Largest vocabulary that is sent to every task (some tens of MB).
MAX_BROADCAST_TOKENS = 500_000


def bounded_rows(df: DataFrame, limit: int = MAX_BROADCAST_TOKENS) -> list:
    """Rows of a small table; more than ``limit`` is an error, found without reading them all."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: use the _join form")
    return rows


# Words of a batch whose pieces are held at once.
WORDS_AT_ONCE = 200_000
# Words whose pieces a task keeps for later batches (some 40 MB), and their longest.
KEPT_WORDS, KEPT_CHARS = 100_000, 64
# Characters from which a word takes its merges from a heap instead of one look at all of it per merge.
LONG_WORD = 32


def _slices(words: pa.Array) -> Iterator[pa.Array]:
    """The rows of a batch in pieces of about WORDS_AT_ONCE words; a longer row stands alone."""
    start, ends = 0, words.offsets.to_numpy()
    while start < len(words):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + WORDS_AT_ONCE, side="right")) - 1)
        yield words.slice(start, end - start)
        start = end


def _word_encoder(encode):
    """Column function array<word> -> array<array<piece>>. Results leave by slices, so a batch's pieces are never held together.

    A task keeps the pieces of the first KEPT_WORDS short words it sees, among them the frequent ones.
    """
    @F.arrow_udf(ArrayType(ArrayType(StringType())))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept: dict[str, list[str]] = {}

        def known(word: str) -> list[str]:
            pieces = kept.get(word)
            if pieces is None:
                pieces = encode(word)
                if len(kept) < KEPT_WORDS and len(word) <= KEPT_CHARS:
                    kept[word] = pieces
            return pieces

        for batch in batches:
            for part in _slices(batch):
                yield _per_distinct_word(part, known)

    return run


def _per_distinct_word(words: pa.Array, encode) -> pa.Array:
    """list<string> of words -> list<list<string>>; each distinct word is encoded once."""
    flat = words.flatten().dictionary_encode()
    coded = pa.array([encode(w) for w in flat.dictionary.to_pylist()], pa.list_(pa.string()))
    bounds = pc.subtract(words.offsets, words.offsets[0])
    return pa.ListArray.from_arrays(bounds.cast(pa.int32()), coded.take(flat.indices))


def _longest_match(word: str, vocab: set[str], longest: int, prefix: str, unknown: str) -> list[str]:
    """Greedy pieces; a word with a position nothing matches is unknown as a whole."""
    pieces, at = [], 0
    while at < len(word):
        mark = prefix if at else ""
        for end in range(min(len(word), at + longest), at, -1):
            piece = mark + word[at:end]
            if piece in vocab:
                break
        else:
            return [unknown]
        pieces.append(piece)
        at = end
    return pieces


def wordpiece_encoder(vocab: DataFrame, prefix: str = "##", unknown: str = "[UNK]"):
    """Column function array<word> -> array<array<piece>> for a ``vocab(token)``."""
    tokens = frozenset(r.token for r in bounded_rows(vocab.select("token")))
    shared = vocab.sparkSession.sparkContext.broadcast(tokens)
    longest = max((len(t) for t in tokens), default=1)

    return _word_encoder(lambda w: _longest_match(w, shared.value, longest, prefix, unknown))


def encode_wordpiece(df: DataFrame, words: Column, vocab: DataFrame, out: str = "pieces") -> DataFrame:
    """Add ``out``: the pieces of every word, in order and per word."""
    return df.withColumn(out, wordpiece_encoder(vocab)(words))


class _Single:
    """Ranks as ``apply_merges`` takes them, with one rank a pair."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        self.ranks = ranks

    def __contains__(self, pair: tuple[str, str]) -> bool:
        return pair in self.ranks

    def __getitem__(self, pair: tuple[str, str]) -> tuple[int]:
        return (self.ranks[pair],)

    def get(self, pair: tuple[str, str]) -> tuple[int] | None:
        rank = self.ranks.get(pair)
        return None if rank is None else (rank,)


def _bpe_word(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Rules in learned order; a rule that has had its turn does not come back."""
    if len(word) > LONG_WORD:
        return apply_merges(list(word), _Single(ranks))
    parts, last = list(word), -1
    while len(parts) > 1:
        ahead = [r for p in zip(parts, parts[1:]) if (r := ranks.get(p, -1)) > last]
        if not ahead:
            break
        last, merged = min(ahead), []
        for part in parts:
            if merged and ranks.get((merged[-1], part)) == last:
                merged[-1] += part
            else:
                merged.append(part)
        parts = merged
    return parts


def encode_bpe(df: DataFrame, words: Column, merges: DataFrame, out: str = "pieces", byte_level: bool = False) -> DataFrame:
    """Add ``out``: the pieces of every word under ``merges(rank, left, right)``.

    With ``byte_level`` the words are given as they stand in the text, and are spelled in the byte alphabet where they
    are encoded, once per distinct word of a slice.
    """
    rows = bounded_rows(merges.select("rank", "left", "right"))
    ranks: dict[tuple[str, str], int] = {}
    for r in sorted(rows, key=lambda r: r.rank):
        ranks.setdefault((r.left, r.right), r.rank)
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    if byte_level:
        spelled = {b: c for b, c in byte_alphabet().items() if chr(b) != c}
        return df.withColumn(out, _word_encoder(lambda w: _bpe_word(w.encode().decode("latin-1").translate(spelled), shared.value))(words))
    return df.withColumn(out, _word_encoder(lambda w: _bpe_word(w, shared.value))(words))


def _viterbi(word: str, scores: dict[str, float], longest: int, start_score: float, skip: str | None = None):
    """Best segmentation and its score; (None, None) where there is none. The earliest start wins ties."""
    best: list[tuple[float, int] | None] = [(start_score, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            before, token = best[start], word[start:end]
            if before is None or token == skip or token not in scores:
                continue
            score = scores[token] + before[0]
            if best[end] is None or score < best[end][0]:
                best[end] = (score, start)
    if best[-1] is None:
        return None, None
    pieces, end = [], len(word)
    while end > 0:
        start = best[end][1]
        pieces.append(word[start:end])
        end = start
    return pieces[::-1], best[-1][0]


def _viterbi_removals(word: str, scores: dict[str, float], longest: int, start_score: float):
    """(pieces, score, {piece: score of the best path without it}) of the pieces of two or more characters, from one run.

    ``ahead`` and ``behind`` are the best scores up to and from each place. A path without a piece that the word holds
    once takes another token over the place where the piece starts. A piece that stands at several places has a run of
    its own, as the path must avoid all of them.
    """
    n, edges = len(word), []
    ahead: list[float | None] = [start_score] + [None] * n
    behind: list[float | None] = [None] * n + [0.0]
    back = [0] * (n + 1)
    for start in range(n):
        if ahead[start] is None:
            continue
        for end in range(start + 1, min(n, start + longest) + 1):
            cost = scores.get(word[start:end])
            if cost is not None:
                edges.append((start, end, cost))
                if ahead[end] is None or cost + ahead[start] < ahead[end]:
                    ahead[end], back[end] = cost + ahead[start], start
    if ahead[n] is None:
        return None, None, {}
    for start, end, cost in reversed(edges):
        if behind[end] is not None and (behind[start] is None or cost + behind[end] < behind[start]):
            behind[start] = cost + behind[end]
    spans, end = [], n
    while end > 0:
        spans.append((back[end], end))
        end = back[end]
    spans.reverse()
    pieces = [word[a:b] for a, b in spans]
    longer = [(a, b) for a, b in spans if b - a > 1]
    starts, best = [a for a, _ in longer], [None] * len(longer)
    for start, end, cost in edges:
        if behind[end] is not None:
            whole = ahead[start] + cost + behind[end]
            for k in range(bisect_left(starts, start), bisect_left(starts, end)):
                if longer[k] != (start, end) and (best[k] is None or whole < best[k]):
                    best[k] = whole
    without = {}
    for (a, b), score in zip(longer, best):
        piece = word[a:b]
        if piece not in without:
            once = word.find(piece, word.find(piece) + 1) < 0
            without[piece] = score if once else _viterbi(word, scores, longest, start_score, piece)[1]
    return pieces, ahead[n], without


def _viterbi_row(word: str, scores: dict[str, float], longest: int, start_score: float, unknown: str, removals: bool) -> dict:
    if not removals:
        pieces, score = _viterbi(word, scores, longest, start_score)
        return {"pieces": pieces or [unknown], "score": score}
    pieces, score, without = _viterbi_removals(word, scores, longest, start_score)
    return {"pieces": pieces or [unknown], "score": score, "without": [{"token": t, "score": s} for t, s in sorted(without.items())]}


def _viterbi_fields(removals: bool) -> tuple[str, pa.DataType]:
    fields = [("pieces", pa.list_(pa.string())), ("score", pa.float64())]
    returns = "pieces array<string>, score double"
    if removals:
        fields.append(("without", pa.list_(pa.struct([("token", pa.string()), ("score", pa.float64())]))))
        returns += ", without array<struct<token: string, score: double>>"
    return returns, pa.struct(fields)


def viterbi_words(words: DataFrame, scores: dict[str, float], start_score: float = 1.0, unknown: str = "<unk>",
                  removals: bool = False) -> DataFrame:
    """Add ``pieces`` and ``score`` to a table of distinct words.

    With ``removals`` also ``without``: for each piece of two or more characters, the
    score of the best path that avoids it.
    """
    shared = words.sparkSession.sparkContext.broadcast(scores)
    longest = max((len(t) for t in scores), default=1)
    returns, kind = _viterbi_fields(removals)

    @F.arrow_udf(returns)
    def code(batch: pa.Array) -> pa.Array:
        return pa.array([_viterbi_row(w, shared.value, longest, start_score, unknown, removals) for w in batch.to_pylist()], kind)

    return words.withColumn("_coded", code(F.col("word"))).select("*", "_coded.*").drop("_coded")


def viterbi_words_join(words: DataFrame, model: DataFrame, start_score: float = 1.0, unknown: str = "<unk>", removals: bool = False) -> DataFrame:
    """``viterbi_words`` for a ``model(token, neg_log_p)`` of any size: each word meets the tokens that it holds in a join."""
    returns, kind = _viterbi_fields(removals)
    keyed = words.withColumn("_key", F.md5("word"))
    entries = model.select(F.col("token").alias("_token"), F.struct("token", "neg_log_p").alias("_entry"))
    found = _found_entries(keyed.select("_key", F.col("word").alias("_word")), entries)

    @F.arrow_udf(returns)
    def code(batch: pa.Array, local: pa.Array) -> pa.Array:
        rows = []
        for word, own in zip(batch.to_pylist(), local.to_pylist()):
            scores = {e["token"]: e["neg_log_p"] for e in own or []}
            rows.append(_viterbi_row(word, scores, max(map(len, scores), default=1), start_score, unknown, removals))
        return pa.array(rows, kind)

    coded = keyed.join(found, "_key", "left").withColumn("_coded", code("word", "_entries"))
    return coded.select(*words.columns, "_coded.*")


def encode_unigram(df: DataFrame, words: Column, model: DataFrame, start_score: float = 1.0, unknown: str = "<unk>",
                   out: str = "pieces") -> DataFrame:
    """Add ``out``: the most likely pieces of every word under ``model(token, neg_log_p)``."""
    scores = {r.token: r.neg_log_p for r in bounded_rows(model.select("token", "neg_log_p"))}
    shared = df.sparkSession.sparkContext.broadcast(scores)
    longest = max((len(t) for t in scores), default=1)

    return df.withColumn(out, _word_encoder(lambda w: _viterbi(w, shared.value, longest, start_score)[0] or [unknown])(words))


# Characters of a word that are cut into substrings together.
CHUNK = 256


def _found_entries(distinct: DataFrame, entries: DataFrame) -> DataFrame:
    """_key, _entries: the entries whose ``_token`` is a substring of the word, for ``distinct(_key, _word)``."""
    longest = entries.agg(F.max(F.length("_token"))).first()[0] or 1  # a plan inside the lambdas below is not allowed
    at = F.sequence(F.lit(1), F.greatest(F.length("_word"), F.lit(1)), F.lit(CHUNK))
    chunks = distinct.select("_key", F.explode(F.transform(at, lambda i: F.substring("_word", i, F.lit(CHUNK - 1 + longest)))).alias("_chunk"))
    starts = chunks.select("_key", "_chunk", F.explode(F.sequence(F.lit(1), F.greatest(F.least(F.length("_chunk"), F.lit(CHUNK)), F.lit(1)))).alias("_at"))
    ends = F.least(F.lit(longest), F.length("_chunk") - F.col("_at") + 1)
    parts = starts.select("_key", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(ends, F.lit(1))), lambda n: F.substring("_chunk", F.col("_at"), n))).alias("_token"))
    return parts.join(entries, "_token").groupBy("_key").agg(F.collect_set("_entry").alias("_entries"))


# Words that are encoded together, with the entries found in any of them.
WORD_BLOCK = 16_384


def _encode_join(df: DataFrame, id_col: str, words: Column, entries: DataFrame, encoder, unknown: list[str], out: str) -> DataFrame:
    """id_col, ``out``: pieces per word, by ``encoder(entries found in the words of a block)``, a function of a word.

    ``entries`` holds ``_token``, the text to be found in a word, and ``_entry``, what is handed on. Distinct words are
    numbered and cut into substrings no longer than the longest token; these meet the entries in a join under the
    number of their block, so a long word is not copied. The entries of a block are at most the substrings of its
    words or the vocabulary; those that a word does not hold change nothing for it.
    """
    entries = cut_lineage(entries)

    def pieces(distinct: DataFrame) -> DataFrame:
        numbered = cut_lineage(distinct.withColumn("_key", F.expr(f"monotonically_increasing_id() div {WORD_BLOCK}")))
        found = _found_entries(numbered.select("_key", F.col("_item").alias("_word")).filter("_word IS NOT NULL"), entries)
        found = found.select(F.col("_key").alias("_of"), "_entries")
        rest = [f for f in numbered.schema.fields if f.name not in ("_item", "_key")]
        returns = StructType([*rest, StructField("_value", ArrayType(StringType()))])
        kind = to_arrow_schema(returns)

        def code(left: pa.Table, right: pa.Table) -> pa.Table:
            encode = encoder(right.column("_entries")[0].as_py() if right.num_rows else [])
            values = pa.array([unknown if w is None else encode(w) for w in left.column("_item").to_pylist()], pa.list_(pa.string()))
            return left.select([f.name for f in rest]).append_column("_value", values).cast(kind)

        return numbered.groupBy("_key").cogroup(found.groupBy("_of")).applyInArrow(code, returns)

    return look_up(df, id_col, words, pieces, "array<string>", out)


def encode_wordpiece_join(df: DataFrame, id_col: str, words: Column, vocab: DataFrame, prefix: str = "##", unknown: str = "[UNK]",
                          out: str = "pieces") -> DataFrame:
    """id_col (unique) and the pieces of ``encode_wordpiece``, for a ``vocab(token)`` of any size."""
    inner = vocab.filter(F.col("token").startswith(prefix)).select(F.substring("token", F.lit(len(prefix) + 1), F.length("token")).alias("_token"), F.col("token").alias("_entry"))
    entries = vocab.select(F.col("token").alias("_token"), F.col("token").alias("_entry")).union(inner)

    def encoder(found: list[str]):
        known, longest = set(found), max(map(len, found), default=1)
        return lambda word: _longest_match(word, known, longest, prefix, unknown)

    return _encode_join(df, id_col, words, entries, encoder, [unknown], out)


def encode_bpe_join(df: DataFrame, id_col: str, words: Column, merges: DataFrame, out: str = "pieces") -> DataFrame:
    """id_col (unique) and the pieces of ``encode_bpe``, for ``merges(rank, left, right)`` of any number."""
    entries = merges.select(F.concat("left", "right").alias("_token"), F.struct("rank", "left", "right").alias("_entry"))

    def encoder(found: list[dict]):
        ranks: dict[tuple[str, str], int] = {}
        for rule in sorted(found, key=lambda r: r["rank"]):
            ranks.setdefault((rule["left"], rule["right"]), rule["rank"])
        return lambda word: _bpe_word(word, ranks)

    return _encode_join(df, id_col, words, entries, encoder, [], out)


def encode_unigram_join(df: DataFrame, id_col: str, words: Column, model: DataFrame, start_score: float = 1.0, unknown: str = "<unk>",
                        out: str = "pieces") -> DataFrame:
    """id_col (unique) and the pieces of ``encode_unigram``, for a ``model(token, neg_log_p)`` of any size."""
    entries = model.select(F.col("token").alias("_token"), F.struct("token", "neg_log_p").alias("_entry"))

    def encoder(found: list[dict]):
        scores = {e["token"]: e["neg_log_p"] for e in found}
        longest = max(map(len, scores), default=1)
        return lambda word: _viterbi(word, scores, longest, start_score)[0] or [unknown]

    return _encode_join(df, id_col, words, entries, encoder, [unknown], out)


def original_spans(spans: ColumnOrName, places: ColumnOrName) -> Column:
    """Spans of a normalised text as spans of its original; ``places`` comes from ``normalized_places``."""
    places = _col(places)
    return F.transform(_col(spans), lambda s: F.struct(
        F.coalesce(F.get(places, s["start"]), s["start"]).alias("start"), F.coalesce(F.get(places, s["end"] - 1) + 1, s["end"]).alias("end")))


def _list_bounds(lists: pa.ListArray) -> np.ndarray:
    bounds = lists.offsets.to_numpy().astype("int64")
    return bounds - bounds[0]


@F.arrow_udf(ArrayType(IntegerType()))
def _word_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for start, n in row_slices(batch):
            part = batch.slice(start, n)
            words, rows = part.flatten(), _list_bounds(part)
            pieces = _list_bounds(words)
            numbers = np.arange(len(words)) - np.repeat(rows[:-1], np.diff(rows))
            yield pa.ListArray.from_arrays(pa.array(pieces[rows], pa.int32()), pa.array(np.repeat(numbers, np.diff(pieces)), pa.int32()),
                                           mask=part.is_null() if part.null_count else None)


def word_ids(pieces: ColumnOrName) -> Column:
    """Word index of every piece."""
    return _word_ids(_col(pieces))


def piece_spans(pieces: ColumnOrName, words: ColumnOrName, unknown: str = "[UNK]") -> Column:
    """Character spans (start, end) of every piece; an unknown piece covers its word.

    ``words`` is the array of (token, start, end) that was encoded, one for each list of pieces. Widths are added up
    over the flat buffers, by slices of rows.
    """
    @F.arrow_udf(ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))
    def spans(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, firsts, lasts in batches:
            for start, n in row_slices(batch):
                part, first, last = (x.slice(start, n) for x in (batch, firsts, lasts))
                coded, rows = part.flatten(), _list_bounds(part)
                if not np.array_equal(rows, _list_bounds(first)):
                    raise ValueError("each word needs one list of pieces")
                flat, bounds = coded.flatten(), _list_bounds(coded)
                width = pc.utf8_length(flat).to_numpy().astype("int64") - 2 * pc.starts_with(flat, "##").to_numpy(zero_copy_only=False)
                ends = np.cumsum(width)
                before = np.concatenate([[0], ends])
                sizes = np.diff(bounds)
                shift = np.repeat(first.flatten().to_numpy().astype("int64") - before[bounds[:-1]], sizes)
                whole = pc.equal(flat, unknown).to_numpy(zero_copy_only=False)
                stops = np.where(whole, np.repeat(last.flatten().to_numpy(), sizes), ends + shift)
                found = pa.StructArray.from_arrays([pa.array(before[:-1] + shift, pa.int32()), pa.array(stops, pa.int32())], ["start", "end"])
                missing = pc.or_(part.is_null(), first.is_null())  # no words, no spans
                yield pa.ListArray.from_arrays(pa.array(bounds[rows], pa.int32()), found, mask=missing)

    words = _col(words)
    return spans(_col(pieces), words["start"], words["end"])


def dictionary_encode_join(df: DataFrame, id_col: str, tokens: Column, vocab: DataFrame, unk_id: int,
                           out: str = "input_ids") -> DataFrame:
    """id_col, ``out``: token ids by a left join of the distinct tokens with ``vocab(token, id)``, in order."""
    kind = vocab.schema["id"].dataType.simpleString()
    coded = look_up(df, id_col, tokens, table_values(vocab, "token", "id", F.lit(unk_id).cast(kind)), f"array<{kind}>", out)
    return coded.select(id_col, F.flatten(out).alias(out))


def decode_join(df: DataFrame, id_col: str, ids: Column, vocab: DataFrame, out: str = "tokens") -> DataFrame:
    """id_col, ``out``: tokens of an id array; an id outside the vocabulary gives a null."""
    decoded = look_up(df, id_col, ids, table_values(vocab, "id", "token", F.lit(None).cast("string")), "array<string>", out)
    return decoded.select(id_col, F.flatten(out).alias(out))


def detokenize_wordpiece(tokens: ColumnOrName, specials: tuple[str, ...] = ("[PAD]", "[CLS]", "[SEP]", "[MASK]"), unknown: str = "[UNK]") -> Column:
    """Text of wordpiece tokens: specials skipped, continuations glued on; a null token, of an id outside the vocabulary, is the unknown one."""
    kept = F.filter(F.transform(_col(tokens), lambda t: F.coalesce(t, F.lit(unknown))), lambda t: ~t.isin(*specials))
    return F.replace(F.array_join(kept, " "), F.lit(" ##"), F.lit(""))


def detokenize_metaspace(tokens: ColumnOrName) -> Column:
    """Concatenate, turn markers into spaces and drop the first one."""
    text = F.replace(F.array_join(_col(tokens), ""), F.lit("▁"), F.lit(" "))
    return F.regexp_replace(text, "^ ", "")
