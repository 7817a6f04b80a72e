"""Corpus statistics that tokenizer training starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.once import compute_once
from ..session import cut_lineage
from .ordering import global_row_number


# Positions within a document, and symbols within a word, that a packed place holds.
POSITIONS, SYMBOLS = 1 << 28, 1 << 20
STEP = 12  # characters that frequent substrings grow by in one round
HEAD, MAX_HEADS = 3, 10_000  # characters counted first, and how many frequent ones of that length may be handed to tasks


def explode_tokens(df: DataFrame, keep: list[str], tokens: Column, pos: str, token: str) -> DataFrame:
    """One row per token.

    A plain explode would add a filter on the array's size below itself and so compute
    the array twice; the outer form does not, and its row for an empty array is dropped.
    """
    rows = df.select(*keep, F.posexplode_outer(tokens).alias(pos, token))
    return rows.filter(F.col(pos).isNotNull())


def word_freqs(df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """word, freq, first_seen: counted before the shuffle, so a hot word is cheap.

    ``first_seen`` packs document and position into one sortable number. A struct would
    say the same, but its minimum needs a sort of all tokens, while a number is
    aggregated by hash. Ids beyond 35 bits make it a decimal instead of a long.
    """
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    packs = low is None or (low >= -(1 << 35) and high < 1 << 35)
    doc = F.col(id_col).cast("bigint" if packs else "decimal(28,0)")
    tokens = explode_tokens(df, [id_col], words, "pos", "word")
    return tokens.groupBy("word").agg(
        F.count("*").alias("freq"), F.min(doc * F.lit(POSITIONS) + F.col("pos")).alias("first_seen"))


def first_place(first_seen: str = "first_seen") -> tuple[Column, Column]:
    """Document and position of the first occurrence."""
    pos = F.pmod(F.col(first_seen), F.lit(POSITIONS))
    return F.expr(f"({first_seen} - pmod({first_seen}, {POSITIONS}L)) div {POSITIONS}L").cast("bigint"), pos.cast("bigint")


def rank_words(freqs: DataFrame) -> DataFrame:
    """word, freq, rank: words numbered in the order of their first appearance.

    Statistics over a table with a rank also say where a symbol or pair comes first. The
    word table is written first, because ranking reads it three times.
    """
    doc, _ = first_place()
    table = cut_lineage(freqs).withColumn("_doc", doc)
    ranked = global_row_number(table, "_doc", out="rank", then=["first_seen"])
    return ranked.select("word", "freq", "rank")


def _sums(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Summed frequency per key and, where words are ranked, the first place."""
    first = [F.min(F.col("rank") * SYMBOLS + F.col(at)).alias("first")] if "rank" in rows.columns else []
    return rows.groupBy(*keys).agg(F.sum("freq").alias("freq"), *first)


def _ranked(df: DataFrame, *columns: str) -> list[str]:
    return [c for c in ("freq", "rank", *columns) if c in df.columns]


def symbols(word: Column, continuation: str = "") -> Column:
    """Characters of a word; all but the first carry the continuation prefix."""
    chars = F.split(word, "")
    if not continuation:
        return chars
    return F.transform(chars, lambda c, i: F.when(i > 0, F.concat(F.lit(continuation), c)).otherwise(c))


def alphabet(freqs: DataFrame, continuation: str = "") -> DataFrame:
    """Distinct symbols in code point order."""
    return freqs.select(F.explode_outer(symbols(F.col("word"), continuation)).alias("symbol")).distinct().orderBy("symbol")


def adjacent_freqs(splits: DataFrame) -> DataFrame:
    """left, right, freq (and first) over ``splits(syms, freq[, rank])``; right is null behind the last symbol.

    The table has one row per distinct pair, so whatever is derived from it is cheap.
    """
    rows = splits.select(*_ranked(splits), "syms", F.posexplode_outer("syms").alias("at", "left"))
    pairs = rows.select(*_ranked(rows, "at"), "left", F.get("syms", F.col("at") + 1).alias("right"))
    return _sums(pairs, ["left", "right"], "at")


def pair_freqs(splits: DataFrame) -> DataFrame:
    """left, right, freq (and first) of adjacent symbols."""
    return adjacent_freqs(splits).filter(F.col("right").isNotNull())


def letter_freqs(splits: DataFrame) -> DataFrame:
    return adjacent_freqs(splits).groupBy(F.col("left").alias("symbol")).agg(F.sum("freq").alias("freq"))


def pair_scores(splits: DataFrame) -> DataFrame:
    """left, right, freq, score (and first): pair frequency over the product of both symbol frequencies.

    The words are scanned once; both symbol frequencies come from the pair table.
    """
    return scored_pairs(adjacent_freqs(splits))


def scored_pairs(adjacent: DataFrame) -> DataFrame:
    """The scores of a table of ``adjacent_freqs``."""
    letters = adjacent.groupBy(F.col("left").alias("symbol")).agg(F.sum("freq").alias("symbol_freq"))
    lefts = adjacent.withColumn("left_freq", F.sum("freq").over(W.partitionBy("left"))).filter(F.col("right").isNotNull())
    joined = lefts.join(letters, F.col("right") == F.col("symbol"))
    product = F.col("left_freq").cast("double") * F.col("symbol_freq").cast("double")
    return joined.withColumn("score", F.col("freq") / product).drop("left_freq", "symbol", "symbol_freq")


def argmax_pair(pairs: DataFrame, score: str) -> DataFrame:
    """One row: the best pair, the first seen among equals."""
    best = F.max_by(F.struct("left", "right", score), F.struct(F.col(score), -F.col("first")))
    return pairs.agg(best.alias("best")).select("best.*")


def char_freqs(freqs: DataFrame) -> DataFrame:
    """token, freq (and first): characters weighted by word frequency."""
    chars = freqs.select(*_ranked(freqs), F.posexplode_outer(symbols(F.col("word"))).alias("at", "token"))
    return _sums(chars, ["token"], "at")


def subword_freqs(freqs: DataFrame, min_freq: int | None = None, top: int | None = None, step: int = STEP) -> DataFrame:
    """token, freq (and first): substrings of two or more characters, weighted by word frequency.

    With ``min_freq`` only those of at least this frequency, with ``top`` at least the ``top`` most frequent ones and
    all that tie with the last: they are grown ``step`` characters a round. A substring is never more frequent than
    its beginning, so only places go on whose beginning can still reach the bound. With neither, all substrings are
    listed, which is quadratic in a word's length.

    Substrings of two and three characters are counted first. Any longer one is no more frequent than each that it
    holds, so it is looked at only where all its three characters in a row reach the bound.
    """
    n = F.length("word")
    at = F.explode(F.sequence(F.lit(0), n - 2)).alias("at")
    token = F.substring(F.col("word"), F.col("at") + 1, F.col("size"))
    if min_freq is None and top is None:
        starts = freqs.filter(n >= 2).select("word", *_ranked(freqs), at)
        spans = starts.select("*", F.explode(F.sequence(F.lit(2), n - F.col("at"))).alias("size"))
        return _sums(spans.select(*_ranked(spans, "at"), token.alias("token")), ["token"], "at")
    words = cut_lineage(freqs.filter(n >= 2).select("word", *_ranked(freqs), F.monotonically_increasing_id().alias("_id")))

    def reached(found: DataFrame) -> int:
        if top is None:
            return min_freq
        last = found.orderBy(F.desc("freq")).limit(top).agg(F.min("freq"), F.count("*")).first()
        return max(min_freq or 0, last[0] if last[1] == top and top else 0)

    heads = words.select("*", at).select("*", F.explode(F.sequence(F.lit(2), F.least(F.lit(HEAD), n - F.col("at")))).alias("size"))
    found = cut_lineage(_sums(heads.select(*_ranked(heads, "at"), token.alias("token")), ["token"], "at"))
    bound, low = reached(found), HEAD + 1
    frequent = [r.token for r in found.filter((F.length("token") == HEAD) & (F.col("freq") >= bound)).select("token").limit(MAX_HEADS + 1).collect()]
    if not frequent:
        return found.filter(F.col("freq") >= bound)
    end = n
    longer = words.filter(n > HEAD)
    if len(frequent) <= MAX_HEADS:
        # A mark per place: whether the characters from there are frequent. The first other mark ends a substring.
        marks = F.transform(F.sequence(F.lit(1), n - HEAD + 1), lambda i: F.when(F.substring(F.col("word"), i, F.lit(HEAD)).isin(frequent), "1").otherwise("0"))
        longer = compute_once(longer, _marks=F.array_join(marks, ""))
        stop = F.expr("locate('0', _marks, at + 1)")
        end = F.when(stop == 0, n).otherwise(stop + HEAD - 2)
    places = longer.select("*", at).withColumn("_end", end).filter(F.col("_end") - F.col("at") >= low).select(*words.columns, "at", "_end")
    while True:
        longest = low + step - 1
        sizes = F.explode(F.sequence(F.lit(low), F.least(F.lit(longest), F.col("_end") - F.col("at")))).alias("size")
        spans = places.select("*", sizes).select("_id", *_ranked(places, "at"), "size", token.alias("token"))
        sums = cut_lineage(_sums(spans, ["token"], "at"))
        found = found.unionByName(sums)
        bound = reached(found)
        grown = sums.filter((F.length("token") == longest) & (F.col("freq") >= bound)).select("token")
        alive = cut_lineage(spans.filter(F.col("size") == longest).join(grown, "token", "left_semi").groupBy("_id").agg(F.collect_list("at").alias("_at")))
        # A place needs one character more to go on.
        alive = words.join(alive, "_id").withColumn("_at", F.filter("_at", lambda a: a + longest < n)).filter(F.size("_at") > 0)
        low = longest + 1
        if alive.isEmpty():
            return found.filter(F.col("freq") >= bound)
        places = alive.select(*words.columns, F.explode("_at").alias("at"), n.alias("_end"))


def subword_topn(freqs: DataFrame, size: int) -> DataFrame:
    """token, freq, first of ranked words: all characters and the most frequent substrings, ``size`` in all.

    Characters always stay, also where they are more than ``size``. The window ranks
    the ``size`` most frequent substrings and nothing else.
    """
    order = [F.desc("freq"), F.asc("first"), F.length("token")]
    chars = char_freqs(freqs)
    n_chars = chars.agg(F.count("*")).scalar()
    subwords = subword_freqs(freqs, top=size).orderBy(*order).limit(size)
    ranked = subwords.withColumn("_rank", F.row_number().over(W.orderBy(*order)))
    return chars.unionByName(ranked.filter(F.col("_rank") <= F.lit(size) - n_chars).drop("_rank"))


def wordpiece_test_vocab(freqs: DataFrame, n_subwords: int) -> DataFrame:
    """token: every character, initial and continued, and the most frequent substrings in both forms."""
    chars = freqs.select(F.explode_outer(symbols(F.col("word"))).alias("token")).distinct()
    top = subword_freqs(freqs, top=n_subwords).orderBy(F.desc("freq"), "token").limit(n_subwords).select("token")
    base = chars.unionByName(top)
    return base.unionByName(base.select(F.concat(F.lit("##"), "token").alias("token")))
