"""Benchmark passages in documents, also with other numbers, names and units.

Texts are brought to tokens: a number becomes a number slot and a unit slot, a capitalised word a name slot, the rest
lower-case words without punctuation. Each window of ``WINDOW`` tokens is hashed in three forms and joined with those
of the benchmark: with all names as slots, with names inside a sentence as slots, and folded, where names are words
and a window with more than half of its tokens in number and unit slots holds their values. So a limit on slots
stops loose templates only, and a copy is found in any case and at any place of a sentence. Matches of all forms on
one diagonal (place in the text minus place in the item) cover tokens of the item; enough of them make a candidate.
A candidate counts if its slots are consistent: each value of the item stands for one value in the text wherever it
occurs; a unit that one side lacks is no value.

Texts are keyed by their digest, so copies meet in one group after a partial aggregate, and the text itself is
fetched again only for candidates with slots. Benchmark windows are broadcast only below a counted bound; beyond it
the join is a shuffle of (hash, digest, place) rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import compute_once
from ..session import cut_lineage
from .common import keeps_columns, text_of

WINDOW = 8
MIN_TOKENS = 13
BROADCAST_WINDOWS = 500_000
# Marks of slots, control characters that texts lose first.
NUMBER, UNIT, NAME, START, JOIN = "\x01", "\x02", "\x04", "\x05", "\x03"
UNITS = ("percent|km/h|mph|kg|mg|kilograms?|grams?|g|lbs?|pounds?|tons?|km|kilometers?|kilometres?|meters?|metres?|cm|mm|m|miles?|inch(?:es)?|feet|foot|ft|"
         "hours?|hrs?|h|minutes?|mins?|seconds?|secs?|s|days?|weeks?|months?|years?|dollars?|cents?|euros?|liters?|litres?|ml|l|degrees?")
_NUMBER = rf"[$€£]?([\p{{N}}{JOIN}]+)\s?((?:%|(?:{UNITS})(?![\p{{L}}\p{{N}}]))?)"
_INNER = r"(?<=[\p{L}\p{N},;:] )(\p{Lu}\p{Ll}[\p{L}\p{M}]*)"
_START = rf"(?<![\p{{L}}\p{{M}}\p{{N}}{NAME}])(\p{{Lu}}\p{{Ll}}[\p{{L}}\p{{M}}]*)"
_COUNTED = (NUMBER, UNIT, NAME)


def _tokens(text: Column) -> Column:
    """Tokens; the mark of a slot is followed by what stood there."""
    for mark in (*_COUNTED, START, JOIN):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    text = F.regexp_replace(text, r"(?<=\p{N})[.,:/](?=\p{N})", JOIN)
    text = F.regexp_replace(F.regexp_replace(text, _INNER, f" {NAME}$1 "), _START, f" {START}$1 ")
    text = F.replace(F.regexp_replace(text, _NUMBER, f" {NUMBER}$1 {UNIT}$2 "), F.lit(UNIT + "%"), F.lit(UNIT + "percent"))
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{M}}\p{{N}}{''.join(_COUNTED)}{START}{JOIN}]+", " "), " "), "")


def _plain(token: Column) -> Column:
    """A name as a word; numbers and units keep their marks."""
    return F.translate(token, NAME + START, "")


def _formed(df: DataFrame) -> DataFrame:
    """Adds the tokens of ``_text`` and their hashes in four forms of one length.

    _l: all values, names as words; _f: number and unit slots as marks; _o: names inside a sentence too; _t: all names.
    """
    df = compute_once(df, _v=_tokens(F.col("_text")))
    mark = lambda v: F.xxhash64(F.substring(v, 1, 1))
    # Marks sort before all other characters of a token, numbers and units before JOIN, names behind it.
    df = compute_once(df, "_v", _l=F.transform("_v", lambda v: F.xxhash64(F.when((v > NAME) & (v < "\x06"), F.substring(v, 2, 1 << 30)).otherwise(v))),
                      _m=F.filter(F.transform("_v", lambda v, i: F.when(v < "\x06", i)), lambda i: i.isNotNull()))
    of = lambda i: F.get("_v", i)
    return compute_once(
        df, "_v", "_l",
        _f=F.transform("_v", lambda v, i: F.when(v < JOIN, mark(v)).otherwise(F.get("_l", i))),
        _o=F.transform("_v", lambda v, i: F.when(v < START, mark(v)).otherwise(F.get("_l", i))),
        _t=F.transform("_v", lambda v, i: F.when(v < JOIN, mark(v)).when(v < "\x06", F.xxhash64(F.lit(NAME))).otherwise(F.get("_l", i))),
        _q=F.filter("_m", lambda i: of(i) < JOIN), _names=F.filter("_m", lambda i: (of(i) > JOIN) & (of(i) < START)),
        _starts=F.filter("_m", lambda i: of(i) >= START)).drop("_m")


def _over(places: str, last: Column, length: int) -> Column:
    """Starts of the windows over any of these ascending places; a window is listed at its first place."""
    def starts(p: Column, j: Column) -> Column:
        low, high = F.greatest(p - length + 1, F.coalesce(F.get(places, j - 1) + 1, F.lit(0))), F.least(p, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(places, starts))


def _window_rows(df: DataFrame, length: int) -> DataFrame:
    """_key, dpos, h of all windows of ``length`` tokens, folded; the other forms only where they differ.

    Windows over a name inside a sentence have their own form with names as marks, those over a sentence start that
    with all names as marks; windows full of slots also have their values.
    """
    none, last, least = F.array().cast("array<int>"), F.size("_t") - length, length // 2 + 1
    # From the places of the slots: a window holds too many if it spans ``least`` that follow each other.
    ends = F.transform(F.sequence(F.lit(0), F.size("_q") - least), lambda j: F.struct(F.get("_q", j).alias("a"), F.get("_q", j + least - 1).alias("b")))
    low, high = (lambda e: F.greatest(e["b"] - length + 1, F.lit(0))), (lambda e: F.least(e["a"], last))
    full = F.array_distinct(F.flatten(F.transform(ends, lambda e: F.when(low(e) <= high(e), F.sequence(low(e), high(e))).otherwise(none))))
    df = compute_once(df.filter(last >= 0), _full=F.when(F.size("_q") >= least, full).otherwise(none), _inner=_over("_names", last, length),
                      _first=_over("_starts", last, length))
    # The four forms in one array: a window is hashed in compiled code where it is exploded, not in a lambda.
    n, behind = F.size("_t"), lambda starts, k: F.transform(starts, lambda i: i + k * F.size("_t"))
    starts = F.concat(F.sequence(F.lit(0), last), behind("_inner", 1), behind("_first", 2), behind("_full", 3))
    df = compute_once(df, _n=n, _tokens=F.concat("_f", "_o", "_t", "_l"), _at=starts)
    each = df.select("_key", "_n", "_tokens", F.explode("_at").alias("_i"))
    return each.select("_key", F.pmod("_i", "_n").alias("dpos"), F.xxhash64(*[F.get("_tokens", F.col("_i") + k) for k in range(length)], F.lit(length)).alias("h"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """h, item_id, ipos, need, need_real, length, loose: the windows of each item.

    Templates (``loose``) have at least half of their tokens outside slots, a capitalised sentence start not counted.
    Folded windows are all there; those with more slots hold values. An item shorter than the window is one window of
    its own length. Items without a token give nothing.
    """
    items = _formed(benchmark.select("item_id", text_of("text").alias("_text"))).drop("_text")
    items = items.withColumn("n", F.size("_v")).filter("n > 0").withColumn("length", F.least(F.lit(window), F.col("n")))
    items = items.withColumn("n_real", F.col("n") - F.size(F.filter("_v", lambda v: v == UNIT)))
    starts = F.sequence(F.lit(0), F.col("n") - F.col("length"))
    cut = F.transform(starts, lambda i: F.struct(*[F.slice(name, i + 1, F.col("length")).alias(name) for name in ("_v", "_l", "_f", "_o", "_t")]))
    pieces = items.select("item_id", "n", "n_real", "length", F.posexplode(cut).alias("ipos", "_w")).select("item_id", "n", "n_real", "length", "ipos", "_w.*")

    def hashed(tokens: str) -> Column:
        out = F.xxhash64(F.lit(0))
        for length in range(1, window + 1):
            out = F.when(F.col("length") == length, F.xxhash64(*[F.get(tokens, F.lit(k)) for k in range(length)], F.lit(length))).otherwise(out)
        return out

    def light(below: str) -> Column:
        return 2 * F.size(F.filter("_v", lambda v: v < below)) <= F.col("length")

    templates = [F.struct(F.when(light(START), hashed(name)).alias("h"), F.lit(True).alias("loose")) for name in ("_t", "_o")]
    folded = F.struct(F.when(light(JOIN), hashed("_f")).otherwise(hashed("_l")).alias("h"), F.lit(False).alias("loose"))
    each = pieces.select(
        "item_id", "ipos", F.least(F.lit(min_tokens), F.col("n")).alias("need"), F.least(F.lit(min_tokens), F.col("n_real")).alias("need_real"), "length",
        F.inline(F.array(*templates, folded))).filter("h IS NOT NULL")
    return each.groupBy("h", "item_id", "ipos", "need", "need_real", "length").agg(F.max("loose").alias("loose"))


def _n_covered(at: Column | str) -> Column:
    """Tokens under windows of ``length`` that start at these ascending places."""
    gaps = F.transform(at, lambda p, i: F.least(F.col("length"), F.coalesce(F.get(at, i + 1) - p, F.col("length"))))
    return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)


def _slots_under(at: str) -> Column:
    return F.filter("slots", lambda s: F.exists(at, lambda p: (p <= s["i"]) & (s["i"] < p + F.col("length"))))


def _enough(df: DataFrame) -> DataFrame:
    """Lines that cover enough: ``need`` tokens by templates, or ``need_real`` by all windows, missing units not counted."""
    df = compute_once(df, slots=_slots_under("at"))
    real = _n_covered("at") - F.size(F.filter("slots", lambda s: s["v"] == UNIT))
    return df.withColumn("n_tokens", _n_covered("at")).filter((real >= F.col("need_real")) | (_n_covered("at_loose") >= F.col("need")))


def _without_conflicts(df: DataFrame) -> DataFrame:
    """The lines without windows over slots that break the consistency, where enough is left.

    Of several values in the text for one of the item, the most frequent one stands, at ties the item's own.
    """
    def main(i: Column) -> Column:
        own = F.filter("pairs", lambda p: p["i"] == i)
        votes = F.transform(own, lambda p: F.struct(F.size(F.filter("pairs", lambda q: (q["i"] == i) & q["d"].eqNullSafe(p["d"]))), p["d"].eqNullSafe(i), p["d"].alias("d")))
        return F.struct(i.alias("i"), F.array_max(votes)["d"].alias("d"))

    df = compute_once(df, _main=F.transform(F.array_distinct(F.transform("pairs", lambda p: p["i"])), main))
    broken = F.filter("pairs", lambda p: F.exists("_main", lambda m: (m["i"] == p["i"]) & ~m["d"].eqNullSafe(p["d"])))
    df = compute_once(df, _bad=F.transform(broken, lambda p: p["at"])).drop("_main")
    kept = {name: F.filter(name, lambda p: ~F.exists("_bad", lambda b: (p <= b) & (b < p + F.col("length")))) for name in ("at", "at_loose")}
    return _enough(compute_once(df, **kept).drop("_bad"))


def find_contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_tokens: int = MIN_TOKENS, text_col: str = "text",
                       broadcast_windows: int = BROADCAST_WINDOWS, mixed: bool = True) -> DataFrame:
    """``_key`` (digest of the text), item_id, n_windows, n_tokens and verbatim of every text that holds an item.

    A text holds an item if at least ``min_tokens`` tokens of it (all of a shorter item) match on one diagonal with
    consistent slots. Inconsistent slots cost the windows over them, without ``mixed`` the whole diagonal.
    ``verbatim`` is false if a slot has another value than in the item. Null and empty texts hold
    nothing; repeated texts are one key; null item ids are kept as an item of their own.
    """
    known = cut_lineage(benchmark_windows(benchmark, window, min_tokens))
    lengths = {r[0]: r[1] for r in known.groupBy("length").count().collect()}  # as many rows as window lengths
    side = known if sum(lengths.values()) > broadcast_windows else F.broadcast(known)
    keyed = df.select(F.md5(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text")).filter("_key IS NOT NULL")
    tokens = _formed(keyed).drop("_text", "_v")
    found = [_window_rows(tokens, n).join(side.filter(F.col("length") == n), "h") for n in sorted(lengths)]
    found = found or [tokens.select("_key", F.lit(0).alias("dpos")).join(side.withColumnRenamed("h", "_h"), F.lit(False))]
    match = reduce(DataFrame.unionByName, [
        f.select("_key", "item_id", (F.col("dpos") - F.col("ipos")).alias("shift"), "ipos", "need", "need_real", "length", "loose") for f in found])
    # At most one entry per window of the item.
    lines = match.groupBy("_key", "item_id", "shift").agg(
        F.array_sort(F.collect_set("ipos")).alias("at"), F.array_sort(F.collect_set(F.when(F.col("loose"), F.col("ipos")))).alias("at_loose"),
        F.max("need").alias("need"), F.max("need_real").alias("need_real"), F.max("length").alias("length"))
    lines = cut_lineage(lines.filter(_n_covered("at") >= F.col("need_real")))
    values = compute_once(benchmark.select("item_id", text_of("text").alias("_text")), _iv=_tokens(F.col("_text"))).drop("_text")
    places = F.filter(F.transform("_iv", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda s: F.substring(s["v"], 1, 1).isin(*_COUNTED, START))
    values = values.select("item_id", places.alias("slots"))
    slotted = _enough(lines.join(values, lines["item_id"].eqNullSafe(values["item_id"])).drop(values["item_id"]))
    open_ = slotted.filter(F.size("slots") > 0)
    # Written first, so that its size is known and the texts need no shuffle to meet few keys.
    wanted = cut_lineage(open_.select("_key").distinct())
    texts = keyed.join(wanted, "_key", "left_semi").groupBy("_key").agg(F.first("_text").alias("_text"))
    valued = compute_once(texts, _dv=_tokens(F.col("_text"))).drop("_text")
    pairs = F.transform("slots", lambda s: F.struct(s["i"].alias("at"), _plain(s["v"]).alias("i"), _plain(F.get("_dv", s["i"] + F.col("shift"))).alias("d")))
    checked = compute_once(open_.join(valued, "_key"), pairs=pairs).drop("_dv")
    # A unit that only one side names is no value.
    stated = F.filter("pairs", lambda p: (p["i"] != UNIT) & ~p["d"].eqNullSafe(F.lit(UNIT)))
    checked = compute_once(checked.withColumn("verbatim", F.forall("pairs", lambda p: p["i"].eqNullSafe(p["d"]))), pairs=stated)
    split = F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["i"], p["d"])))) > F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"])))
    checked = _without_conflicts(checked.filter(split)).unionByName(checked.filter(~split)) if mixed else checked.filter(~split)
    plain = slotted.filter(F.size("slots") == 0).withColumn("verbatim", F.lit(True))
    both = plain.select("_key", "item_id", "at", "n_tokens", "verbatim").unionByName(checked.select("_key", "item_id", "at", "n_tokens", "verbatim"))
    best = F.max(F.struct("n_tokens", F.size("at").alias("n_windows"), "verbatim"))
    return both.groupBy("_key", "item_id").agg(best.alias("b")).select(
        "_key", "item_id", F.col("b.n_windows").cast("long").alias("n_windows"), F.col("b.n_tokens").cast("long").alias("n_tokens"), F.col("b.verbatim").alias("verbatim"))


def contaminated_documents(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, n_windows, n_tokens, verbatim."""
    hits = cut_lineage(find_contamination(df, benchmark, **options))
    return df.select("doc_id", F.md5(options.get("text_col", "text")).alias("_key")).join(hits, "_key").drop("_key")


@keeps_columns("text_col")
def drop_contaminated(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item; null ids and repeated rows are judged by their text."""
    hits = cut_lineage(find_contamination(df, benchmark, **options).select("_key").distinct())
    keyed = df.withColumn("_key", F.md5(options.get("text_col", "text")))
    return keyed.join(hits, "_key", "left_anti").select(*df.columns)
