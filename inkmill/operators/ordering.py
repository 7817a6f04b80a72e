"""Row order at scale: global row numbers without a one-task window.

A row number over a whole table would normally send every row to one task. Here
each row gets a bucket that is a pure function of its order key, buckets are
counted (key columns only), the counts are summed up over at most ``MAX_BUCKETS``
rows per group, and the exact rank is the bucket's offset plus the rank inside
the bucket. No bucket assignment depends on partition ids or on sampling inside a
task, so a recomputed task gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..functions.scalars import hex_to_long, md5_key

MAX_BUCKETS = 16384
MAX_EDGES = 4096  # keys that part the ranges of batches


def _rank_in_buckets(df: DataFrame, bucket: Column, order: list[Column], groups: list[str], out: str) -> DataFrame:
    keyed = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*groups).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)] + [F.col("_bucket") == F.col("_b")]
    joined = keyed.join(offsets, same)
    local = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    ranked = joined.withColumn(out, F.col("_offset") + local)
    return ranked.drop("_bucket", "_offset", "_b", *[f"_g{i}" for i in range(len(groups))])


def _quantile_bucket(df: DataFrame, key: str, n_buckets: int) -> Column:
    """Number of quantile boundaries at or below the key, by binary search."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    edges = sorted(set(df.approxQuantile(key, probs, 1 / (4 * n_buckets))))
    if not edges:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(repr, edges))), ",").cast("array<double>")
    steps = [1 << b for b in reversed(range(len(edges).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, step: F.when(F.get(table, low + step - 1) <= F.col(key).cast("double"), low + step).otherwise(low))


def global_row_number(df: DataFrame, order_col: str, groups: list[str] | None = None, out: str = "row_no",
                      n_buckets: int | None = None, then: list[str] | None = None) -> DataFrame:
    """Exact 1-based row number in the order of a numeric column, unique by itself or with the columns ``then``.

    ``groups`` restarts the numbering for each value, e.g. for each split. The
    bucket edges are approximate quantiles; they decide the balance only.
    """
    if n_buckets is None:
        n_buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = _quantile_bucket(df, order_col, max(2, min(n_buckets, MAX_BUCKETS)))
    return _rank_in_buckets(df, bucket, [F.col(c) for c in [order_col, *(then or [])]], groups or [], out)


def shuffled_row_number(df: DataFrame, id_col: str, seed: int, groups: list[str] | None = None,
                        out: str = "row_no") -> DataFrame:
    """Exact 1-based row number in the order of md5(seed:id), ties by id.

    The first digits of the digest are the bucket: uniform without looking at the
    data first.
    """
    keyed = df.withColumn("_digest", md5_key(seed, id_col))
    bucket = F.shiftright(hex_to_long(F.col("_digest"), 4), 2)
    return _rank_in_buckets(keyed, bucket, [F.col("_digest"), F.col(id_col)], groups or [], out).drop("_digest")


def batch_assign(df: DataFrame, batch_size: int, order_col: str, groups: list[str] | None = None,
                 out: str = "batch_id") -> DataFrame:
    """Consecutive rows in batches of a fixed size, per group."""
    ranked = global_row_number(df, order_col, groups, "_rn")
    return ranked.withColumn(out, F.floor((F.col("_rn") - 1) / batch_size).cast("bigint")).drop("_rn")


def batch_ranges(df: DataFrame, batch_size: int, order_col: str, groups: list[str] | None = None, out: str = "range_start") -> DataFrame:
    """Add the number of the first batch of the range that a row lies in; a range holds whole batches of ``batch_assign``.

    Rows are numbered by their keys alone, and the keys where ranges begin, at most
    ``MAX_EDGES``, go to every task, so no row is shuffled here. Ranges do not begin
    between equal keys.
    """
    groups = groups or []
    size = batch_size * max(1, -(-df.count() // (batch_size * MAX_EDGES)))
    numbered = global_row_number(df.select(*groups, order_col), order_col, groups, "_rn")
    cuts = numbered.filter((F.col("_rn") % size == 0) | ((F.col("_rn") > 1) & ((F.col("_rn") - 1) % size == 0)))
    at = {(tuple(r[g] for g in groups), r["_rn"]): r[order_col] for r in cuts.select(*groups, order_col, "_rn").collect()}
    edges: dict[tuple, list[tuple]] = {}
    for (group, number), key in sorted(at.items(), key=lambda e: e[0][1]):
        before = at.get((group, number - 1))
        if (number - 1) % size == 0 and number > 1 and key != before and not (key != key and before != before):
            edges.setdefault(group, []).append((key, (number - 1) // batch_size))
    fields = [StructField(f"_g{i}", df.schema[g].dataType) for i, g in enumerate(groups)]
    fields += [StructField("_edges", ArrayType(df.schema[order_col].dataType)), StructField("_starts", ArrayType(LongType()))]
    rows = [(*group, [k for k, _ in own], [0, *(b for _, b in own)]) for group, own in edges.items()]
    table = F.broadcast(df.sparkSession.createDataFrame(rows, StructType(fields)))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    joined = df.join(table, same or F.lit(True), "left")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(MAX_EDGES.bit_length()))])
    place = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get("_edges", low + step - 1) <= F.col(order_col), low + step).otherwise(low))
    return joined.withColumn(out, F.coalesce(F.get("_starts", place), F.lit(0).cast("bigint"))).select(*df.columns, out)


def running_offset(df: DataFrame, size: Column, batch_cols: list[str], order_col: str, out: str = "offset") -> DataFrame:
    """Start of each row's array inside the concatenation of its batch."""
    before = W.partitionBy(*batch_cols).orderBy(order_col).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(size).over(before), F.lit(0)))


def rank_within_group(df: DataFrame, groups: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each group; only k rows per group and task are shuffled on."""
    ranked = df.withColumn(out, F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)
