"""Putting data sets together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .ordering import global_row_number


def concat_datasets(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates kept; columns are matched by name."""
    return reduce(DataFrame.unionByName, parts)


def interleave_datasets(parts: list[DataFrame], order_col: str, out: str = "position") -> DataFrame:
    """Row j of part i at position j*k+i, until the shortest part is used up."""
    k = len(parts)
    tagged = concat_datasets(*[p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    sizes = [F.count_if(F.col("_part") == i) for i in range(k)]
    shortest = tagged.agg(F.least(*sizes) if k > 1 else sizes[0]).scalar()
    ranked = global_row_number(tagged, order_col, ["_part"], "_rn")
    return (ranked.filter(F.col("_rn") <= shortest)
            .withColumn(out, (F.col("_rn") - 1) * k + F.col("_part")).drop("_rn", "_part"))


def assign_splits(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename splits; the others keep their names."""
    split = F.col("split")
    out = reduce(lambda acc, kv: acc.when(split == kv[0], kv[1]), renames.items(), F.when(F.lit(False), split))
    return df.withColumn("split", out.otherwise(split))


def split_off(df: DataFrame, **parts: DataFrame) -> DataFrame:
    """Add data sets as further splits; a split of the same name is replaced."""
    kept = df.filter(~F.col("split").isin(*parts))
    return concat_datasets(kept, *[p.withColumn("split", F.lit(name)) for name, p in parts.items()])
