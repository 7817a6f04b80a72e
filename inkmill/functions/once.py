"""Keep Catalyst from copying a computed column into a lambda.

Adjacent projections are merged, and a column that is used once is inlined where it is
used. Inside ``transform`` or ``filter`` that place is evaluated per element, which
makes a linear operator quadratic. A generator of one row keeps the two apart: the
columns below are computed once per row, and lambdas above read them as attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, *existing: str, **columns: Column) -> DataFrame:
    """Add columns, or fix existing ones, so that each is evaluated once per row."""
    named = {**{name: F.col(name) for name in existing}, **columns}
    rest = [c for c in df.columns if c not in named]
    row = F.struct(*[value.alias(name) for name, value in named.items()])
    return df.select(*rest, F.explode(F.array(row)).alias("_once")).select(*rest, "_once.*")
