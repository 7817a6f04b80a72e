"""Seeded shuffles, exact-size samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from .ordering import shuffled_row_number
from .selection import label_places


def shuffle_seeded(df: DataFrame, id_col: str, seed: int, out: str = "position") -> DataFrame:
    """A fixed permutation: each row with its 0-based position."""
    return shuffled_row_number(df, id_col, seed, out="_rn").withColumn(out, F.col("_rn") - 1).drop("_rn")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly the first n rows of the seeded permutation, in no order. Counts keys at once; no row is shuffled."""
    return label_places(df, id_col, seed, lambda total: [(n, "in")], "_in").filter("_in IS NOT NULL").drop("_in")


def train_test_split_frac(df: DataFrame, id_col: str, train_size: float, seed: int,
                          names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Exact split: floor(train_size * n) rows for training, the rest for testing. Counts keys at once; no row is shuffled."""
    return label_places(df, id_col, seed, lambda total: [(math.floor(train_size * total), names[0]), (total, names[1])], "split")


def train_test_split_abs(df: DataFrame, id_col: str, n_train: int, n_test: int, seed: int,
                         names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Absolute sizes; rows beyond both are left out where they are scanned, too few rows are an error at once."""
    def parts(total: int) -> list[tuple[int, str]]:
        if total < n_train + n_test:
            raise ValueError("fewer rows than train and test need")
        return [(n_train, names[0]), (n_train + n_test, names[1])]

    return label_places(df, id_col, seed, parts, "split").filter("split IS NOT NULL")
