"""Sources: text formats, sharded and compressed files, catalogued data sets, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import spread
from .nested import list_items
from .quoted import quoted_records


def scan_csv(spark: SparkSession, files: dict[str, str | list[str]], schema: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Delimited files with a header; one entry per split. Empty fields are null.

    Files are read in pieces by many tasks. With ``multi_line`` quoted fields may hold newlines, and quotes stand
    around whole fields only (``quoted_records``).
    """
    options = {"sep": sep, "escape": '"'}

    def table(path: str | list[str]) -> DataFrame:
        if not multi_line:
            return spark.read.schema(schema).options(header=True, **options).csv(path)
        row = F.from_csv("record", schema, {**options, "multiLine": "true"})
        return quoted_records(spark, path).select(row.alias("_row")).select("_row.*")

    parts = [table(path).withColumn("split", F.lit(split)) for split, path in files.items()]
    return reduce(DataFrame.unionByName, parts)


def scan_text(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """One row per line, in a column ``text``."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return reader.text(path).withColumnRenamed("value", "text")


def scan_json(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """JSON Lines, nested; without a schema it is inferred by an extra pass."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def scan_json_field(spark: SparkSession, path: str | list[str], field: str, schema: str, whole_file: bool = True) -> DataFrame:
    """Rows kept as a list under one key of a JSON object; ``schema`` describes a row.

    The object is the whole file, read in pieces by many tasks (``list_items``), or one of many on lines of their own.
    """
    if whole_file:
        rows = list_items(spark, path, field).select(F.from_json("item", f"struct<{schema}>").alias("_row"))
    else:
        rows = spark.read.schema(f"`{field}` array<struct<{schema}>>").json(path).select(F.explode(field).alias("_row"))
    return rows.select("_row.*")


def scan_compressed(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON Lines in .gz or .zst files; such a file is one task, so few of them are spread out after the scan."""
    return spread(spark.read.schema(schema).json(path))


def scan_sharded(spark: SparkSession, shards: dict[str, str | list[str]], schema: str) -> DataFrame:
    """JSON Lines shards, a list or a glob per split."""
    parts = [spark.read.schema(schema).json(paths).withColumn("split", F.lit(split)) for split, paths in shards.items()]
    return reduce(DataFrame.unionByName, parts)


def scan_named_config(spark: SparkSession, root: str, name: str, config: str | None = None,
                      split: str | None = None) -> DataFrame:
    """A data set by name; config and split are partitions, so others are not read."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    if config is not None:
        df = df.filter(F.col("config") == config)
    return df if split is None else df.filter(F.col("split") == split)


def scan_local_rows(spark: SparkSession, rows: dict[str, list] | list, schema: str) -> DataFrame:
    """A small table from Python values: a dict of columns or a list of rows."""
    if isinstance(rows, dict):
        rows = list(zip(*rows.values()))
    return spark.createDataFrame(rows, schema)


def scan_lazy_head(df: DataFrame, n: int, order_col: str | None = None) -> DataFrame:
    """The first rows; without an order only as many partitions are read as needed."""
    return (df.orderBy(order_col) if order_col else df).limit(n)


def dataset_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows, columns, files and bytes of a Parquet data set; no file content is loaded for the sizes."""
    table = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    sizes = files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
    return sizes.select(table.agg(F.count("*")).scalar().alias("n_rows"),
                        F.lit(len(table.columns)).alias("n_columns"), "n_files", "n_bytes")
