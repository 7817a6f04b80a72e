"""Session helpers: configuration, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "inkmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="inkmill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{_shared_root(spark)}/inkmill/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor costs one re-read and no replay.

    ``partitions`` sets the number of files, for a small table with much work per row.
    """
    if partitions:
        df = df.repartition(partitions)
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Split a scan that has fewer tasks than cores before CPU-heavy work.

    Tasks are counted by the scan's splits, not by files: an input of more bytes than cores times the
    split size has enough of them and is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers that may not have it on their path."""
    import os
    import shutil

    context = spark.sparkContext
    if getattr(context, "_inkmill_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    build = tempfile.mkdtemp(prefix="inkmill-zip-")
    archive = shutil.make_archive(os.path.join(build, "inkmill"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    context._inkmill_shipped = True
