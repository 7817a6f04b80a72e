"""Corpora that arrive as files: structured streaming forms of the stateless operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.text import contains_any
from ..operators.ordering import global_row_number


def stream_scan(spark: SparkSession, directory: str, schema: str, fmt: str = "json", pattern: str = "*",
                files_per_trigger: int = 100) -> DataFrame:
    """A stream over the files of a directory, or of all that a path pattern matches."""
    return (spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_trigger).load(directory))


def stream_map(stream: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns."""
    return stream.withColumns(columns)


def stream_retention(stream: DataFrame, text: str, keywords: list[str]) -> DataFrame:
    """Running total and kept rows of a keyword filter."""
    hit = contains_any(text, keywords)
    return stream.groupBy().agg(F.count("*").alias("total"), F.count_if(hit).alias("kept"))


def stream_interleave(*streams: DataFrame) -> DataFrame:
    """Rows of all streams as they arrive; drain_alternating sets them in strict alternation."""
    out = streams[0]
    for other in streams[1:]:
        out = out.unionByName(other)
    return out


def drain_alternating(streams: list[DataFrame], order_col: str, path: str, out: str = "position") -> DataFrame:
    """Row j of stream i at position j*k+i, until the shortest stream is used up, over all micro-batches.

    Rows of a stream are numbered as they arrive, inside a micro-batch by ``order_col`` (unique numbers). The state is
    the number of rows of each stream in each micro-batch: it is written with the batch, so a batch that is run again
    gets the same numbers, and no stream goes through one task.
    """
    spark, k = streams[0].sparkSession, len(streams)
    tagged = stream_interleave(*[s.withColumn("_stream", F.lit(i)) for i, s in enumerate(streams)])
    state = "_stream int, _seen bigint, batch bigint"

    def seen(until: int | None = None) -> DataFrame:
        known = spark.read.schema(state).parquet(f"{path}/seen")
        known = known if until is None else known.filter(F.col("batch") < until)
        return known.groupBy("_stream").agg(F.sum("_seen").alias("_seen"))  # a row per stream

    def number(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("_stream").agg(F.count("*").alias("_seen"))
        counts.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
        ranked = global_row_number(batch, order_col, ["_stream"], "_rn").join(F.broadcast(seen(batch_id)), "_stream", "left")
        place = (F.col("_rn") - 1 + F.coalesce("_seen", F.lit(0))) * k + F.col("_stream")
        ranked.withColumn(out, place).drop("_rn", "_seen", "_stream").write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    query = (tagged.writeStream.foreachBatch(number).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start())
    query.awaitTermination()
    schema = StructType([*streams[0].schema.fields, StructField(out, LongType())])
    if query.lastProgress is None and not query.recentProgress:
        return spark.createDataFrame([], schema)
    lengths = {r["_stream"]: r["_seen"] for r in seen().collect()}
    shortest = min(lengths.get(i, 0) for i in range(k))
    return spark.read.schema(schema).parquet(f"{path}/data").filter(F.col(out) < shortest * k).select(*schema.names)


def drain_to_parquet(stream: DataFrame, path: str) -> DataFrame:
    """Process what is there, exactly once, into a Parquet folder and read it back."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", f"{path}/data").option("checkpointLocation", f"{path}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def drain_latest(stream: DataFrame, path: str) -> DataFrame:
    """Process what is there and keep the complete result of the last micro-batch."""
    spark = stream.sparkSession

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    query = (stream.writeStream.outputMode("complete").foreachBatch(keep)
             .option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start())
    query.awaitTermination()
    result = spark.read.parquet(f"{path}/data")
    return result.filter(F.col("batch") == result.agg(F.max("batch")).scalar()).drop("batch")
