"""Event-time streaming (extension): windows with watermarks, sessions, deduplication, foreachBatch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream; the files taken at once are bounded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def at(column: str = "ts") -> Column:
    """Event time as a zoned timestamp: watermarks refuse zoneless ones."""
    return F.col(column).cast("timestamp")


def windowed(df: DataFrame, time: str, size: str, keys: list[str], aggregates: list[Column], slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Aggregates over tumbling or sliding windows; in streams, rows later than `late` are dropped."""
    df = df.withColumn(time, at(time))
    if df.isStreaming:
        df = df.withWatermark(time, late)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = df.groupBy(window.alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def sessions(df: DataFrame, time: str, gap: str, keys: list[str], aggregates: list[Column], late: str = "1 hour") -> DataFrame:
    df = df.withColumn(time, at(time))
    if df.isStreaming:
        df = df.withWatermark(time, late)
    out = df.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in out.columns if c != "w"])


def deduplicated(df: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """First row of each key; in streams the state of a key is kept for `late` only."""
    if df.isStreaming:
        return df.withColumn(time, at(time)).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def run_once(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Take all there is, batch by batch, into a sink; the checkpoint makes a rerun go on where this ended."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
