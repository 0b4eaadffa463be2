"""Sinks: Parquet with a chosen codec, sorted and bucketed tables, staged commits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..errors import ValidationError

#: Codec -> levels it takes.
CODECS = {"none": None, "lz4": None, "lz4hc": range(0, 13), "zstd": range(1, 23), "snappy": None, "gzip": range(1, 10)}


def compression(method: str = "lz4", level: int | None = None) -> dict[str, str]:
    """Parquet options of a codec; lz4hc is written as lz4, which readers cannot tell from it."""
    if method not in CODECS:
        raise ValidationError(f"unknown compression {method}", kind="invalid_compression")
    if level is not None and (CODECS[method] is None or level not in CODECS[method]):
        raise ValidationError(f"{method} has no level {level}", kind="invalid_compression")
    options = {"compression": {"lz4hc": "lz4_raw", "lz4": "lz4_raw"}.get(method, method)}
    if level is not None and method in ("zstd", "gzip"):
        options[{"zstd": "parquet.compression.codec.zstd.level", "gzip": "zlib.compress.level"}[method]] = str(level)
    return options


def write_parquet(df: DataFrame, path: str, method: str = "lz4", level: int | None = None, partition_by: list[str] | None = None, sort_by: list[str] | None = None, mode: str = "overwrite") -> None:
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode(mode).options(**compression(method, level)).partitionBy(*(partition_by or [])).parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, sort_by: list[str] | None = None) -> None:
    """A table dealt by key, so that later joins and groupings on it need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    (writer.sortBy(*sort_by) if sort_by else writer).saveAsTable(table)


def commit(df: DataFrame, path: str) -> None:
    """Write beside the target and rename when whole, so readers see all rows or none."""
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    temp, final = jvm.Path(f"{path}.{uuid.uuid4().hex}.tmp"), jvm.Path(path)
    df.write.parquet(temp.toString())
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(final):
        fs.delete(temp, True)
        raise ValidationError(f"{path} exists", kind="target_exists")
    if not fs.rename(temp, final):
        raise OSError(f"{path} can't be renamed into place")
