"""Shared pieces: shared-folder tables, id ranges, salted joins, Arrow helpers.

Everything that leaves a job goes through the shared folder named by
``spark.checkpoint.dir`` so that a lost executor costs recomputation, never data.
"""

from __future__ import annotations

import atexit
import ctypes
import inspect
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share; where none is set, a temporary one on a single machine and an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="colonnade-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_staged: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is there when this process ends is removed then."""
    if not _staged:
        atexit.register(_sweep, spark._jvm, spark._jsc.hadoopConfiguration())
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _staged.append(path)
    return path


def _remove(jvm, conf, path: str) -> None:
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def _sweep(jvm, conf) -> None:
    for path in _staged:
        try:
            _remove(jvm, conf, path)
        except Exception:  # the JVM is gone already: nothing more can be done from here
            return


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting, where Spark knows it, for as long as the block runs."""
    before = spark.conf.get(key, None)
    if before is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(key, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Shuffle files go when all is written; row groups are small, since a row may be a part's texts."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged() -> list[str]:
    """Paths in the shared folder that this process made and has not removed, oldest first."""
    return list(_staged)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged paths that no frame still to be run reads."""
    for path in paths:
        _remove(spark._jvm, spark._jsc.hadoopConfiguration(), path)
        if path in _staged:
            _staged.remove(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    drop_paths(df.sparkSession, [p for p in _staged if p.rsplit("/", 1)[-1] in names])


def open_fs(uri: str):
    """(pyarrow filesystem, path) of a shared folder; a bare path is local."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binaries(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, b"" for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


_libc = ctypes.CDLL(None)


def trim() -> None:
    """Give the memory that a task no longer uses back to the machine: idle Python workers would keep it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def trimmed(f: Callable) -> Callable:
    """A group function that trims when it is done; Spark wants to see how many arguments it takes."""

    def run(*args):
        try:
            return f(*args)
        finally:
            trim()

    return {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}[len(inspect.signature(f).parameters)]


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None], schema: str | T.StructType) -> DataFrame:
    """mapInArrow of a per-batch function that returns columns by name; big batches are cut first."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                out = f(batch.slice(at, 2000))
                if out is not None:
                    yield pa.RecordBatch.from_arrays([as_array(out[c.name], c.type) for c in target], schema=target)

    return df.mapInArrow(run, kind)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


@dataclass
class Ranges:
    """Consecutive ranges of an integer key. A range that is one heavy key is dealt over several parts, and so are the null keys."""

    bounds: np.ndarray  # inclusive upper bounds
    splits: np.ndarray  # parts of each range
    null_splits: int
    total: float  # weight of all rows

    def __post_init__(self):
        self.base = np.concatenate(([0], np.cumsum(self.splits)))[:-1].astype(np.int64)

    def place(self, keys: pa.Array, salts: np.ndarray) -> np.ndarray:
        """Part of each row, in key order; null keys have negative parts."""
        null = keys.is_null().to_numpy(zero_copy_only=False)
        out = -1 - (salts % np.uint64(max(1, self.null_splits))).astype(np.int64)
        if len(self.bounds) and not null.all():
            at = np.searchsorted(self.bounds, keys.fill_null(int(self.bounds[0])).to_numpy(zero_copy_only=False))
            out = np.where(null, out, self.base[at] + (salts % self.splits[at].astype(np.uint64)).astype(np.int64))
        return out


def _sums(thin: DataFrame, cells) -> list[tuple[int, float]]:
    """(cell, weight in all) for cells that are a broadcast (lowest keys, highest keys); summed by batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = cells.value
        for batch in batches:
            k, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "w"))
            at = np.minimum(np.searchsorted(high, k), len(high) - 1)
            inside = (low[at] <= k) & (k <= high[at])
            found, at = np.unique(at[inside], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(np.bincount(at, w[inside], minlength=len(found)))], names=["cell", "w"])

    sums = thin.where("k IS NOT NULL").mapInArrow(run, "cell int, w double").groupBy("cell").agg(F.sum("w").alias("w")).collect()
    return sorted(map(tuple, sums))


def ranges(df: DataFrame, key: str, weight: Column, target: float, cells: int = 4096, most: int = 1 << 18) -> Ranges:
    """Ranges of about `target` weight each, or of a `most`-th of the whole where that is more.

    Exact and repeatable. Keys and weights are written out once; then weights are summed in equal-width cells of the
    key, and all cells above twice the target are cut into 64 together, in one job a round: two rounds where keys
    are spread evenly, at most ten for any 64-bit keys. What reaches the driver is a number of sums in proportion to the ranges, of which there are `most` or so.
    """
    thin = stage_table(df.select(F.col(key).cast("long").alias("k"), weight.cast("double").alias("w")), "weights")
    lo, hi, total, empty = thin.agg(F.min("k"), F.max("k"), F.sum("w"), F.sum(F.when(F.col("k").isNull(), F.col("w")))).first()
    target = max(target, (total or 0.0) / most)
    null_splits = max(1, int(np.ceil((empty or 0.0) / (2 * target))))
    done: list[tuple[int, float, bool]] = []
    open_ = [] if lo is None else [(lo, hi)]
    step = cells
    while open_:
        lows, highs = [], []
        for a, b in open_:
            width = max(1, -(-(b - a + 1) // step))
            lows += range(a, b + 1, width)
            highs += [min(b, x + width - 1) for x in range(a, b + 1, width)]
        held = df.sparkSession.sparkContext.broadcast((np.array(lows, np.int64), np.array(highs, np.int64)))

        open_, step = [], 64
        for n, w in _sums(thin, held):
            if w > 2 * target and highs[n] > lows[n]:
                open_.append((lows[n], highs[n]))
            else:
                done.append((highs[n], w, highs[n] == lows[n]))
        held.unpersist()
    drop_table(thin)
    bounds, splits, weight_held, last = [], [], 0.0, None
    for b, w, single in sorted(done):
        heavy = single and w > 2 * target
        if last is not None and (heavy or weight_held + w > target):
            bounds.append(last)
            splits.append(1)
            last, weight_held = None, 0.0
        if heavy:
            bounds.append(b)
            splits.append(int(np.ceil(w / target)))
        else:
            last, weight_held = b, weight_held + w
    if last is not None:
        bounds.append(last)
        splits.append(1)
    if bounds:
        bounds[-1] = hi
    return Ranges(np.array(bounds, np.int64), np.array(splits, np.int64), null_splits, float(total or 0.0))


def hot_keys(counted: DataFrame, key: str, count: str, total: int, share: int) -> list:
    """Keys with more than a `share`-th of all rows: fewer than `share` of them, whatever the data."""
    floor = max(100, total // share)
    return [r[0] for r in counted.where(F.col(count) > floor).select(key).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: list, salts: int, by: str, how: str = "inner") -> DataFrame:
    """Join with one row a key on the small side; rows of hot keys are dealt over `salts` tasks by column `by`."""
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    big = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(0).cast("int"))
    small = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return big.join(small, [key, "_salt"], how).drop("_salt")


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def pow2(x: float) -> int:
    """Smallest power of two that is x or more."""
    return 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted different values; a sort is many times faster here than numpy's hashed unique()."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def to_ipc(batch: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs])


def wide_texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Strings with 64-bit offsets, so that a part may hold more than 2 GB of text."""
    kinds = [pa.field(f.name, pa.large_string() if pa.types.is_string(f.type) else f.type) for f in batch.schema]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, kinds)], schema=pa.schema(kinds))


def packed(df: DataFrame, parts: Ranges, key: str, salt: str) -> DataFrame:
    """(part, rows): the rows of each part as compressed Arrow streams, made without a shuffle; `salt` is a long column that deals rows of heavy keys, and is dropped."""
    held = df.sparkSession.sparkContext.broadcast(parts)  # bounded by the number of ranges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = held.value.place(batch.column(key), batch.column(salt).to_numpy(zero_copy_only=False).view(np.uint64))
            rest = wide_texts(batch.select([c for c in batch.schema.names if c != salt]))
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            groups = np.split(order, cuts) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[g[0]]) for g in groups], pa.int64()), pa.array([to_ipc(rest.take(pa.array(g))) for g in groups], pa.binary())], names=["part", "rows"]
            )

    return df.mapInArrow(run, "part long, rows binary")
