"""Column transforms: dictionaries, flattened arrays and maps, tuples, null masks.

Global positions (dictionary indices, array offsets) come from sums over range-partitioned
data, never from one task that holds all rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def prefix_sum(df: DataFrame, key: str, amount: Column, name: str) -> DataFrame:
    """Adds the sum of `amount` over all rows with a smaller key; keys are unequal.

    Rows are cut into ranges of the key, whose totals (one a partition) are small enough to
    sum in one place.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = df.select(key).where(F.col(key).isNotNull()).orderBy(F.xxhash64(key)).limit(16 * parts).collect()  # the same sample each time
    sample = sorted(r[0] for r in picked)
    bounds = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    place = F.lit(0)
    for b in bounds:
        place = place + F.when(F.col(key) > F.lit(b), 1).otherwise(0)
    df = df.withColumn("_range", place).withColumn("_amount", amount)
    totals = df.groupBy("_range").agg(F.sum("_amount").alias("_total"))
    before = totals.select("_range", F.coalesce(F.sum("_total").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum("_amount").over(W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + own).drop("_range", "_amount", "_before")


def once(df: DataFrame) -> DataFrame:
    """The frame, worked out once: in the shared checkpoint folder where the session has one, else kept on the executors' disks."""
    where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not where:
        return df.persist(StorageLevel.DISK_ONLY)
    df.sparkSession.sparkContext.setCheckpointDir(where)
    return df.checkpoint()


def build_dictionary(df: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """(value, index): different values, numbered by first place in `order`, or by value; a null value gets index 0."""
    first = df.groupBy(F.col(column).alias("value")).agg(F.min(order if order else column).alias("first"))
    first = once(first)  # read four times below
    known = first.where("value IS NOT NULL")
    numbered = prefix_sum(known.withColumn("place", F.col("first")), "place", F.lit(1), "index")
    shift = F.coalesce(first.agg(F.max(F.when(F.col("value").isNull(), 1).otherwise(0))).scalar(), F.lit(0))
    out = numbered.select("value", (F.col("index") + shift).cast("int").alias("index"))
    return out.unionByName(first.where("value IS NULL").select("value", F.lit(0).alias("index")))


def key_width(size: Column) -> Column:
    """Bits of a dictionary's keys."""
    return F.when(size <= 1 << 8, 8).when(size <= 1 << 16, 16).when(size <= 1 << 32, 32).otherwise(64)


def encode(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Adds the key of each value; nulls have key 0 where the dictionary holds null."""
    named = dictionary.select(F.col("value").alias("_value"), F.col("index").alias("key"))
    return df.join(named, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def decode(df: DataFrame, key: str, dictionary: DataFrame, name: str = "value") -> DataFrame:
    """Adds the value of each key; a key outside the dictionary raises."""
    named = dictionary.select(F.col("index").alias("_index"), F.col("value").alias("_value"), F.lit(True).alias("_there"))
    out = df.join(named, df[key] == F.col("_index"), "left")
    bad = F.raise_error(F.concat(F.lit("no such key: "), F.col(key).cast("string")))
    kind = out.schema["_value"].dataType
    return out.withColumn(name, F.when(F.col(key).isNull() | F.col("_there"), F.col("_value")).otherwise(bad.cast(kind))).drop("_index", "_value", "_there")


def array_offsets(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, length, end): end of each row's array in the flattened column, rows in key order."""
    size = F.coalesce(F.size(F.col(column)), F.lit(0)).cast("long")
    return prefix_sum(df.select(key, size.alias("length")), key, F.col("length"), "start").select(key, "length", (F.col("start") + F.col("length")).alias("end"))


def flatten(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, pos, value): the elements of all arrays."""
    return df.select(key, F.posexplode(column).alias("pos", "value"))


def rebuild(flat: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Arrays from flattened elements; keys without elements get empty arrays."""
    each = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("_got"))
    empty = F.array().cast(each.schema["_got"].dataType)
    return keys.select(key).join(each, key, "left").select(key, F.coalesce("_got", empty).alias(name))


def slice_arrays(flat: Column, offsets: Column) -> Column:
    """Arrays cut from one flattened array at cumulative ends."""
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(offsets, i))
    return F.transform(offsets, lambda end, i: F.slice(flat, (start(i) + 1).cast("int"), (end - start(i)).cast("int")))


def map_columns(column: Column | str) -> tuple[Column, Column]:
    c = F.col(column) if isinstance(column, str) else column
    return F.map_keys(c), F.map_values(c)


def map_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, name, value): the entries of all maps."""
    return df.select(key, F.explode(column).alias("name", "value"))


def rebuild_maps(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Maps from entries; of equal names the last by order of value is kept."""
    each = rows.groupBy(key, "name").agg(F.max("value").alias("value")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("_got"))
    empty = F.create_map().cast(each.schema["_got"].dataType)
    return keys.select(key).join(each, key, "left").select(key, F.coalesce("_got", empty).alias(name))


def zip_columns(columns: list[str], name: str = "tuple") -> Column:
    return F.struct(*columns).alias(name)


def unzip(df: DataFrame, column: str, arity: int | None = None) -> DataFrame:
    """The fields of a tuple as columns beside the others."""
    fields = df.schema[column].dataType.names
    if arity is not None and len(fields) != arity:
        raise ValueError(f"{column} has {len(fields)} fields, not {arity}")
    return df.select(*[c for c in df.columns if c != column], *[F.col(f"{column}.`{f}`").alias(f) for f in fields])


def split_nulls(df: DataFrame, column: str, placeholder) -> DataFrame:
    """Adds a null mask, and values with a placeholder under nulls."""
    return df.withColumn(f"{column}_mask", F.col(column).isNull()).withColumn(f"{column}_filled", F.coalesce(column, F.lit(placeholder)))


def combine_nulls(df: DataFrame, mask: str, filled: str, name: str) -> DataFrame:
    return df.withColumn(name, F.when(~F.col(mask), F.col(filled)))
