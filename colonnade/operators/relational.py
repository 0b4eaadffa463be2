"""Relational operators that one Spark call doesn't give: totals, extremes, top-k, as-of and range joins, skewed joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import EngineError


def group_with_totals(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    """The groups and, with is_total, a row over all rows whose keys are null; both from one pass over the rows."""
    both = df.groupingSets([[F.col(k) for k in keys], []], *keys).agg(F.grouping_id().alias("_level"), *aggregates)
    return both.select(*keys, (F.col("_level") > 0).alias("is_total"), *[c for c in both.columns if c not in (*keys, "_level")])


def extremes_of(df: DataFrame) -> DataFrame:
    """Two rows, the least and the greatest value of each column, from one pass; null for columns without order."""
    index = [f"_c{i}" for i in range(len(df.columns))]
    named = df.toDF(*index)
    ordered = {f.name: f.dataType.typeName() not in ("map", "variant", "void") for f in named.schema}
    pick = lambda agg, name: F.struct(F.lit(name).alias("extreme"), *[(agg(c) if ordered[c] else F.lit(None)).alias(c) for c in index])
    both = named.agg(pick(F.min, "min").alias("low"), pick(F.max, "max").alias("high"))
    return both.select(F.explode(F.array("low", "high")).alias("row")).select("row.*")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows: each task keeps k, so no full sort takes place."""
    return df.orderBy(*order).limit(k)


def limit_by(df: DataFrame, k: int, keys: list[str], *order: Column) -> DataFrame:
    """The first k rows of each group; tasks drop all others before the shuffle."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def numbers(spark: SparkSession, size: int, start: int = 0) -> DataFrame:
    return spark.range(start, start + size).select(F.col("id").alias("number"))


def as_of_join(left: DataFrame, right: DataFrame, on: str, time: str, values: list[str], cell: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time.

    Both sides go through one shuffle and a running last value, so rows never meet in pairs. `cell`, a rising function of time such as
    its day, spreads a key's rows over tasks by cell: what earlier cells end with is one row a cell, carried on in a second, small pass.
    """
    kind = "struct<" + ",".join(f"`{v}`:{right.schema[v].dataType.simpleString()}" for v in values) + ">"
    marked = left.select(on, time, F.struct(*left.columns).alias("_left"), F.lit(None).cast(kind).alias("_right"), F.lit(1).alias("_side"))
    rows = marked.unionByName(right.select(on, time, F.lit(None).cast(marked.schema["_left"].dataType).alias("_left"), F.struct(*values).alias("_right"), F.lit(0).alias("_side")))
    keys = [on] if cell is None else [on, "_cell"]
    if cell is not None:
        rows = rows.withColumn("_cell", cell(F.col(time)))
    along = W.partitionBy(*keys).orderBy(time, "_side").rowsBetween(W.unboundedPreceding, 0)
    found = rows.withColumn("_last", F.last("_right", ignorenulls=True).over(along)).where("_side = 1")
    if cell is not None:
        ends = rows.where("_side = 0").groupBy(*keys).agg(F.max_by("_right", time).alias("_end"))
        cells = rows.select(*keys).distinct().join(ends, keys, "left")
        before = W.partitionBy(on).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
        carried = cells.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).select(*[F.col(k).alias(f"_{k}") for k in keys], "_before")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        found = found.join(carried, same, "left").withColumn("_last", F.coalesce("_last", "_before"))
    return found.select("_left.*", *[F.col(f"_last.`{v}`").alias(v) for v in values])


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: int) -> DataFrame:
    """Rows whose point lies in [low, high): an equi-join on cells whose width doubles until an interval lies in two of them at most.

    So an interval makes two rows at most, however wide it is, and a point one for each width in use.
    """
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.col(high) - F.col(low)).cast("double") / F.lit(float(width))))).cast("int")
    cell = lambda c, n: F.floor(F.col(c) / (F.lit(float(width)) * F.pow(F.lit(2.0), n))).cast("long")
    cells = right.where(F.col(high) > F.col(low)).withColumn("_level", level)
    cells = cells.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(low, F.col("_level")), cell(high, F.col("_level"))))))
    levels = [r[0] for r in cells.select("_level").distinct().orderBy("_level").collect()]  # 64 or so at most, as widths double
    points = left.withColumn("_level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    points = points.withColumn("_cell", cell(point, F.col("_level")))
    found = points.join(cells, ["_level", "_cell"])
    return found.where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("_level", "_cell")


def hot_keys(df: DataFrame, key: str, share: int = 200) -> list:
    """Keys that more than a `share`-th of all rows have: fewer than `share` of them, whatever the data."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = df.count()
    return [r[0] for r in counted.where(F.col("count") > max(1000, total // share)).select(key).collect()]


def skewed_join(big: DataFrame, small: DataFrame, on: str, salts: int = 16, how: str = "inner", hot: list | None = None) -> DataFrame:
    """Equi-join for keys too hot for one task: only those (found by a count of the big side where not given) are dealt over `salts` tasks, and only
    the small side's rows of theirs repeated. Joins that keep unmatched rows of the small side are refused, as these would come `salts` times."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        raise EngineError(f"no skewed join of kind {how}", kind="bad_arguments")
    hot = hot_keys(big, on) if hot is None else hot
    if not hot:
        return big.join(small, on, how)
    salt = F.pmod(F.xxhash64(*[c for c, t in big.dtypes if not t.startswith("map")]), F.lit(salts)).cast("int")
    dealt = big.withColumn("_salt", F.when(F.col(on).isin(hot), salt).otherwise(0))
    spread = small.withColumn("_salt", F.explode(F.when(F.col(on).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [on, "_salt"], how).drop("_salt")


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner", limit: int = 64 << 20) -> DataFrame:
    """A join that broadcasts the right side if the optimizer's size estimate of it is within the limit, and leaves the choice to Spark otherwise."""
    size = int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return left.join(F.broadcast(right) if size <= limit else right, on, how)
