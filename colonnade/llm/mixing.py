"""Mixing sources to target weights along a time-varying curriculum.

Sources share the words of all documents by weight; none may give more than `most` times its
own words, and what it can't give is shared again by weight. Within a source documents stand
in hash order; each gives as many whole copies as the target asks for, and those up to the word where
the rest of the target ends give one more, so a source's words are off its target by half a document at most.

Over training time t from 0 to 1 a source's weight follows a schedule, 1 + slope * (2t - 1) times its
mean. Its integral is the source's share of demand by time t; inverting it at a copy's place in the source's
stream gives the copy's time, and the demand of all sources by then its position in words. Copies are range-sorted by position.

Prefix sums are made in two steps, over hash cells of each source and inside cells, so no task
holds a whole source. Defined results: null text has size 0; null source is a source of its own, the
last; null doc_id is hashed like any value; repeated rows each get a row; documents without words take part with 0
words; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parallelism, pow2, stage_table

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds rank (from 0) in a global order, without bringing all rows to one task."""
    placed = stage_table(df.repartitionByRange(parallelism(df.sparkSession), *order).withColumn("_part", F.spark_partition_id()), name)
    sizes = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    before, at = [], 0
    for part in sorted(sizes):
        before += [F.lit(part), F.lit(at)]
        at += sizes[part]
    if not before:
        return placed.withColumn("rank", F.lit(0).cast("long")).drop("_part")
    own = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return placed.withColumn("rank", own + F.element_at(F.create_map(*before), F.col("_part"))).drop("_part")


def targets(sources: DataFrame, weights: list[float], most: float) -> DataFrame:
    """Adds weight and target to (source, source_size): min(most * size, share * weight), shares adding up to all words."""
    ranked = _ranked(sources, [F.col("source").isNull(), F.col("source")], "sources")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stage_table(ranked.withColumn("weight", pick), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:  # each round caps at least one more source, or ends
        full = F.col("source_size") * most <= F.lit(share) * F.col("weight")
        capped, open_ = ranked.agg(F.sum(F.when(full, F.col("source_size") * F.lit(float(most)))), F.sum(F.when(~full, F.col("weight")))).first()
        if open_ is None:
            break
        new = (total - (capped or 0.0)) / open_
        if new <= share:
            break
        share = new
    return ranked.withColumn("target", F.least(F.col("source_size") * F.lit(float(most)), F.lit(share) * F.col("weight")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), slopes: tuple[float, ...] = (0.5, 0.0, -0.5), most: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, and what curriculum() needs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words("text").alias("size"))
    rows = stage_table(rows.withColumn("h", F.xxhash64("doc_id", F.lit("mix"))), "sizes")
    cells_wanted = min(1 << 16, pow2(rows.count() / 200))
    cell = F.shiftrightunsigned("h", 48).bitwiseAND(F.lit(cells_wanted - 1)).cast("int")
    key = F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit("")))
    rows = rows.withColumn("cell", cell).withColumn("key", key)
    cells = stage_table(rows.groupBy("key", "source", "cell").agg(F.sum("size").alias("cell_size")), "cells")
    aims = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), list(weights), most)
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), (F.col("rank") % len(slopes) + 1).cast("int"))
    aims = stage_table(aims.select(key.alias("key"), "source_size", "target", slope.alias("slope")), "targets")
    demand = aims.agg(F.sum("target"), F.sum(F.col("target") * F.col("slope"))).first()
    before = W.partitionBy("key").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("cell_before", F.coalesce(F.sum("cell_size").over(before), F.lit(0))).drop("source", "cell_size")
    cells = stage_table(cells.join(aims, "key"), "cell-targets")
    inside = W.partitionBy("key", "cell").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.join(cells, ["key", "cell"]).withColumn("offset", F.col("cell_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    more = F.col("offset") + F.col("size") / 2.0 < (ratio - whole) * F.col("source_size")
    copies = F.least(F.lit(int(most)), whole + F.when(more, 1).otherwise(0)).cast("int")
    return placed.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "offset", "slope",
        F.lit(demand[0] or 0.0).alias("all_words"), F.lit(demand[1] or 0.0).alias("all_slopes"),
    )


def position(copy: Column | str = "copy") -> Column:
    """Words trained before a copy (numbered from 0) of a row of mix()."""
    copy = F.col(copy) if isinstance(copy, str) else copy
    u = F.least(F.lit(1.0), (copy * F.col("source_size") + F.col("offset")) / F.col("target"))
    a = F.col("slope")
    t = 2 * u / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u))  # t + a (t*t - t) = u
    return F.when(F.col("copies") > copy, F.col("all_words") * t + F.col("all_slopes") * (t * t - t))


def curriculum(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted: doc_id, source, size, copy, position."""
    each = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return each.select("doc_id", "source", "size", "copy", position().alias("position")).orderBy("position", "doc_id", "copy")


def by_position(mixed: DataFrame) -> DataFrame:
    """One row per document with the positions of all its copies, range-sorted by the first, documents left out last."""
    each = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position)).otherwise(F.array().cast("array<double>"))
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", position(F.lit(0)).alias("first_position"), each.alias("positions"))
    return out.orderBy(F.asc_nulls_last("first_position"), "doc_id")
