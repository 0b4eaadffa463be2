"""Five-stage corpus pipeline; each stage is one operator of colonnade.llm.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns
of documents; the last returns the mixing plan. Null texts are empty texts, and copies of each other; null doc_ids are
like any others, but rows that have them keep the passages that others repeat; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm import decontam, mixing, quality, simhash, substring_dedup
from colonnade.llm.common import documents, drop_paths, stage_table, staged
from colonnade.llm.queries import fold

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier rejects go."""
    return quality.keep_good(docs.select(COLUMNS), documents(spark, sf_dir, "labels"), learn=~fold(5, 0))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) one row stays: that with the smallest doc_id
    (null last), of rows with that doc_id that with the smallest row hash, of copies of that row one.

    Rows are told apart by 128 bits of hashes of all columns, so repeated and null doc_ids are no special case."""
    row = [F.xxhash64(F.lit(n), *COLUMNS).alias(f"row{n}") for n in (1, 2)]
    keyed = docs.select(*COLUMNS, *row)
    key = ["row1", "row2"]
    rows = simhash.near_copies(keyed, carry=tuple(key)).groupBy(*key, "doc_id", "root").agg(F.count(F.lit(1)).alias("n"))
    rows = stage_table(rows, "near-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *key)).alias("first")).select("first.*")
    gone = rows.join(first.select(*key), key, "left_anti").select(*key)
    twice = rows.where("n > 1").join(first.select(*key), key, "left_semi").select(*key)  # copies of one row: few, so that their texts can be moved
    once = keyed.join(gone.union(twice), key, "left_anti").select(COLUMNS)
    again = keyed.join(twice, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*").select(COLUMNS)
    return once.union(again)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages an earlier document has go; so do documents of which no word is left."""
    found = substring_dedup.remove_repeats(docs, keep_text=True, carry=["lang", "source"]).where("n_removed = 0 OR n_removed < n_words")
    return found.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_leaks(docs.select(COLUMNS), documents(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order."""
    return mixing.by_position(mixing.mix(docs))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]
ORACLE_SQL = None  # compression, edit distances and fingerprints have no SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages wrote on the way is removed, but for what these rows are still read from."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        held = set(staged())
        kept = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_paths(spark, [p for p in staged()[:-1] if p not in held or p == before])
        docs, before = kept, staged()[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
