"""The op queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents


def fold(of: int, spared: int) -> Column:
    """True for rows held out of learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == spared, F.lit(True))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    found = classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), "quality", ~fold(5, 0))
    return found.select("doc_id", fold(5, 0).alias("held_out"), "score", "predicted")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(documents(spark, sf_dir)).drop("spans")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_edited, sample_edits

    return count_edited(documents(spark, sf_dir), sample_edits()).drop("tree")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify

    found = classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), "toxic", ~fold(3, 1))
    return found.select("doc_id", fold(3, 1).alias("held_out"), "score", "predicted")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import by_position, mix

    return by_position(mix(documents(spark, sf_dir)))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_leaks

    return find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import digest, near_duplicates

    return digest(near_duplicates(documents(spark, sf_dir)))


def op10_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_archives, write_archives

    return read_archives(*write_archives(documents(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


OP5_SQL = """
WITH r0 AS (SELECT row_number() OVER () AS n, vec_id, embedding FROM embeddings), v AS (
  SELECT n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM r0
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.n <> c.n AND len(q.e) = len(c.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT n, doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS h FROM (SELECT n, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first_id FROM k GROUP BY h),
gone AS (SELECT DISTINCT n, unnest(range(i, i + 13)) AS pos FROM k JOIN f USING (h) WHERE doc_id > first_id),
each AS (SELECT n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT n, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS c FROM each ANTI JOIN gone USING (n, pos) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(c, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (n)
"""

OP10_SQL = """
WITH p AS (SELECT row_number() OVER () AS n, page_id, coalesce(html, '') AS payload FROM pages),
r AS (
  SELECT *, sha1(payload) AS hex, row_number() OVER w AS place, first_value(page_id) OVER w AS first_id FROM p
  WINDOW w AS (PARTITION BY payload ORDER BY page_id NULLS LAST, n)
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first_id END AS refers_to
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_top_k": OP5_SQL, "op7_substring_dedup": OP7_SQL, "op10_warc_writer": OP10_SQL}
