"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components are whole numbers. Each shard of the vectors keeps its postings in segments of falling quantised
impact (level * step): a posting list a dimension, of the rows whose component has a level of the segment, and a
bound on what the postings not yet taken, and the rounding of those taken, can add to a row (the norm of what is left of it). A
block of queries takes the segments from the highest impact down, adding query component times impact to
its accumulators, one posting list after the other. After each segment but the last a query stops once the bounds prove
that all but a small share of the rows stay below its k-th best; the rows left are possible
members, which are scored exactly. So a query that no proof stops has taken all postings.

Each row is in one shard, whose index is built once; the queries are written to the shared folder and streamed
past the shards in blocks, the running k-th score being the threshold for a shard's further parts. Each shard gives
k rows a query, of which the best k are kept.

Defined results: vectors that are null or empty, or hold null or non-finite components take no part; vectors meet
those of their own length; a query's own row is told by its place in the table, so rows that repeat an id meet
each other, and each query row has a ranking; rows with null ids are candidates, the last of those
with equal score; components beyond 64 bits, and scores, are taken as the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import open_fs, parallelism, stage_table

SAFE = 1 << 24  # of components, so that sums of products fit 64 bits


class ImpactIndex:
    """Posting segments of one shard, highest impact first; rows are numbered in the order given, which decides ties."""

    def __init__(self, rows: np.ndarray, levels: int = 7, checks: int = 16):
        self.rows = rows
        self.large = bool(rows.size) and (int(rows.max()) >= SAFE or int(rows.min()) <= -SAFE)
        value = rows.astype(np.float64)
        size = np.abs(value)
        self.norm = np.sqrt((value**2).sum(axis=1)).astype(np.float32)
        self.step = max(1.0, np.ceil((size.max(initial=0) + 1) / (1 << levels)))
        level = np.floor(size / self.step).astype(np.int64)
        counts = np.bincount(level[level > 0], minlength=1)
        self.segments = []
        rest, high, held = value, int(level.max(initial=0)) + 1, 0
        for low in range(high - 1, 0, -1):
            held += int(counts[low])
            if held * checks < counts.sum() and low > 1:
                continue
            lists = []
            for d in range(rows.shape[1]):
                at = np.flatnonzero((level[:, d] >= low) & (level[:, d] < high))
                if len(at):
                    lists.append((d, at, (np.sign(value[at, d]) * level[at, d] * self.step).astype(np.float32)))
            taken = (level >= low) & (level < high)
            rest = np.where(taken, value - np.sign(value) * level * self.step, rest)
            self.segments.append((lists, np.sqrt((rest**2).sum(axis=1)).astype(np.float32)))
            high, held = low, 0
        if not self.segments:  # all components are below the step
            self.segments.append(([], self.norm))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None, share: float = 1 / 8) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best rows for each query, and the number of segments each query took.

        `own`: each query's own row or -1; `floor`: scores that k other rows are known to have, which only rows that reach them are worth giving.
        """
        n, m = len(self.rows), len(queries)
        q = queries.astype(np.float32)
        norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)).astype(np.float32)
        least = np.full(m, -np.inf, np.float32) if floor is None else np.nextafter(floor.astype(np.float32), np.float32(-np.inf))
        took = np.zeros(m, np.int64)
        open_, score, out = np.arange(m), np.zeros((n, m), np.float32), []
        for number, (lists, rest) in enumerate(self.segments, 1):
            for d, at, impact in lists:
                score[at] += impact[:, None] * q[open_, d]
            # what is left of a row adds the product of the norms at most; the rest is for rounding
            bound = (rest * np.float32(1.0001) + self.norm * np.float32(1e-5))[:, None] * norm[open_]
            low = score - bound
            mine = own[open_]
            low[mine[mine >= 0], np.flatnonzero(mine >= 0)] = -np.inf
            kth = np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(len(open_), -np.inf, np.float32)
            member = score + bound >= np.maximum(kth, least[open_])
            member[mine[mine >= 0], np.flatnonzero(mine >= 0)] = False
            took[open_] = number
            done = member.sum(axis=0) <= max(8 * k, share * n) if number < len(self.segments) else np.ones(len(open_), bool)
            if not done.any():
                continue
            at, row = np.nonzero(member[:, done].T)
            who = open_[done][at]
            exact = self.exact(queries, who, row)
            order = np.lexsort((row, -exact, who))
            who, row, exact = who[order], row[order], exact[order]
            keep = np.arange(len(who)) - np.searchsorted(who, who) < k
            out.append((who[keep], row[keep], exact[keep]))
            open_, score = open_[~done], score[:, ~done]
            if not len(open_):
                break
        return *(np.concatenate(x) for x in zip(*out)), took

    def exact(self, queries: np.ndarray, who: np.ndarray, row: np.ndarray) -> np.ndarray:
        out = np.empty(len(who), np.int64)
        large = self.large or bool(queries.size) and (int(queries.max()) >= SAFE or int(queries.min()) <= -SAFE)
        for at in range(0, len(who), 1 << 16):
            part = slice(at, at + (1 << 16))
            if large:
                sums = [int(x) for x in (queries[who[part]].astype(object) * self.rows[row[part]].astype(object)).sum(axis=1)]
                out[part] = [max(-(1 << 63) + 1, min((1 << 63) - 1, x)) for x in sums]
            else:
                out[part] = np.einsum("ij,ij->i", queries[who[part]], self.rows[row[part]])
        return out


def quantised(embedding: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null unless all of them are finite."""
    edge = float(2**63 - 1024)
    whole = F.transform(F.col(embedding), lambda x: F.floor(F.greatest(F.lit(-edge), F.least(F.lit(edge), F.lit(float(scale)) * x.cast("double")))).cast("long"))
    good = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.col(embedding).isNotNull() & good & (F.size(embedding) > 0), whole)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", embedding: str = "embedding", shard_rows: int = 65_536, index_rows: int = 16_384, block_rows: int = 128) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for every row that `queries` picks."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), quantised(embedding).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).where("v IS NOT NULL")
    rows = stage_table(rows.withColumn("n", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = stage_table(rows.where("asks").select("row", "vec_id", "v", "n"), "queries")
    files = asked.inputFiles()
    result = "query_id long, rank int, vec_id long, score long"
    total = rows.count()
    if not total or not files:
        return spark.createDataFrame([], result)
    tasks = parallelism(spark)
    shards = max(-(-total // shard_rows), min(2 * tasks, total // 2048), 1)
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(v: pa.Array) -> np.ndarray:
        return v.flatten().to_numpy().reshape(len(v), -1)

    def blocks(n: int) -> Iterator[pa.RecordBatch]:
        """The queries of one length, from the shared folder."""
        import pyarrow.parquet as pq

        for file in files:
            fs, path = open_fs(file)
            with fs.open_input_file(path) as held:
                for batch in pq.ParquetFile(held).iter_batches(block_rows, columns=["row", "vec_id", "v", "n"]):
                    batch = batch.filter(pa.array(batch.column("n").to_numpy() == n))
                    if batch.num_rows:
                        yield batch

    def search(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        v, ids, numbers = matrix(table["v"].combine_chunks()), table["vec_id"].combine_chunks(), table["row"].to_numpy()
        parts = [(at, ImpactIndex(v[at : at + index_rows])) for at in range(0, len(v), index_rows)]
        by_number = np.argsort(numbers)
        out = []
        for block in blocks(key[0].as_py()):
            asks, them = matrix(block.column("v")), block.column("row").to_numpy()
            place = by_number[np.minimum(np.searchsorted(numbers, them, sorter=by_number), len(numbers) - 1)]
            own = np.where(numbers[place] == them, place, -1)
            best = np.empty((3, 0), np.int64)
            floor = np.full(len(them), -np.inf)
            for at, index in parts:
                mine = np.where((own >= at) & (own < at + len(index.rows)), own - at, -1)
                who, row, score, _ = index.search(asks, mine, k, floor)
                best = np.column_stack([best, np.array([who, row + at, score], np.int64).reshape(3, -1)])
                best = best[:, np.lexsort((best[1], -best[2], best[0]))]
                best = best[:, np.arange(best.shape[1]) - np.searchsorted(best[0], best[0]) < k]
                full = np.bincount(best[0], minlength=len(them)) == k
                last = np.searchsorted(best[0], np.arange(len(them)), "right") - 1
                floor[full] = best[2][last[full]]
            who, row, score = best
            out.append(pa.table([pa.array(them[who]), block.column("vec_id").take(pa.array(who)), ids.take(pa.array(row)), pa.array(score)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    dealt = rows.select("vec_id", "v", "row", "n", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")).repartition(max(shards, tasks), "n", "shard")
    met = dealt.groupBy("n", "shard").applyInArrow(search, "query long, query_id long, vec_id long, score long")
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
