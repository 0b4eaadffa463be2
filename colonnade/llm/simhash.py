"""SimHash near-duplicates by a Gray-order hierarchical index.

The index of a shard of fingerprints: they are sorted by Gray rank and held as a tree whose nodes have the bits that all their
fingerprints share (each node only the bits its parent lacks); a search adds up the differences on the
way down and drops a node with all its rows once they pass the limit.

Shards: fingerprints that differ in at most `distance` bits agree on at least two of
BLOCKS bit blocks. So each fingerprint goes to 15 tables, one for each pair of blocks, with these blocks moved
to the front; a shard is a part of a table, by the value of the blocks. Being in front, they are what the tree's upper nodes share; a search allows
no difference there (other tables find those) and `distance` in all. Every shard is indexed whole, and every
fingerprint searched in it, whatever its size.

Defined results: null and blank texts have fingerprint zero and link like any other;
repeated rows each get a row; a null doc_id never names a component unless all ids
in it are null. Extra columns are ignored.

near_copies() is for a corpus: documents whose sets of five-word shingles have a Jaccard similarity
of 0.8 or more are linked. At that similarity fingerprints differ in about 10 bits of 64, often in more, which no
choice of blocks finds at a bearable cost; so texts meet if the index above links them or if they agree
in one of 25 bands of four min-hashes (at 0.8 a pair fails to with probability 2e-6). All pairs of texts
that meet and are not linked yet are compared by their whole shingle sets, told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, hot_keys, map_arrow, parallelism, salted_join, signed, stage_table, trim, trimmed

BLOCKS = (11, 11, 11, 11, 10, 10)
LEAF, FAN = 32, 8
SEED = 42
BANDS, BAND = 25, 4
_random = np.random.default_rng(SEED)
TIMES, PLUS = _random.integers(0, 1 << 64, BANDS * BAND, np.uint64) | np.uint64(1), _random.integers(0, 1 << 64, BANDS * BAND, np.uint64)


def shingle_hashes(text: bytes, shingle: int = 4) -> np.ndarray:
    """Hash of each of a text's word shingles in order, repeats included; a shorter text is one shingle."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text's word shingles, repeats included."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""

    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in binaries(batch.column("text"))], np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": signed(fps)}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    out = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Tree over fingerprints in Gray order; levels[0] is the root's level, the last one holds the leaves."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        self.pruned = 0  # nodes dropped by searches so far
        ones, zeros, step = self.fps, ~self.fps, LEAF
        levels = []
        while True:
            cuts = np.arange(0, len(ones), step)
            ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)
            levels.append((ones | zeros, ones))
            step = FAN
            if len(ones) == 1:
                break
        self.levels = []
        for k, (shared, ones) in enumerate(levels):
            above = np.repeat(levels[k + 1][0], FAN)[: len(shared)] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((shared & ~above, ones, LEAF * FAN**k))
        self.levels.reverse()

    def pairs(self, queries: np.ndarray, distance: int, fixed: int = 0, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places (query, row in Gray order) of all rows within the distance that agree on the `fixed` bits; `after`: only rows beyond each query's place there."""
        fixed = np.uint64(fixed)
        q = np.arange(len(queries))
        node, spent = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for k, (mask, ones, span) in enumerate(self.levels):
            if k:
                q, spent = np.repeat(q, FAN), np.repeat(spent, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                keep = node < len(mask)
                if after is not None:
                    keep &= (node + 1) * span > after[q] + 1
                q, spent, node = q[keep], spent[keep], node[keep]
            differ = (queries[q] ^ ones[node]) & mask[node]
            spent = spent + np.bitwise_count(differ)
            keep = (spent <= distance) & (differ & fixed == 0)
            self.pruned += len(keep) - int(np.count_nonzero(keep))
            q, spent, node = q[keep], spent[keep], node[keep]
        q = np.repeat(q, LEAF)
        row = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
        keep = row < len(self.fps)
        if after is not None:
            keep &= row > after[q]
        q, row = q[keep], row[keep]
        differ = queries[q] ^ self.fps[row]
        keep = (np.bitwise_count(differ) <= distance) & (differ & fixed == 0)
        return q[keep], row[keep]


def roots(a: np.ndarray, b: np.ndarray, n: int, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of n nodes over links a-b, going on from an earlier answer."""
    root = np.arange(n) if root is None else root
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low < high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


TABLES = list(combinations(range(len(BLOCKS)), 2))


def in_front(fps: np.ndarray, table: int) -> tuple[np.ndarray, int]:
    """Fingerprints with the table's two blocks moved to the highest bits, and the mask of these bits."""
    lows = np.concatenate(([0], np.cumsum(BLOCKS)))
    out, top = np.zeros(len(fps), np.uint64), 64
    for b in (*TABLES[table], *(b for b in range(len(BLOCKS)) if b not in TABLES[table])):
        top -= BLOCKS[b]
        out |= (fps >> np.uint64(lows[b]) & np.uint64((1 << BLOCKS[b]) - 1)) << np.uint64(top)
    held = sum(BLOCKS[b] for b in TABLES[table])
    return out, ((1 << held) - 1) << (64 - held)


def _local_links(table: np.ndarray, fps: np.ndarray, distance: int, batch: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each component of the links that these shards, one for each table, hold."""
    nodes, ids = np.unique(fps, return_inverse=True)
    root, found, size = np.arange(len(nodes)), [], 0
    for t in np.unique(table).tolist():
        mine = ids[table == t]
        moved, fixed = in_front(nodes[mine], t)
        index = GrayIndex(moved)
        mine = mine[index.order]
        for at in range(0, len(mine), batch):
            q, row = index.pairs(index.fps[at : at + batch], distance, fixed, np.arange(at, min(at + batch, len(mine))))
            found.append((mine[q + at], mine[row]))
            size += len(q)
            if size > 1 << 20:
                root, found, size = roots(*map(np.concatenate, zip(*found)), len(nodes), root), [], 0
    if found:
        root = roots(*map(np.concatenate, zip(*found)), len(nodes), root)
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def dealt(keyed: DataFrame, id: str, total: int, cap: int) -> tuple[DataFrame, int]:
    """Rows with keys, where any two rows of a key still meet under one (of large keys the pairs of sub-blocks are dealt out), and their number."""
    cap = max(cap, total // 20_000)  # so that fewer than 20,000 keys are above it
    over = [(r[0], -(-r[1] // cap), r[1]) for r in keyed.groupBy("key").count().where(F.col("count") > cap).collect()]
    if not over:
        return keyed, total
    table = keyed.sparkSession.createDataFrame([x[:2] for x in over], "key long, subs int")
    names = [c for c in keyed.columns if c != "key"]
    keyed = keyed.join(F.broadcast(table), "key", "left").withColumn("own", F.pmod(F.xxhash64(id), F.col("subs")).cast("int"))
    other = F.when(F.col("subs").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("subs") - 1))
    keyed = keyed.select(*names, "key", "own", F.explode(other).alias("other"))
    keyed = keyed.select(*names, F.when(F.col("other") < 0, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"))
    return keyed, total + sum(n * (subs - 1) for _, subs, n in over)


def links(distinct: DataFrame, distance: int = 4, cap: int = 4096) -> DataFrame:
    """(a, b), b < a unsigned: links that connect exactly the fingerprints `distance` bits link, directly or over others."""
    if distance > len(BLOCKS) - 2:
        raise ValueError("the block keys cover 4 differing bits at most")
    at, blocks = 0, []
    for w in BLOCKS:
        blocks.append(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1)))
        at += w
    keys = [F.struct(F.lit(n).alias("table"), (F.lit(n << 40) + F.shiftleft(blocks[i], 11) + blocks[j]).alias("key")) for n, (i, j) in enumerate(TABLES)]
    total = distinct.count() * len(keys)
    keyed, total = dealt(distinct.select("fp", F.explode(F.array(*keys)).alias("at")).select("fp", "at.table", "at.key"), "fp", total, cap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("table").to_numpy(), b.column("fp").to_numpy().view(np.uint64)) for b in batches if b.num_rows]
        if held:
            a, b = _local_links(*map(np.concatenate, zip(*held)), distance)
            del held
            yield pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b))], names=["a", "b"])
            trim()

    parts = max(parallelism(distinct.sparkSession), total // 1_000_000)  # what a task holds is bounded
    return keyed.repartition(parts, "key").select("fp", "table").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root) of every linked node: smallest node (as signed long) it reaches.

    Alternating large-star and small-star rounds over tables in the shared folder;
    nodes with many links are dealt out by salt.
    """
    spark = edges.sparkSession
    salts = parallelism(spark)

    def star(edges: DataFrame, small: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if not small:
            both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = stage_table(both.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n")).withColumn("low", F.least("u", "low")), name)
        hot = hot_keys(least, "u", "n", least.agg(F.sum("n")).first()[0] or 0, 4 * salts)
        joined = salted_join(both, least.drop("n"), "u", hot, salts, "v")
        if small:
            out = joined.select(F.col("v").alias("a"), F.col("low").alias("b")).union(least.select(F.col("u").alias("a"), F.col("low").alias("b")))
        else:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("low").alias("b"))
        return stage_table(out.where("a > b").distinct(), name)

    edges = stage_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(30,0)"))).first()
        edges = star(star(edges, False), True)
        if edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(30,0)"))).first() == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def by_component(rows: DataFrame, groups: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows with root and component_id, the least least_id of the groups (key, least_id, n) that `found` (node, root) gives the root of the row's key."""
    member = groups.join(found.withColumnRenamed("node", key), key, "left").select(key, "n", "least_id", F.coalesce("root", key).alias("root"))
    member = stage_table(member, "fp-members")
    smallest = member.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    smallest = stage_table(smallest, "fp-components")
    salts = parallelism(rows.sparkSession)
    hot = hot_keys(smallest, "root", "fps", groups.count(), 4 * salts)
    classes = stage_table(salted_join(member, smallest.drop("fps"), "root", hot, salts, key).select(key, "n", "root", "component_id"), "fp-classes")
    hot = hot_keys(classes, key, "n", rows.count(), 4 * salts)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # ids may be null, or repeat
    return salted_join(rows, classes.drop("n"), key, hot, salts, "_row").drop("_row")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest doc_id reachable)."""
    prints = stage_table(fingerprints(docs, shingle), "fingerprints")
    groups = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "fp-groups")
    found = components(links(groups.select("fp"), distance), "fp-links")
    return by_component(prints, groups, found, "fp").select("doc_id", "fp", "component_id")


def band_keys(shingles: np.ndarray) -> list[int]:
    """A key for each band of min-hashes of a shingle set; none for the empty set."""
    if not len(shingles):
        return []
    least = np.full(len(TIMES), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[None, at : at + 1024] * TIMES[:, None] + PLUS[:, None]).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(x.tobytes(), n) for n, x in enumerate(least.reshape(BANDS, BAND))]


def similar_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect exactly what the pairs of sets with Jaccard similarity of at least `percent` connect."""
    size = np.array(list(map(len, sets)))
    names, code = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(code, np.cumsum(size)[:-1])
    root, mark, found = np.arange(len(sets)), np.zeros(len(names), bool), []
    for i in range(len(sets) - 1):
        other = i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & (100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :])))
        if len(other):
            mark[codes[i]] = True
            common = np.array([np.count_nonzero(mark[codes[j]]) for j in other])
            mark[codes[i]] = False
            for j in other[100 * common >= percent * (size[i] + size[other] - common)].tolist():
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    found.append((i, j))
    return found


def near_copies(docs: DataFrame, percent: int = 80, shingle: int = 5, cap: int = 2048, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, root (the component), component_id (smallest doc_id reachable), and the long columns `carry`."""

    def sign(batch: pa.RecordBatch) -> dict:
        each = [shingle_hashes(t, shingle) for t in binaries(batch.column("text"))]
        sets = [np.unique(x) for x in each]
        own = signed(np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64))
        fps = signed(np.array([majority(x) for x in each], np.uint64))
        keys = [signed(np.array(band_keys(x), np.uint64)) for x in sets]
        return {c: batch.column(c) for c in ("doc_id", "text_hash", *carry)} | {"own": own, "fp": fps, "keys": pa.array(keys, pa.list_(pa.int64()))}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text", *carry)
    rows = stage_table(map_arrow(texts, sign, f"doc_id long, text_hash long, {''.join(f'{c} long, ' for c in carry)}own long, fp long, keys array<long>"), "signatures")
    sets = stage_table(rows.groupBy("own").agg(F.min("text_hash").alias("text_hash"), F.min("fp").alias("fp"), F.first("keys").alias("keys"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "shingle-sets")
    linked = components(links(sets.select("fp").distinct()), "fp-links")
    rooted = sets.select("own", "fp").join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("own", F.xxhash64(F.coalesce("root", "fp")).alias("key"))
    keyed = stage_table(sets.select("own", F.explode("keys").alias("key")).union(rooted), "set-keys")
    held, _ = dealt(keyed, "own", sets.count() * (BANDS + 1), cap)
    # texts that meet under several keys are compared once
    groups = held.groupBy("key").agg(F.array_sort(F.collect_set("own")).alias("members")).where(F.size("members") > 1).select("members").distinct()
    met = stage_table(groups.select(F.xxhash64("members").alias("group"), F.explode("members").alias("own")), "set-groups")
    wanted = sets.select("own", "text_hash").join(met.select("own").distinct(), "own", "left_semi").select("text_hash")
    whole = texts.groupBy("text_hash").agg(F.first("text").alias("text")).join(wanted, "text_hash", "left_semi")  # each task sends a text once

    def shingles(batch: pa.RecordBatch) -> dict:
        sets = [np.unique(shingle_hashes(t, shingle)) for t in binaries(batch.column("text"))]
        own = signed(np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64))
        return {"own": own, "shingles": pa.array(list(map(signed, sets)), pa.list_(pa.int64()))}

    def compare(table: pa.Table) -> pa.Table:
        own, held = table["own"].to_numpy(), table["shingles"].combine_chunks()
        at = held.offsets.to_numpy()
        found = similar_sets(np.split(held.values.to_numpy()[at[0] : at[-1]], at[1:-1] - at[0]), percent)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(own[a]), "b": pa.array(own[b])})

    whole = stage_table(map_arrow(whole, shingles, "own long, shingles array<long>"), "shingles")
    edges = met.join(whole, "own").select("group", "own", "shingles").groupBy("group").applyInArrow(trimmed(compare), "a long, b long")
    found = components(edges, "set-links")
    return by_component(rows.select("doc_id", *carry, "own"), sets.select("own", "least_id", "n"), found, "own").select("doc_id", *carry, "root", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
