"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case words joined by one space, with a space before and after, so that an item
matches whole words. An item may differ from
its place in a text by an error budget of `rate` times its length; cut into one piece more than the
budget, one piece at least stands there unchanged. An Aho-Corasick automaton finds all
pieces in all texts; around each hit Myers' bit-parallel distance decides. Items of fewer than `least_words` words prove
nothing inside a text: they match only a text that is the item.

The items are a query set, written in blocks of about `block_chars` to the shared folder. The documents are
read once: a worker holds the automata of `held_blocks` blocks, and where there are more takes its documents, by `buffer_chars` at a time, past all of them.
Defined results: items and texts without words (null too) match nothing;
repeated rows of either table are compared each for itself; null ids are ids; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, open_fs, stage_table

GAPS = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return GAPS.sub(" ", (text or "").lower()).strip()


def myers(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any part of the text, end of the first such part)."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score = full, 0, length
    best, end = length, 0
    for at, c in enumerate(text, 1):
        same = masks.get(c, 0) | down
        diagonal = (((same & up) + up) ^ up) | same
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise <<= 1
        down = rise & diagonal & full
        up = (fall << 1 | ~(rise | diagonal)) & full
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class Matcher:
    """Finds the items of one block in texts."""

    items: list[tuple[int | None, str]]
    rate: float
    least_words: int = 4
    _machine: object = None
    _masks: dict = field(default_factory=dict)
    _short: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"_machine": None, "_masks": {}, "_short": {}}

    def budget(self, n: int) -> int:
        return int(self.rate * len(self.items[n][1]))

    def _build(self) -> None:
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(self.items):
            if text.count(" ") + 1 < self.least_words:
                self._short.setdefault(text, []).append(n)
                continue
            text = f" {text} "
            parts = self.budget(n) + 1
            cuts = [len(text) * k // parts for k in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        self._machine = ahocorasick.Automaton()
        pieces.setdefault("\x00", [])  # an automaton can't be empty; no normalised text has this
        for piece, found in pieces.items():
            self._machine.add_word(piece, (len(piece), found))
        self._machine.make_automaton()

    def masks(self, n: int) -> dict[str, int]:
        if n not in self._masks:
            out: dict[str, int] = {}
            for i, c in enumerate(f" {self.items[n][1]} "):
                out[c] = out.get(c, 0) | 1 << i
            self._masks[n] = out
        return self._masks[n]

    def matches(self, plain: str) -> list[tuple[int, int, int]]:
        """(item number, distance, end) of the best place of each item found in a normalised text."""
        if not plain or not self.items:
            return []
        if self._machine is None:
            self._build()
        out = [(n, 0, len(plain)) for n in self._short.get(plain, [])]
        plain = f" {plain} "
        starts: dict[int, list[int]] = {}
        for end, (size, found) in self._machine.iter(plain):
            for n, off in found:
                starts.setdefault(n, []).append(end - size + 1 - off)
        for n, places in starts.items():
            pattern, slack = f" {self.items[n][1]} ", self.budget(n)
            best, till = slack + 1, -1
            places.sort()
            k = 0
            while k < len(places) and best:
                lo = hi = places[k]  # near places share one window
                while k < len(places) and places[k] - hi <= slack:
                    hi = places[k]
                    k += 1
                a, b = max(0, lo - slack), min(len(plain), hi + len(pattern) + slack)
                if b - a >= len(pattern) - slack:
                    d, e = myers(self.masks(n), len(pattern), plain[a:b])
                    if d < best:
                        best, till = d, a + e
            if best <= slack:
                out.append((n, best, max(0, till - 2)))  # without the spaces around
        return out


@dataclass
class Blocks:
    """The benchmark in the shared folder: the files that hold each block's items."""

    files: list[str]
    count: int
    rate: float
    least_words: int
    held_blocks: int

    def matcher(self, block: int) -> Matcher:
        """From what this worker has built, or built now."""
        key = (self.files[0], block)
        if key not in _built:
            while len(_built) >= self.held_blocks:
                _built.pop(next(iter(_built)))
            _built[key] = Matcher(self._read(block), self.rate, self.least_words)
        return _built[key]

    def _read(self, block: int) -> list[tuple[int | None, str]]:
        import pyarrow.parquet as pq

        out = []
        for file in self.files:
            fs, path = open_fs(file)
            rows = pq.read_table(path, filesystem=fs, filters=[("block", "=", block)])
            out += zip(rows["item_id"].to_pylist(), rows["plain"].to_pylist())
        return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


_built: dict[tuple[str, int], Matcher] = {}


def blocks_of(benchmark: DataFrame, rate: float, block_chars: int, least_words: int, held_blocks: int) -> Blocks:
    """Normalise the items and write them out by block."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"item_id": batch.column("item_id"), "plain": [normalise(t) for t in batch.column("text").to_pylist()]}

    items = map_arrow(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, plain string").where("plain <> ''")
    items = stage_table(items, "benchmark-items")
    count = -(-(items.agg(F.sum(F.length("plain"))).first()[0] or 0) // block_chars)
    if not count:
        return Blocks([], 0, rate, least_words, held_blocks)
    block = F.pmod(F.xxhash64("item_id", "plain"), F.lit(count)).cast("int")
    held = stage_table(items.withColumn("block", block).repartition(min(count, 200), "block").sortWithinPartitions("block"), "benchmark-blocks")
    return Blocks(held.inputFiles(), count, rate, least_words, held_blocks)


def _past_blocks(batches: Iterator[pa.RecordBatch], blocks: Blocks, buffer_chars: int) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[int, int, int, int]]]]]:
    """Each batch, with what is found in each of its texts: (block, item number, distance, end)."""
    held, size = [], 0

    def flush() -> Iterator:
        texts = [[normalise(t) for t in batch.column("text").to_pylist()] for batch in held]
        found = [[[] for _ in x] for x in texts]
        for b in range(blocks.count):
            matcher = blocks.matcher(b)
            for x, out in zip(texts, found):
                for n, plain in enumerate(x):
                    out[n] += [(b, *m) for m in matcher.matches(plain)]
        yield from zip(held, found)

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if blocks.count <= blocks.held_blocks or size >= buffer_chars:
            yield from flush()
            held, size = [], 0
    yield from flush()


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, block_chars: int = 2_000_000, least_words: int = 4, held_blocks: int = 4, buffer_chars: int = 32 << 20) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, item_chars, end (in the normalised text)."""
    blocks = blocks_of(benchmark, rate, block_chars, least_words, held_blocks)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("item_chars", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _past_blocks(batches, blocks, buffer_chars):
            out = []
            for doc, each in zip(batch.column("doc_id").to_pylist(), found):
                for b, n, distance, end in each:
                    item, plain = blocks.matcher(b).items[n]
                    out.append({"doc_id": doc, "item_id": item, "distance": distance, "item_chars": len(plain), "end": end})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, "doc_id long, item_id long, distance int, item_chars int, end int")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, block_chars: int = 2_000_000, least_words: int = 4, held_blocks: int = 4, buffer_chars: int = 32 << 20) -> DataFrame:
    """The documents in which no item is found, all columns kept."""
    blocks = blocks_of(benchmark, rate, block_chars, least_words, held_blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _past_blocks(batches, blocks, buffer_chars):
            yield batch.filter(pa.array([not each for each in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
