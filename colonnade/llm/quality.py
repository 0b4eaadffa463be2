"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on pieces of good and one on pieces of bad
labelled texts. A text is cut into pieces, each piece compressed with either, and
the normalised difference of the sizes, overall and in the worst piece, tells which kind
it is like; a compression of the whole text, relative to its length, tells of texts that repeat
themselves. A logistic curve fitted on labelled texts outside
the dictionaries turns these sizes into a probability.

The model is fitted on the driver from whole texts of at most `per_class` labelled rows of each class (the
first by hash of doc_id) with `class_bytes` in all, so its size is bounded; class weights come from
counts over all labelled rows. Every whole text is scored.

Defined results: null text is empty and gets the score of empty texts; null labels and labels
without document are left out; a document with several label rows is counted for each;
repeated rows each get a row; with no labels of one class the score is the other class's share
(1 with no labels at all). Null doc_id counts as held out of learning. Extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, map_arrow


def sample(docs: DataFrame, labels: DataFrame, label: str, learn, per_class: int, class_bytes: int) -> tuple[dict[int, list[tuple[int, bytes]]], dict[int, int]]:
    """Whole texts of up to per_class rows of each class, in hash order, of class_bytes at most in all, and the class counts over all learnable labels.

    A row that no longer fits is passed over; of equal rows one counts. Sizes are read before any text is.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").where(learn)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = docs.sparkSession
    out: dict[int, list[tuple[int, bytes]]] = {0: [], 1: []}
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    picked = [(r["doc_id"], r["y"]) for y in counts for r in known.where(F.col("y") == y).distinct().orderBy(*order[:2]).limit(per_class).collect()]
    if not picked:
        return out, counts
    chosen = F.broadcast(spark.createDataFrame(picked, "doc_id long, y int"))  # at most two times per_class rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    sizes = texts.join(chosen, "doc_id").groupBy("doc_id", "y", "h").agg(F.first(F.octet_length("text")).alias("size"))
    fits = []
    for y in counts:
        left = class_bytes
        for r in sizes.where(F.col("y") == y).orderBy(*order).limit(per_class).collect():
            if r["size"] <= left:
                left -= r["size"]
                fits.append((r["doc_id"], y, r["h"]))
    wanted = F.broadcast(spark.createDataFrame(fits, "doc_id long, y int, h long"))
    for r in texts.join(wanted, ["doc_id", "h"]).groupBy("doc_id", "y", "h").agg(F.first("text").alias("text")).orderBy("doc_id", "h").toLocalIterator():
        out[r["y"]].append((r["doc_id"], r["text"].encode()))
    return out, counts


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge * weight.sum() / len(w))
    pull[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + pull * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def pieces_of(text: bytes, piece: int) -> list[bytes]:
    """The whole text in pieces of nearly equal length, `piece` bytes at most; one empty piece of an empty text."""
    n = max(1, -(-len(text) // piece))
    cuts = [len(text) * k // n for k in range(n + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


@dataclass
class CompressionModel:
    good: bytes = b""
    bad: bytes = b""
    piece: int = 512
    level: int = 3
    prior: float = 1.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    center: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))
    _tools: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_tools": None}

    def sizes(self, text: bytes) -> list[float]:
        if self._tools is None:
            make = []
            for raw in (self.good, self.bad):
                held = zstandard.ZstdCompressionDict(raw)
                held.precompute_compress(level=self.level)
                make.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False))
            self._tools = (make[0].compress, make[1].compress, zstandard.ZstdCompressor(level=self.level, write_content_size=False).compress)
        good, bad, plain = self._tools
        g = b = 0
        worst, best = 1.0, -1.0
        for part in pieces_of(text, self.piece):
            x, y = len(good(part)), len(bad(part))
            g, b = g + x, b + y
            d = (y - x) / (x + y)
            worst, best = min(worst, d), max(best, d)
        return [(b - g) / (b + g), worst, best, np.log(g / (len(text) + 16)), np.log(len(plain(text)) / (len(text) + 16)), np.log(len(text) + 16)]

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Columns of the curve: linear, and the differences by length; nothing lies beyond what was fitted,
        so a text of the dictionary itself counts as the clearest one seen."""
        z = (np.clip(x, self.low, self.high) - self.center) / self.scale
        bend = np.maximum(0, -z[:, :3])  # steeper below the middle than above, never turning back
        return np.column_stack([z, bend, z[:, 3:5] ** 2, z[:, :5] * z[:, -1:], bend * z[:, -1:], z[:, 3:4] * z[:, 4:5], np.ones(len(z))])

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.prior)
        x = np.array([self.sizes(t) for t in texts]).reshape(len(texts), 6)
        return 1 / (1 + np.exp(-np.clip(self.expand(x) @ self.weights, -30, 30)))


def fit(texts: dict[int, list[tuple[int, bytes]]], counts: dict[int, int], piece: int = 512, dictionary: int = 112_640, share: float = 0.4) -> CompressionModel:
    """Dictionaries from `share` of the sampled texts of each class, the curve from the rest."""
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 1.0
    if min(len(texts[0]), len(texts[1])) < 8:
        return CompressionModel(prior=prior)
    order = random.Random(7)
    cut, rest = {}, {}
    for y, rows in texts.items():
        rows = sorted(rows)
        order.shuffle(rows)
        n = max(4, int(len(rows) * share))
        cut[y], rest[y] = [p for _, t in rows[:n] for p in pieces_of(t, piece)], rows[n:]
    try:
        raw = {y: zstandard.train_dictionary(dictionary, cut[y]).as_bytes() for y in (0, 1)}
    except zstandard.ZstdError:  # too few pieces to train on: their own bytes serve as the dictionary
        raw = {y: b"".join(cut[y])[-dictionary:].ljust(8, b" ") for y in (0, 1)}
    model = CompressionModel(good=raw[1], bad=raw[0], piece=piece, prior=prior)
    y = np.array([1] * len(rest[1]) + [0] * len(rest[0]))
    x = np.array([model.sizes(t) for _, t in rest[1] + rest[0]])
    weight = np.where(y == 1, prior / max(1, len(rest[1])), (1 - prior) / max(1, len(rest[0]))) * len(y)
    model.low, model.high = x.min(axis=0), x.max(axis=0)
    model.center, model.scale = np.median(x, axis=0), x.std(axis=0) + 1e-6
    model.weights = logistic(model.expand(x), y, weight)
    return model


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", learn=None, per_class: int = 4000, class_bytes: int = 12_000_000, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: label 1 likelier), predicted."""
    model = fit(*sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class, class_bytes))
    return apply(docs, model, threshold)


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", learn=None, per_class: int = 4000, class_bytes: int = 12_000_000, threshold: float = 0.3) -> DataFrame:
    """The documents that classify() predicts 1 for, all columns kept."""
    model = fit(*sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class, class_bytes))
    held = docs.sparkSession.sparkContext.broadcast(model)  # a bounded model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.score(binaries(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def apply(docs: DataFrame, model, threshold: float, carry: list[str] | None = None) -> DataFrame:
    """Scores of whole texts, with the columns in `carry` kept."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a bounded model
    carry = [c for c in carry or [] if c != "doc_id"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"), *carry)
    schema = rows.select("doc_id", *carry, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batch: pa.RecordBatch) -> dict:
        score = held.value.score(binaries(batch.column("_text")))
        return {c: batch.column(c) for c in ("doc_id", *carry)} | {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_arrow(rows, run, schema)
