"""Edit-aware token counts.

A document's text is cut into leaves at places where the pre-tokenizer always cuts, whatever stands further off: before white space, and
between letters, digits and other signs (but not after an apostrophe). A segment tree keeps the sums of characters and tokens
over the leaves. An edit re-encodes the leaves it touches, and a neighbour only where the cut
beside it no longer is such a place; then the sums above are updated. Leaves that have grown are cut again. What the
pattern never cuts, as a run of letters without a space, is one leaf however long it is.

The trees of a table (build_trees) can be kept and edited later without encoding the texts again.

Defined results: null text counts as empty; null edits as none; edits apply in their order, each to the text as
the ones before left it, with places beyond the end taken as the end; repeated rows each get a row;
extra columns are ignored. The vocabulary is read on the driver and sent to the tasks (its size is fixed).
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """Tokens of a text, as a function, for a vocabulary in tiktoken's format."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("held", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def kind(c: str) -> str:
    """Class of a character as the pattern sees it; "?" where programs differ on what white space is."""
    if c.isalpha():
        return "L"
    if c.isnumeric():
        return "N"
    if c.isspace():
        return "?" if "\x1c" <= c <= "\x1f" else "S"
    return "P"


def cuts(a: str, b: str) -> bool:
    """Whether the pattern always cuts between two characters next to each other."""
    x, y = kind(a), kind(b)
    return x not in "S?" and y != "?" and x != y and not (a == "'" and y == "L")


def leaves(text: str, size: int = 512) -> list[str]:
    """The text in pieces of `size` characters, or as much more as it takes to the next cut."""
    out, start, at = [], 0, size
    while at < len(text):
        if cuts(text[at - 1], text[at]):
            out.append(text[start:at])
            start, at = at, at + size
        else:
            at += 1
    return [*out, text[start:]]


class TokenTree:
    """Segment tree of character and token counts over the leaves of one text; `kept`: (characters, tokens) of the leaves of an earlier tree of it."""

    def __init__(self, text: str, encode, size: int = 512, kept: tuple[list[int], list[int]] | None = None):
        self.encode, self.size, self.encoded = encode, size, 0
        if kept is None:
            texts = leaves(text, size)
            self._grow(texts, [self._count(t) for t in texts])
        else:
            ends = [0, *accumulate(kept[0])]
            self._grow([text[a:b] for a, b in zip(ends, ends[1:])], list(kept[1]))

    def _grow(self, texts: list[str], counts: list[int]) -> None:
        """Sums over these leaves."""
        self.texts = texts
        self.width = 1 << (len(texts) - 1).bit_length()
        pad = [0] * (self.width - len(texts))
        self.chars, self.tokens = [0] * self.width + [len(t) for t in texts] + pad, [0] * self.width + counts + pad
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.encode(text))

    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.texts)

    def kept(self) -> tuple[list[int], list[int]]:
        return [len(t) for t in self.texts], self.tokens[self.width : self.width + len(self.texts)]

    def _leaf(self, place: int) -> tuple[int, int]:
        """(leaf, place in it) of a character; the end of the text is in the last leaf that has any."""
        if place >= self.chars[1]:
            last = next((i for i in reversed(range(len(self.texts))) if self.texts[i]), 0)
            return last, len(self.texts[last])
        node = 1
        while node < self.width:
            node *= 2
            if place >= self.chars[node]:
                place -= self.chars[node]
                node += 1
        return node - self.width, place

    def _put(self, leaf: int, text: str) -> None:
        self.texts[leaf] = text
        node = self.width + leaf
        self.chars[node], self.tokens[node] = len(text), self._count(text)
        while node := node // 2:
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters [start, end) by the new text."""
        start, end = max(0, start), max(0, start, end)
        first, a = self._leaf(start)
        last, b = self._leaf(end)
        region = self.texts[first][:a] + new + self.texts[last][b:]
        last = max(first, last)
        while True:  # take in neighbours until both ends are cuts again
            left = next((i for i in range(first - 1, -1, -1) if self.texts[i]), None)
            right = next((i for i in range(last + 1, len(self.texts)) if self.texts[i]), None)
            if left is not None and not (region and cuts(self.texts[left][-1], region[0])):
                first, region = left, self.texts[left] + region
            elif right is not None and not (region and cuts(region[-1], self.texts[right][0])):
                last, region = right, region + self.texts[right]
            else:
                break
        if len(region) > 2 * self.size:  # cut again; the other leaves keep their counts
            texts, counts = self.texts, self.kept()[1]
            new = leaves(region, self.size)
            self._grow(texts[:first] + new + texts[last + 1 :], counts[:first] + [self._count(t) for t in new] + counts[last + 1 :])
            return
        for i in range(first + 1, last + 1):
            if self.texts[i]:
                self._put(i, "")
        self._put(first, region)


EDITS = "array<struct<start:int,end:int,text:string>>"


def vocabulary_of(docs: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def build_trees(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = 512) -> DataFrame:
    """One row per document: doc_id, text, leaf_chars, leaf_tokens; a table to keep, and to hand to count_edited()."""
    held = vocabulary_of(docs, vocabulary)

    def run(batch: pa.RecordBatch) -> dict:
        encode = encoder(held.value)
        kept = [TokenTree(t or "", encode, leaf).kept() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "leaf_chars": [k[0] for k in kept], "leaf_tokens": [k[1] for k in kept]}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>")


def count_edited(docs: DataFrame, edits: Column, vocabulary: str = VOCABULARY, leaf: int = 512, kept: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_leaves, tokens_after, chars_after, reencoded_chars, tree (token sums, root first).

    With `kept` the documents are a table of build_trees(), whose trees are edited as they are.
    """
    held = vocabulary_of(docs, vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", edits.cast(EDITS).alias("edits"), *(["leaf_chars", "leaf_tokens"] if kept else []))

    def run(batch: pa.RecordBatch) -> dict:
        encode = encoder(held.value)
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_leaves", "tokens_after", "chars_after", "reencoded_chars", "tree")}
        trees = zip(*(batch.column(c).to_pylist() for c in ("leaf_chars", "leaf_tokens"))) if kept else [None] * batch.num_rows
        for text, changes, tree in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), trees):
            tree = TokenTree(text or "", encode, leaf, tree)
            before, size, first = tree.total(), len(tree.texts), tree.encoded
            for e in changes or []:
                if e is not None:
                    tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
            for k, v in zip(out, (before, size, tree.total(), tree.chars[1], tree.encoded - first, tree.tokens[1 : tree.width + len(tree.texts)])):
                out[k].append(v)
        return {"doc_id": batch.column("doc_id"), **out}

    return map_arrow(rows, run, "doc_id long, n_tokens long, n_leaves int, tokens_after long, chars_after long, reencoded_chars long, tree array<int>")


def sample_edits(text: str = "text") -> Column:
    """Three edits per document at places hashed from its id: a replacement, an insertion and a deletion."""
    n = F.coalesce(F.length(text), F.lit(0))
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), n + 1).cast("int")
    change = lambda a, b, t: F.struct(a.alias("start"), b.alias("end"), F.lit(t).alias("text"))
    return F.array(change(place(1), place(1) + 12, "edited passage"), change(place(2), place(2), " put in, "), change(place(3), place(3) + 40, ""))
