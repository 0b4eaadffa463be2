"""Exact substring deduplication over word windows by sharded phrase automata.

Documents are dealt to parts, which are ranges of doc_id. Then
1. each part sends short prints of its windows to reducers, which tell it those that other parts
   have too;
2. each part sends the full keys of these windows (96 bits, told apart exactly by the reducers), and
   writes out the passages that they form; a reducer tells each part that holds a key to
   hand it on to the next part that does (a chain, so no part serves all others), and the parts do so, passage by passage;
3. each part compiles the passages it got, and those that repeat within itself, into
   an Aho-Corasick automaton of word blocks and streams its documents through it, as far as their windows have
   the hash of a phrase's window; hits are extended over equal words: removal rests on equal words, never on hashes.
A window of `window` words holds a whole aligned block of `window // 2 + 1` words
of any passage it lies in, so no occurrence is missed. Prints that different windows share cost time only;
a repeat could be lost only if two different windows of the corpus shared all 96 bits of their keys.

Parts: a doc_id's rows stay together, but for a doc_id so frequent that its rows are dealt over several parts
of one level; phrases go from a level to the next.

Defined results: null text counts as no words; rows with null doc_id are neither
smaller nor larger than others, so they keep all words and remove none (they are dealt over parts of their own); rows with the
same doc_id don't remove each other's words; each row gets a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binaries, distinct, drop_table, from_ipc, packed, parallelism, pow2, ranges, stage_table, to_ipc, trim, trimmed

MULTIPLIER, MIX, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
LETTERS = 0x10FFFF  # of the automaton's alphabet; where words outnumber it, two letters make a word
LEVEL = 20  # low bits of a part's number: the parts of one level


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(one: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of all windows inside the documents whose words, given by their hashes, are strung together."""
    n = len(one)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = one[: n - window + 1].copy()
    for j in range(1, window):
        h *= MULTIPLIER
        h += one[j : n - window + 1 + j]
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    ends = np.repeat(np.cumsum(lengths), lengths)[: len(h)]
    starts = np.flatnonzero(np.arange(len(h)) + window <= ends)
    return starts, h[starts]


def second_hashes(one: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """32 more bits of the windows at these places, of another hash."""
    h = np.zeros(len(starts), np.uint64)
    for j in range(window):
        h = (h ^ one[starts + j]) * SECOND
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(32)).astype(np.uint32)


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the values that are in `wanted`, which is sorted; a table of bits spares most of them the search."""
    if not len(wanted) or not len(values):
        return np.empty(0, np.int64)
    mask = np.uint64((1 << 23) - 1)
    table = np.zeros(1 << 23, bool)
    table[(wanted * MIX >> np.uint64(20)) & mask] = True
    some = np.flatnonzero(table[(values * MIX >> np.uint64(20)) & mask])
    at = np.minimum(np.searchsorted(wanted, values[some]), len(wanted) - 1)
    return some[wanted[at] == values[some]]


def _firsts(h: np.ndarray, more) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): windows sorted by hash, then place, and where each group of equal ones starts; more(places) gives the hashes' further bits, asked for where hashes are equal."""
    order = np.argsort(h, kind="stable")
    new = np.concatenate(([True], np.diff(h[order]) != 0)) if len(h) else np.empty(0, bool)
    again = np.flatnonzero(~new)
    if len(again):
        twice = distinct(np.concatenate((again - 1, again)))
        bits = np.zeros(len(h), np.uint32)
        bits[twice] = more(order[twice])
        if (bits[again] != bits[again - 1]).any():  # different windows of one hash
            low = np.zeros(len(h), np.uint32)
            low[order] = bits
            order = np.lexsort((low, h))
            new = np.concatenate(([True], (np.diff(h[order]) != 0) | (np.diff(low[order].astype(np.int64)) != 0)))
    return order, np.flatnonzero(new)


def _split(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    each = [t.split() for t in texts]
    return [w for words in each for w in words], np.fromiter(map(len, each), np.int64, len(each))


def _runs(at: np.ndarray, kind: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(start, end, kind) in words for runs of consecutive windows of one kind."""
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(kind) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    return list(zip(at[first].tolist(), (at[last] + window).tolist(), kind[first].tolist()))


class PhraseAutomaton:
    """Locates every place where words share `window` words or more with a passage of an earlier document."""

    def __init__(self, passages: list[tuple[list[bytes], int | None]], window: int, letters: int = LETTERS):
        self.window, self.block = window, window // 2 + 1
        self.owners = [owner for _, owner in passages]
        self.ids = {w: n for n, w in enumerate({w: None for words, _ in passages for w in words}, 1)}
        self.wide = 1 + (len(self.ids) >= letters)
        entries: dict[str, list[tuple[int, int]]] = {}
        self.passages = []
        for k, (words, _) in enumerate(passages):
            row = np.fromiter(map(self.ids.__getitem__, words), np.uint32, len(words))
            self.passages.append(row)
            coded, size = self._coded(row), self.block * self.wide
            for off in range(0, len(row) - self.block + 1, self.block):
                entries.setdefault(coded[off * self.wide : off * self.wide + size], []).append((k, off))
        self.machine = ahocorasick.Automaton()
        for key, found in entries.items():
            self.machine.add_word(key, found)
        if entries:
            self.machine.make_automaton()
        else:
            self.passages = []

    def _coded(self, row: np.ndarray) -> str:
        """A letter for each word, or two of separate alphabets."""
        if self.wide == 2:
            row = np.column_stack([row >> 19, 0x80000 + (row & 0x7FFFF)]).astype(np.uint32).ravel()
        return row.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")

    def covered(self, words: list[bytes], owner: int) -> np.ndarray | None:
        """True for each word inside a shared run; None if there is none. Passages owned by `owner` or later don't count."""
        if len(words) < self.window or not self.passages:
            return None
        get = self.ids.get
        row = np.fromiter([get(w, 0) for w in words], np.uint32, len(words))
        out, done = None, {}
        for end, found in self.machine.iter(self._coded(row)):
            end //= self.wide
            start = end - self.block + 1
            for k, off in found:
                if self.owners[k] is not None and self.owners[k] >= owner or done.get((k, start - off), -1) > end:
                    continue
                phrase = self.passages[k]
                right = self.block + _same(row[end + 1 :], phrase[off + self.block :])
                left = _same(row[:start][::-1], phrase[:off][::-1])
                done[(k, start - off)] = start + right
                if left + right >= self.window:
                    out = np.zeros(len(words), bool) if out is None else out
                    out[start - left : start + right] = True
        return out


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        to = min(n, at + step)
        differ = np.flatnonzero(a[at:to] != b[at:to])
        if len(differ):
            return at + int(differ[0])
        at, step = to, step * 8
    return n


CLAIM = np.dtype([("h", "<u8"), ("more", "<u4"), ("at", "<u4")])


def pack_claims(claims: np.ndarray) -> bytes:
    """Claims as compressed byte planes, whose high bytes hardly differ where rows are sorted."""
    return pa.compress(claims.view(np.uint8).reshape(-1, CLAIM.itemsize).T.tobytes(), "zstd", asbytes=True)


def unpack_claims(blob: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(CLAIM.itemsize, -1).T).view(CLAIM).ravel()


def remove_repeats(docs: DataFrame, window: int = 13, keep_text: bool = False, carry: list[str] | None = None, print_bits: int = 32, part_bytes: int = 5_000_000, range_bytes: int = 5_000_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed [start, end) in words), kept_sha256.

    With keep_text also kept_text, the kept words joined by one space, or the text itself where nothing goes; `carry` names further columns to return.
    The fewer the print_bits, the more windows are taken up for nothing. Texts of a part have about part_bytes, or are one document's.
    """
    spark, carry = docs.sparkSession, [c for c in carry or [] if c != "doc_id"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"), *carry, F.xxhash64(text).alias("_salt"))
    weight = F.octet_length(text) + 64
    total = docs.agg(F.sum(weight)).first()[0] or 0
    part_bytes = int(min(part_bytes, max(250_000, total / (4 * parallelism(spark)))))
    parts = ranges(docs, "doc_id", weight, min(range_bytes, part_bytes))

    def gather(table: pa.Table) -> pa.Table:
        """A range's documents by doc_id, however they were spread over the input, in parts of bounded size: (part, rows)."""
        whole, range_no = from_ipc(table["rows"].to_pylist()).sort_by("doc_id").combine_chunks(), table["part"][0].as_py()
        ids = whole["doc_id"].to_numpy()
        ends = np.cumsum(pa.compute.binary_length(whole["_text"].cast(pa.large_binary())).to_numpy() + 64)
        numbers, blobs = [], []
        at = level = sub = 0
        while at < len(ids):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + part_bytes, "right")))
            if range_no >= 0:  # a doc_id's rows stay together, unless they alone are too many
                ongoing = at > 0 and ids[at] == ids[at - 1]
                first = int(np.searchsorted(ids, ids[to])) if to < len(ids) and ids[to] == ids[to - 1] else to
                to = first if first > at and not ongoing else min(to, int(np.searchsorted(ids, ids[at], "right")))
                level, sub = (level, sub + 1) if ongoing else (level + 1, 0)
            else:
                level += 1
            low = level << LEVEL | sub
            numbers.append((range_no << 2 * LEVEL) + low)
            blobs.append(to_ipc(whole.slice(at, to - at)))
            at = to
        return pa.table({"part": pa.array(numbers, pa.int64()), "rows": pa.array(blobs, pa.binary())})

    base, split = parts.base, parts.splits

    def level_of(part: np.ndarray) -> np.ndarray:
        """Parts of a heavy doc_id's split ranges are of one level; so are those of one level number in a range."""
        at = np.searchsorted(base, part >> (2 * LEVEL), "right") - 1
        return np.where(split[at] > 1, base[at] << (2 * LEVEL), part >> LEVEL << LEVEL)

    loose = packed(rows, parts, "doc_id", "_salt")
    packs = stage_table(loose.groupBy("part").applyInArrow(trimmed(gather), "part long, rows binary"), "doc-packs")
    buckets = max(64, pow2(total / 6_000_000))
    bits, spare = np.uint64(int(np.log2(buckets))), np.uint64(32 - print_bits)

    def keys(h: np.ndarray) -> np.ndarray:
        """Bucket and print of a hash: its highest bits and 32 more."""
        return h >> (np.uint64(32) - bits) >> spare << spare

    def texts_of(blob: bytes) -> list[bytes]:
        return binaries(from_ipc([blob])["_text"].combine_chunks())

    def by_bucket(key: np.ndarray) -> tuple[list[int], np.ndarray]:
        cuts = np.searchsorted(key, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        return [b for b in range(buckets) if cuts[b] < cuts[b + 1]], cuts

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist()):
                if part < 0:
                    continue
                words, lengths = _split(texts_of(blob))
                key = distinct(keys(window_hashes(word_hashes(words), lengths, window)[1]))
                full, cuts = by_bucket(key)
                low = key.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([part] * len(full), pa.int64()), pa.array([low[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary())],
                    names=["bucket", "part", "prints"],
                )
        trim()

    def confirm(key: tuple, table: pa.Table) -> pa.Table:
        each, numbers = [np.frombuffer(x, np.uint32) for x in table["prints"].to_pylist()], table["part"].to_pylist()
        own = np.repeat(np.arange(len(each), dtype=np.uint64), [len(x) for x in each])
        seen = np.sort(np.concatenate(each).astype(np.uint64) << np.uint64(32) | own)
        value = seen >> np.uint64(32)
        same = np.concatenate(([False], value[1:] == value[:-1], [False]))
        seen = seen[same[1:] | same[:-1]]
        order = np.argsort(seen.astype(np.uint32), kind="stable")
        value, own = (seen[order] >> np.uint64(32)).astype(np.uint32), seen[order].astype(np.uint32)
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else []
        held = np.split(value, starts[1:]) if len(own) else []
        return pa.table({"part": pa.array([numbers[own[n]] for n in starts], pa.int64()), "bucket": pa.array([key[0].as_py()] * len(held), pa.int32()), "prints": pa.array([x.tobytes() for x in held], pa.binary())})

    found = packs.mapInArrow(prints, "bucket int, part long, prints binary").groupBy("bucket").applyInArrow(trimmed(confirm), "part long, bucket int, prints binary")
    confirmed = stage_table(found, "confirmed-prints")

    def claim(left: pa.Table, right: pa.Table) -> pa.Table:
        """The part's windows with prints that others have: their keys by bucket, and the passages they form (bucket -1), each window once."""
        buckets_, blobs, sizes = [], [], []
        if left.num_rows and right.num_rows:
            words, lengths = _split(texts_of(left["rows"][0].as_py()))
            one = word_hashes(words)
            at, h = window_hashes(one, lengths, window)
            wanted = np.sort(np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(x, np.uint32) for b, x in zip(right["bucket"].to_pylist(), right["prints"].to_pylist())]))
            hit = _among(keys(h), wanted)
            order, first = _firsts(h[hit], lambda places: second_hashes(one, at[hit[places]], window))
            mine = np.sort(hit[order[first]])  # each window at its first place
            claims = np.empty(len(mine), CLAIM)
            claims["h"], claims["more"], claims["at"] = h[mine], second_hashes(one, at[mine], window), np.arange(len(mine))
            claims.sort(order="h")
            full, cuts = by_bucket(keys(claims["h"]))
            passages = b"\n".join(b" ".join(words[a:b]) for a, b, _ in _runs(at[mine], np.zeros(len(mine), np.int8), window))
            buckets_, blobs, sizes = [*full, -1], [*(pack_claims(claims[cuts[b] : cuts[b + 1]]) for b in full), pa.compress(passages, "zstd", asbytes=True)], [*(int(cuts[b + 1] - cuts[b]) * CLAIM.itemsize for b in full), len(passages)]
        part = left["part"][0].as_py() if left.num_rows else 0
        return pa.table({"part": pa.array([part] * len(blobs), pa.int64()), "bucket": pa.array(buckets_, pa.int32()), "data": pa.array(blobs, pa.binary()), "size": pa.array(sizes, pa.int64())})

    claimed = packs.groupBy("part").cogroup(confirmed.groupBy("part")).applyInArrow(trimmed(claim), "part long, bucket int, data binary, size long")
    claims = stage_table(claimed, "claims")
    drop_table(confirmed)

    def chain(key: tuple, table: pa.Table) -> pa.Table:
        """For each key and part that holds it, the part of the next level before that does: (source, its windows, targets)."""
        each = [unpack_claims(x, n) for x, n in zip(table["data"].to_pylist(), table["size"].to_pylist())]
        numbers = table["part"].to_numpy()
        order = np.argsort(numbers, kind="stable")  # of equal keys, smaller parts come first
        each, numbers = [each[n] for n in order.tolist()], numbers[order]
        own = np.repeat(numbers, [len(x) for x in each])
        rows = np.concatenate(each)
        order = np.lexsort((rows["more"], rows["h"]))
        rows, own = rows[order], own[order]
        level = level_of(own)
        new = np.concatenate(([True], (np.diff(rows["h"]) != 0) | (np.diff(rows["more"].astype(np.int64)) != 0)))
        start = np.flatnonzero(new)[np.cumsum(new) - 1]  # first row of the key
        fresh = new | np.concatenate(([True], np.diff(level) != 0))
        before = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] - 1  # last row of an earlier level
        to = np.flatnonzero(before >= start)
        source = before[to]
        order = np.argsort(own[source], kind="stable")
        own_source, target, at = own[source][order], own[to][order], rows["at"][source][order]
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(own_source) != 0))) if len(order) else np.empty(0, np.int64)
        pieces = lambda x: pa.array([p.tobytes() for p in np.split(x, cuts[1:])] if len(cuts) else [], pa.binary())
        return pa.table({"part": pa.array(own_source[cuts], pa.int64()), "targets": pieces(target), "at": pieces(at)})

    chained = stage_table(claims.where("bucket >= 0").groupBy("bucket").applyInArrow(trimmed(chain), "part long, targets binary, at binary"), "chains")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        """The passages a part hands on, by target."""
        out: dict[int, bytes] = {}
        if left.num_rows and right.num_rows:
            lines = pa.decompress(left["data"][0].as_py(), left["size"][0].as_py(), "zstd", asbytes=True).split(b"\n")
            words, lengths = _split(lines)
            ends = np.repeat(np.cumsum(lengths), lengths)
            place = np.flatnonzero(np.arange(len(words)) + window <= ends)  # of the part's windows in these words
            to = np.concatenate([np.frombuffer(x, np.int64) for x in right["targets"].to_pylist()])
            at = np.concatenate([np.frombuffer(x, np.uint32) for x in right["at"].to_pylist()])
            order = np.lexsort((at, to))
            line = np.repeat(np.arange(len(lengths)), lengths)
            for some in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                mine = place[at[some]]
                out[int(to[some[0]])] = b"\n".join(b" ".join(words[a:b]) for a, b, _ in _runs(mine, line[mine], window))
        return pa.table({"part": pa.array(list(out), pa.int64()), "passages": pa.array([pa.compress(x, "zstd", asbytes=True) for x in out.values()], pa.binary()), "size": pa.array([len(x) for x in out.values()], pa.int64())})

    cuts = claims.where("bucket < 0").groupBy("part").cogroup(chained.groupBy("part")).applyInArrow(trimmed(cut), "part long, passages binary, size long")
    passages = stage_table(cuts, "passages")
    drop_table(claims)
    drop_table(chained)

    fields = {f.name: f for f in rows.schema}
    schema = T.StructType(
        [fields["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T._parse_datatype_string("array<struct<start:int,end:int>>")), T.StructField("kept_sha256", T.StringType())]
        + [T.StructField("kept_text", T.StringType())] * keep_text + [fields[c] for c in carry]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    target_schema = to_arrow_schema(schema)

    def gone_of(words: list[bytes], lengths: np.ndarray, ids: np.ndarray, got: list[list[bytes]]) -> dict[int, np.ndarray]:
        """True for each word that goes, of the documents (by row) that lose any."""
        one = word_hashes(words)
        at, h = window_hashes(one, lengths, window)
        if not len(at):
            return {}
        row = np.repeat(np.arange(len(lengths)), lengths)[at]
        order, first = _firsts(h, lambda places: second_hashes(one, at[places], window))
        sizes = np.diff(np.concatenate((first, [len(h)])))
        many = sizes > 1
        group = np.repeat(np.arange(int(many.sum())), sizes[many])
        inside = np.repeat(many, sizes)
        owner = ids[row[order[inside]]]
        head = order[first[many]]
        late = owner > ids[row[head]][group]
        shared = np.zeros(len(h), bool)
        shared[order[inside][late]] = True
        own = np.sort(head[distinct(group[late])])
        phrases: list[tuple[list[bytes], int | None]] = [(words[a:b], ids[r].item()) for a, b, r in _runs(at[own], row[own], window)]
        if got:
            strung = [w for x in got for w in x]
            theirs = window_hashes(word_hashes(strung), np.fromiter(map(len, got), np.int64, len(got)), window)[1]
            shared[_among(h, distinct(theirs))] = True
            phrases += [(x, None) for x in got]
        machine = PhraseAutomaton(phrases, window)
        hit = np.flatnonzero(shared)
        starts, out = np.concatenate(([0], np.cumsum(lengths))), {}
        for a, b, r in _runs(at[hit], row[hit], window):
            covered = machine.covered(words[a:b], ids[r])
            if covered is not None:
                gone = out.setdefault(r, np.zeros(lengths[r], bool))
                gone[a - starts[r] : b - starts[r]] |= covered
        return out

    def locate(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return target_schema.empty_table()
        table = from_ipc([left["rows"][0].as_py()])
        texts = binaries(table["_text"].combine_chunks())
        each = [t.split() for t in texts]
        gone_by_row: dict[int, np.ndarray] = {}
        if key[0].as_py() >= 0:
            got = [line.split() for blob, n in zip(right["passages"].to_pylist(), right["size"].to_pylist()) for line in pa.decompress(blob, n, "zstd", asbytes=True).split(b"\n")]
            gone_by_row = gone_of([w for x in each for w in x], np.fromiter(map(len, each), np.int64, len(each)), table["doc_id"].to_numpy(), got)
        columns: dict[str, list] = {f.name: [] for f in schema}
        for n, (text, words) in enumerate(zip(texts, each)):
            gone = gone_by_row.get(n)
            spans: list[dict] = []
            kept = words
            if gone is not None:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                spans = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
            joined = b" ".join(kept)
            for name, value in (("n_words", len(words)), ("n_removed", len(words) - len(kept)), ("spans", spans), ("kept_sha256", hashlib.sha256(joined).hexdigest())):
                columns[name].append(value)
            if keep_text:
                columns["kept_text"].append(text.decode() if gone is None else joined.decode())
        for c in ("doc_id", *carry):
            columns[c] = table[c].combine_chunks()
        return pa.Table.from_arrays([columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in target_schema], schema=target_schema)

    return packs.groupBy("part").cogroup(passages.groupBy("part")).applyInArrow(trimmed(locate), schema)
