"""Each operator against a plain version of itself, on odd rows: nulls, empty and long texts, ties, repeats, no rows, extra columns."""

import base64
import hashlib
import random
import re
import subprocess
import sys
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from colonnade.llm import decontam, license_scan, mixing, quality, simhash, substring_dedup, token_counts, topk, toxicity, warc
from colonnade.llm import common

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, part int, size string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, "y") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    shared = prose(rng, 60, 10**6)
    rows = [(i, prose(rng, rng.randrange(1, 120)), f"s{i % 3}") for i in range(40)]
    rows += [(40 + i, f"{prose(rng, 20)} {shared} {prose(rng, 20)}", "s0") for i in range(6)]
    rows += [(50, rows[3][1], None), (51, rows[3][1], "s1"), (51, rows[3][1], "s1"), (52, None, "s1"), (53, "", None), (54, " \n\t ", "é"), (55, prose(rng, 30_000), "s2"), (56, "a " * 500, "s2"), (None, rows[4][1], "s0"), (57, "x", "Z")]
    return rows


def test_substring_dedup(spark, odd_rows):
    got = substring_dedup.remove_repeats(frame(spark, odd_rows), keep_text=True, carry=["lang"]).collect()
    first = {}
    for i, t, _ in sorted((r for r in odd_rows if r[0] is not None), key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = []
    for i, t, _ in odd_rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=key) == sorted(want, key=key)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def plain_removal(rows, window=13):
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k : k + window])] = min(i, first.get(tuple(w[k : k + window]), i))
    out = []
    for i, t in rows:
        w = (t or "").split()
        out.append((i, len({j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for j in range(k, k + window)})))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [32, 6])
def test_substring_dedup_where_prints_collide(spark, bits):
    """With prints of few bits nearly every window shares its print with windows of all parts between; no repeat may be lost to that."""
    rng = random.Random(12)
    passages = [prose(rng, 13 + k % 9, 10**6) for k in range(40)]
    rows = [(i, " ".join([prose(rng, 200, 10**6), passages[i % 40] if i % 3 else "", prose(rng, 200, 10**6)])) for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(df, print_bits=bits, part_bytes=20_000).collect()
    assert sorted(((r["doc_id"], r["n_removed"]) for r in got), key=str) == plain_removal(rows)


def test_substring_dedup_of_heavy_and_null_ids(spark):
    rng = random.Random(13)
    shared = [prose(rng, 30, 10**6) for _ in range(5)]
    text = lambda: f"{prose(rng, 40, 10**6)} {rng.choice(shared)} {prose(rng, 40, 10**6)}"
    rows = [(None, text()) for _ in range(300)] + [(50, text()) for _ in range(300)] + [(i, text()) for i in range(0, 100, 5)] + [(51, text()) for _ in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for wide in (30_000, 10**7):  # dealt by split ranges, and inside one range
        got = substring_dedup.remove_repeats(df, part_bytes=10_000, range_bytes=wide).collect()
        assert sorted(((r["doc_id"], r["n_removed"]) for r in got), key=str) == plain_removal(rows)


@pytest.mark.parametrize("letters", [substring_dedup.LETTERS, 3])
def test_phrase_automaton(letters):
    words = lambda t: t.encode().split()
    phrase = words(" ".join(f"p{k}" for k in range(20)))
    machine = substring_dedup.PhraseAutomaton([(phrase, None), (words(" ".join(f"q{k}" for k in range(13))), 7)], 13, letters)
    assert machine.wide == 1 + (letters == 3)
    text = [b"x", *phrase[3:18], b"y", *phrase[:12], b"z"]
    assert np.flatnonzero(machine.covered(text, 1)).tolist() == list(range(1, 16))
    own = words(" ".join(f"q{k}" for k in range(13)))
    assert machine.covered(own, 7) is None and machine.covered(own, 8).all()


def reference_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(spark, odd_rows):
    rng = random.Random(4)
    words = prose(rng, 200, 10**6).split()
    near = [(100 + i, " ".join([*words[:i], "Zz", *words[i:]]), "s0") for i in range(0, 90, 3)]
    rows = odd_rows + near
    got = simhash.digest(simhash.near_duplicates(frame(spark, rows))).collect()
    prints = [(i, reference_fingerprint(t)) for i, t, _ in rows]
    root = {p: p for _, p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(((i, f"{p:016x}", least.get(find(p))) for i, p in prints), key=key)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("cap", [4096, 50])
def test_simhash_links_of_large_groups(spark, cap):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ np.array([int(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False))) for _ in range(30)], np.uint64) for b in base]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = simhash.links(df, 4, cap).collect()
    index = {int(v): i for i, v in enumerate(fps.view(np.int64))}
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    want = simhash.roots(near[:, 0], near[:, 1], len(fps))
    a, b = (np.array([index[r[c]] for r in found]) for c in ("a", "b"))
    assert (simhash.roots(a, b, len(fps)) == want).all()
    tree = simhash.GrayIndex(fps)
    q, row = tree.pairs(fps[:50], 4)
    assert sorted(zip(q.tolist(), tree.order[row].tolist())) == sorted((i, j) for i, j in near.tolist() if i < 50)


@pytest.mark.parametrize("size", [1, 3, 40, 5000])
def test_gray_index_prunes(size):
    """Every size of shard goes through the tree; with a table's blocks fixed, few nodes are left at each level."""
    rng = np.random.default_rng(16)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, size, dtype=np.uint64), rng.integers(0, 4, size, dtype=np.uint64)]))
    found = set()
    for t in range(len(simhash.TABLES)):
        moved, fixed = simhash.in_front(fps, t)
        assert sorted(map(int.bit_count, moved.tolist())) == sorted(map(int.bit_count, fps.tolist())) and len(set(moved.tolist())) == len(fps)
        index = simhash.GrayIndex(moved)
        q, row = index.pairs(index.fps, 4, fixed, np.arange(len(fps)))
        plain = np.argwhere((np.bitwise_count(index.fps[:, None] ^ index.fps[None, :]) <= 4) & ((index.fps[:, None] ^ index.fps[None, :]) & np.uint64(fixed) == 0)) if size <= 40 else None
        if plain is not None:
            assert sorted(zip(q.tolist(), row.tolist())) == [(i, j) for i, j in plain.tolist() if i < j]
        elif t == 0:
            visited = sum(len(m) for m, _, _ in index.levels) * len(fps)
            assert len(index.levels) >= 4 and index.pruned > 5 * len(fps) and index.pruned < visited / 10
        found |= {frozenset(x) for x in zip(fps[index.order[q]].tolist(), fps[index.order[row]].tolist())}
    if size <= 40:
        near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))
        assert found == {frozenset((int(fps[i]), int(fps[j]))) for i, j in near}


def test_near_copies(spark, odd_rows):
    rng = random.Random(7)
    edited = []
    for n in range(60):  # texts with words changed here and there: similarity on both sides of 0.8
        words = prose(rng, 150, 10**6).split()
        edited.append((300 + 2 * n, " ".join(words), "s0"))
        for k in rng.sample(range(150), n % 6):
            words[k] = "edited"
        edited.append((301 + 2 * n, " ".join(words), "s0"))
    rows = odd_rows + edited
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    near = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or 10 * len(a & b) >= 8 * len(a | b)]
    assert sum(sets[i] != sets[j] for i, j in near) > 20
    root = simhash.roots(*np.array(near).T, len(rows))
    least = {r: min((rows[k][0] for k in np.flatnonzero(root == r) if rows[k][0] is not None), default=None) for r in root.tolist()}
    key = lambda x: (x[0] is None, x[0] or 0)
    for cap in (2048, 8):
        got = simhash.near_copies(frame(spark, rows), cap=cap).collect()
        assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=key) == sorted(((rows[k][0], least[r]) for k, r in enumerate(root.tolist())), key=key)
    assert simhash.near_copies(frame(spark, [])).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)] + [(300, 300 + i) for i in range(1, 150)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[200] == got[150] == 100 and all(got[300 + i] == 300 for i in range(1, 150))


def test_license_scan(spark, odd_rows):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rows = odd_rows + [(200, "MIT License mit-license", "s"), (201, "the GNU General Public License, Apache LICENSE apache\nlicense", "s"), (202, f"pre {mit} post", "s"), (203, mit.replace("hereby", "hereby and gladly"), "s"), (204, "general public", "s"), (205, "ÀMIT license mit licenseé", "s")]
    got = license_scan.scan(frame(spark, rows)).collect()
    want = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        at = sorted((k, label) for p, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        want.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=key) == sorted(want, key=key)
    by = {r["doc_id"]: r for r in got}
    assert by[202]["labels"] == by[203]["labels"] == "mit" and by[202]["score"] == 1 and 0.6 <= by[203]["score"] <= 1 and by[202]["spans"][0]["start"] == 1
    assert by[200]["score"] == 1 and by[204]["labels"] == "" and license_scan.scan(frame(spark, [])).count() == 0


def test_notices_with_words_put_in(spark):
    mit = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction".split()
    put = lambda places: " ".join(w if k not in places else f"extra{k} {w}" for k, w in enumerate(mit))
    rows = [(0, put(()), "s"), (1, put((5, 15)), "s"), (2, put((4, 12, 20)), "s"), (3, " ".join([*mit[:14], "a", "b", "c", *mit[14:]]), "s"), (4, " ".join([*mit[:12], *["q"] * 6, *mit[12:]]), "s"), (5, " ".join(mit[:9] + mit[12:]), "s")]
    rows += [(6, "this work X is licensed Y under a Z creative commons attribution", "s"), (7, f"{put(())} {put((5,))} and {put(())}", "s"), (8, "of this software is in the software to any person " * 40, "s"), (9, "of the " * 5000, "s")]
    by = {r["doc_id"]: r for r in license_scan.scan(frame(spark, rows)).collect()}
    assert all(by[i]["labels"] == "mit" and by[i]["score"] >= 0.75 for i in (0, 1, 2, 3, 4, 5)) and by[6]["labels"] == "cc-by" and by[6]["score"] == 0.625
    assert len(by[7]["spans"]) == 3 and all(x["end"] <= y["start"] for x, y in zip(by[7]["spans"], by[7]["spans"][1:]))
    assert by[8]["labels"] == by[9]["labels"] == ""


def test_license_scan_is_native(spark, odd_rows):
    for df in (license_scan.cast_votes(frame(spark, odd_rows).withColumn("text", F.upper("text"))), license_scan.scan(frame(spark, odd_rows))):
        assert not re.search("Python|Pandas|InArrow", df._jdf.queryExecution().executedPlan().toString())


def test_warc(spark, odd_rows, tmp_path):
    rows = [(i, None if i == 52 else f"http://h/{i}\r\nX: y", t) for i, t, _ in odd_rows]
    rows += [(None, "http://n/1", "no id has this"), (None, "http://n/2", "no id has this"), (None, "http://n/1", "no id has this")] + [(60, "http://same", "the very same")] * 5
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, part string")
    out, manifest = warc.write_archives(pages, f"file://{tmp_path}/a", roll=20_000, part_bytes=1 << 16)
    got = warc.read_archives(out, manifest).collect()
    least, done, want = {}, set(), []
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, _, t in rows:
        p = (t or "").encode()
        first = least.get(t or "")
        own = first == i and t not in done
        done |= {t} if own else set()
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if own else "revisit", None if own else first))
    key = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    again = warc.write_archives(pages.repartition(3), f"file://{tmp_path}/b", roll=20_000, part_bytes=1 << 16)[1]
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, again.collect())) and manifest.count() > 2
    assert warc.read_archives(*warc.write_archives(pages.limit(0), f"file://{tmp_path}/c")).count() == 0
    assert not list(tmp_path.glob("a/_temporary*"))
    heads = [warc.parse(m)[0] for f in tmp_path.glob("a/*.gz") for m in warc.members(open(f, "rb"))]
    ids = [h["warc-record-id"] for h in heads]
    assert len(ids) == len(set(ids)) and {h["warc-refers-to"] for h in heads if h["warc-type"] == "revisit"} <= {h["warc-record-id"] for h in heads if h["warc-type"] == "response"}


def test_warc_files_are_named_once(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(50)], "page_id long, url string, html string")
    out, manifest = warc.write_archives(pages, f"file://{tmp_path}/a")
    before = sorted(map(tuple, manifest.collect()))
    written = manifest.selectExpr("*", "concat('_temporary/', file, '.gone') AS temp")  # a commit that is repeated: its temporary files are gone
    assert sorted(map(tuple, warc.name_files(written, out).collect())) == before and warc.read_archives(out, manifest).count() == 50


def test_warc_heavy_ids(spark, tmp_path):
    rows = [(None, f"n{i}", f"{i % 50} " * 3000) for i in range(400)] + [(7, f"u{i}", f"{i % 90} " * 3000) for i in range(400)] + [(i, "u", f"page {i}") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    out, manifest = warc.write_archives(pages, f"file://{tmp_path}/a", part_bytes=1 << 18)
    assert manifest.where("part < 0").count() > 3 and manifest.count() > 12
    got = warc.read_archives(out, manifest).collect()
    assert len(got) == len(rows) and sum(r["record_type"] == "response" for r in got) == len({t for _, _, t in rows})
    assert all(r["refers_to"] == 7 for r in got if r["record_type"] == "revisit")


def test_warc_damage():
    member = warc.record(1, "http://x", b"abc", warc.base32_sha1(b"abc"), "2000-01-01T00:00:00Z", "r")
    headers, block = warc.parse(zlib.decompress(member, 31))
    assert headers["warc-type"] == "response" and block.endswith(b"\r\n\r\nabc")
    with pytest.raises(ValueError):
        warc.parse(zlib.decompress(member, 31).replace(b"abc", b"abd"))


def plain_top_k(rows, k, asks):
    """Ranking of every asking row, by place in the table."""
    whole = {}
    for n, (i, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all():
            whole[n] = [max(-(2**63) + 1024, min(2**63 - 1024, int(np.floor(64 * float(np.float32(x)))))) for x in v]
    want = []
    for q, e in whole.items():
        if asks(rows[q][0]):
            scores = [(sum(a * b for a, b in zip(e, f)), rows[n][0]) for n, f in whole.items() if n != q and len(f) == len(e)]
            scores = [(max(-(2**63) + 1, min(2**63 - 1, s)), i) for s, i in scores]
            best = sorted(scores, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
            want += [(rows[q][0], r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(want, key=str)


def test_top_k(spark):
    rng = np.random.default_rng(6)
    vector = lambda size: [float(x) for x in rng.normal(0, 0.2, size)]
    rows = [(i, vector(8)) for i in range(300)]
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (304, [1.0]), (305, []), (306, rows[40][1]), (307, [0.0] * 8), (320, rows[40][1])]
    rows += [(40, rows[40][1]), (40, vector(8)), (60, vector(8)), (61, vector(8)), (61, rows[60][1]), (None, vector(8)), (None, rows[20][1]), *((340 + i, vector(5)) for i in range(30)), (400, [1.5])]
    schema = "vec_id long, embedding array<float>"
    asks = lambda i: i is not None and i % 20 == 0
    for shard, index in ((65_536, 16_384), (90, 40)):
        got = topk.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0, k=7, shard_rows=shard, index_rows=index, block_rows=6).collect()
        assert sorted(map(tuple, got), key=str) == plain_top_k(rows, 7, asks)
    assert topk.top_k(spark.createDataFrame([], schema), F.lit(True)).count() == 0 == topk.top_k(spark.createDataFrame(rows, schema), F.lit(False)).count()
    few = topk.top_k(spark.createDataFrame(rows[:3], schema), F.lit(True)).collect()
    assert len(few) == 6


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 6) * 10.0 ** rng.integers(0, 9)]) for i in range(120)] + [(200, [3e38, -3e38, 1.0, 0.0, 0.0, 0.0]), (220, [3e38] * 6)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted(map(tuple, got), key=str) == plain_top_k(rows, 5, lambda i: i % 20 == 0)


@pytest.mark.parametrize("high", [12, 60, 0.3])
def test_top_k_stops_on_proof(high):
    rng = np.random.default_rng(6)
    rows = np.floor(rng.standard_normal((3000, 32)) * high).astype(np.int64)
    rows[1500:1600] = rows[7]
    asks = np.arange(0, 3000, 40)
    index = topk.ImpactIndex(rows)
    who, row, score, took = index.search(rows[asks], asks, 20)
    whole = rows[asks] @ rows.T
    for n, q in enumerate(asks.tolist()):
        want = sorted((-int(s), i) for i, s in enumerate(whole[n].tolist()) if i != q)[:20]
        assert list(zip((-score[who == n]).tolist(), row[who == n].tolist())) == want
    if high > 1:
        assert len(index.segments) >= 5 and (took < len(index.segments)).mean() > 0.9
    floor = np.sort(whole, axis=1)[:, -10].astype(float)
    who, row, score, _ = index.search(rows[asks], asks, 20, floor)
    for n, q in enumerate(asks.tolist()):
        want = sorted((-int(s), i) for i, s in enumerate(whole[n].tolist()) if i != q and s >= floor[n])[:20]
        assert set(want) <= set(zip((-score[who == n]).tolist(), row[who == n].tolist()))


def test_mixing(spark, odd_rows):
    docs = frame(spark, odd_rows)
    got = mixing.mix(docs).collect()
    sizes, total = {}, 0
    for i, t, s in odd_rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        total += n
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = set()
    while True:
        share = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and share * weight[s] > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    assert len(got) == len(odd_rows)
    taken = {}
    for r in got:
        want = 3 * sizes[r["source"]] if r["source"] in capped else share * weight[r["source"]]
        assert r["target"] == pytest.approx(want) and r["source_size"] == sizes[r["source"]] and r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        taken.setdefault(r["source"], [0, want, 0])
        taken[r["source"]][0] += r["taken"]
        taken[r["source"]][2] = max(taken[r["source"]][2], r["size"])
    assert all(abs(a - b) <= c / 2 + 1 for a, b, c in taken.values())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)
    order = mixing.curriculum(mixing.mix(docs)).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order) and sum(r["size"] for r in order) == sum(r["taken"] for r in got)
    placed = mixing.by_position(mixing.mix(docs)).collect()
    assert sorted(x for r in placed for x in r["positions"]) == [r["position"] for r in order] and all(len(r["positions"]) == r["copies"] for r in placed)
    assert all(r["positions"] == sorted(r["positions"]) and (r["positions"] or [None])[0] == r["first_position"] for r in placed)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_curriculum_inverts_the_schedule():
    for a in (-0.9, 0.0, 0.5, 1.0):
        for u in np.linspace(0, 1, 11):
            t = 2 * u / ((1 - a) + np.sqrt((1 - a) ** 2 + 4 * a * u)) if u else 0.0
            assert t + a * (t * t - t) == pytest.approx(u)


def test_decontamination(spark, odd_rows):
    rng = random.Random(8)
    item = prose(rng, 40, 10**6)
    bent = item.replace(item.split()[5], "changed").upper().replace(" ", ", ")
    rows = odd_rows + [(300, f"before {item} after", "s"), (301, f"x {bent}!", "s"), (302, item[: len(item) // 2], "s")]
    bench = spark.createDataFrame([(1, item, "e"), (2, None, "e"), (3, "...", "e"), (4, prose(rng, 30, 10**6), "e"), (1, item, "e")], "item_id long, text string, lang string")
    for block, held in ((2_000_000, 4), (100, 1)):
        got = decontam.find_leaks(frame(spark, rows), bench, block_chars=block, held_blocks=held).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(300, 1), (300, 1), (301, 1), (301, 1)]
        assert {r["doc_id"]: r["distance"] == 0 for r in got} == {300: True, 301: False}
        kept = decontam.drop_leaks(frame(spark, rows), bench, block_chars=block, held_blocks=held)
        assert kept.count() == len(rows) - 2 and kept.columns == frame(spark, rows).columns
    assert decontam.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0 == decontam.find_leaks(frame(spark, []), bench).count()


def test_pigeonhole_finds_all_that_distance_allows():
    rng = random.Random(9)
    for _ in range(40):
        text = "".join(rng.choice("abcd ") for _ in range(300))
        at, size = rng.randrange(150), rng.randrange(20, 120)
        piece = list(text[at : at + size])
        for _ in range(rng.randrange(8)):
            piece[rng.randrange(len(piece))] = rng.choice("abcd")
        item = decontam.normalise("".join(piece))
        plain = decontam.normalise(text)
        best = min_distance(f" {item} ", f" {plain} ")
        found = decontam.Matcher([(1, item)], 0.1, 1).matches(plain)
        assert bool(found) == (best <= int(0.1 * len(item))) and (not found or found[0][1] == best)


def test_short_items_match_whole_words_and_texts(spark):
    bench = spark.createDataFrame([(1, "No"), (2, "a"), (3, "One two three four")], "item_id long, text string")
    texts = ["we know it", "a cat", "No.", "A", "none two three four", "so one two, three four five", "xone two three fourx", None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = decontam.find_leaks(frame(spark, rows), bench, rate=0.0).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(2, 1), (3, 2), (5, 3)]
    assert next(r["end"] for r in got if r["doc_id"] == 5) == len("so one two three four")
    ties = decontam.find_leaks(frame(spark, [(1, "one two three four x one two three four", "s"), (None, "one two three four", "s")]), bench).collect()
    assert sorted(((r["doc_id"], r["end"]) for r in ties), key=str) == [(1, 18), (None, 18)]


def min_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_token_counts(spark, odd_rows):
    with open(token_counts.VOCABULARY, "rb") as f:
        encode = token_counts.encoder(f.read())
    code = "def f(x):\n    return x['it'] + 'don\'t' * 12 # 3rd\x1c\u2028end\r\n\t" * 60
    rows = odd_rows + [(400, "tabs\t\tand  double  spaces\n\nlines é ñ 漢字 it's we'll " * 40, "s"), (401, "word\n" * 3000, "s"), (402, "漢字仮名。、！" * 900, "s"), (403, code, "s"), (404, "x" * 9000, "s"), (405, "a1'b2'll ½ e\u0301 " * 300, "s")]
    df = frame(spark, rows)
    got = token_counts.count_edited(df, token_counts.sample_edits(), leaf=64).join(df.select("doc_id", "text", token_counts.sample_edits().alias("edits")).distinct(), "doc_id").collect()
    assert len(got) == len([r for r in rows if r[0] is not None])
    for r in got:
        text = r["text"] or ""
        assert r["n_tokens"] == len(encode(text)) and r["tree"][0] == r["tokens_after"]
        for e in r["edits"]:
            a, b = min(e["start"], len(text)), min(max(e["start"], e["end"]), len(text))
            text = text[:a] + e["text"] + text[b:]
        assert (r["tokens_after"], r["chars_after"]) == (len(encode(text)), len(text))
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["reencoded_chars"] < 1500 < 40 * by[i]["n_leaves"] for i in (55, 401, 402)) and by[404]["n_leaves"] == 1
    trees = token_counts.build_trees(df, leaf=64)
    kept = token_counts.count_edited(trees, token_counts.sample_edits(), leaf=64, kept=True).drop("tree").collect()
    assert sorted(map(str, kept)) == sorted(map(str, token_counts.count_edited(df, token_counts.sample_edits(), leaf=64).drop("tree").collect()))
    nulls = token_counts.count_edited(df, F.lit(None))
    assert nulls.where("tokens_after <> n_tokens OR reencoded_chars > 0").count() == 0
    assert token_counts.count_edited(frame(spark, []), F.lit(None)).count() == 0


def test_trees_of_many_edits():
    with open(token_counts.VOCABULARY, "rb") as f:
        encode = token_counts.encoder(f.read())
    rng = random.Random(17)
    signs = ["word", " ", "\n", "  ", "'", "'ll", "7", "!", "é", "漢字", "\t", "x" * 50, " the cat", "\x1d", "e\u0301"]
    for _ in range(60):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(400)))
        tree = token_counts.TokenTree(text, encode, 16)
        for _ in range(12):
            a = rng.randrange(len(text) + 3)
            b, new = a + rng.randrange(30), "".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 3, 60])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[max(a, b) :]
            assert tree.text() == text and tree.total() == len(encode(text)) and tree.chars[1] == len(text)
            tree = token_counts.TokenTree(text, encode, 16, tree.kept()) if rng.random() < 0.3 else tree


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(10)
    good = [f"{prose(rng, rng.randrange(20, 80))}." for _ in range(120)]
    bad = [" ".join(f"{w.upper()}!!$$" for w in prose(rng, rng.randrange(20, 80)).split()) for _ in range(60)]
    rude = [g.replace(g.split()[3], rng.choice(["blockhead", "nitwit", "scoundrel"]), 1) for g in good[:60]]
    return good, bad, rude


def test_quality(spark, labelled):
    good, bad, _ = labelled
    rows = [(i, t, "s") for i, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(i, int(i < len(good)), "e") for i in range(len(rows))] + [(None, 1, "e"), (5, None, "e"), (9999, 0, "e")], "doc_id long, quality int, text string")
    extra = [(500, None, "s"), (501, "", "s"), (502, "x" * 200_000, "s"), (None, good[0], "s"), (3, good[3], "s")]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    got = quality.classify(frame(spark, rows + extra), labels, learn=learn).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [(r["predicted"], int(r["doc_id"] < len(good))) for r in got if r["doc_id"] is not None and r["doc_id"] < 500 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert [r["score"] for r in quality.classify(frame(spark, rows[:1]), labels.limit(0)).collect()] == [1.0]
    assert quality.classify(frame(spark, []), labels).count() == 0
    kept = quality.keep_good(frame(spark, rows), labels, learn=learn)
    assert kept.columns == frame(spark, rows).columns and len(good) * 0.9 < kept.count() < len(rows) - len(bad) * 0.8


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 40, "x" * (i * 10)) for i in range(400)] + [(50, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2 + [(50, 1), (None, 1)], "doc_id long, quality int")
    got, counts = quality.sample(docs, labels, "quality", F.lit(True), 15, 20_000)
    assert counts == {0: 40, 1: 41} and all(0 < len(got[y]) <= 15 and sum(len(t) for _, t in got[y]) <= 20_000 for y in (0, 1))
    again, _ = quality.sample(docs.repartition(3), labels, "quality", F.lit(True), 15, 20_000)
    assert got == again


def test_compression_pieces_cover_the_text():
    for n in (0, 1, 511, 512, 513, 5000):
        text = bytes(range(256)) * 20
        pieces = quality.pieces_of(text[:n], 512)
        assert b"".join(pieces) == text[:n] and max(map(len, pieces)) <= 512
    model = quality.CompressionModel(good=b"good words " * 50, bad=b"!!bad$$ " * 50)
    x = model.sizes(b"good words and some more " * 100)
    make = lambda raw: quality.zstandard.ZstdCompressor(level=3, dict_data=quality.zstandard.ZstdCompressionDict(raw), write_content_size=False, write_dict_id=False)
    each = [(len(make(model.good).compress(p)), len(make(model.bad).compress(p))) for p in quality.pieces_of(b"good words and some more " * 100, 512)]
    g, b = map(sum, zip(*each))
    assert x[0] == pytest.approx((b - g) / (b + g)) and x[1] == pytest.approx(min((j - i) / (i + j) for i, j in each)) and x[2] == pytest.approx(max((j - i) / (i + j) for i, j in each))


def test_toxicity(spark, labelled):
    good, _, rude = labelled
    rows = [(i, t, "s") for i, t in enumerate(good + rude)]
    labels = spark.createDataFrame([(i, int(i >= len(good))) for i in range(len(rows))] + [(None, 1), (7, None)], "doc_id long, toxic int")
    probes = [(500, f"{good[1]} n i t w i t", "s"), (501, f"{good[2]} block-head", "s"), (502, f"{good[2]} nitwwit", "s"), (503, None, "s"), (504, "", "s"), (505, "q" * 100_000, "s"), (None, rude[0], "s"), (3, good[3], "s"), (3, good[3], "s"), (506, f"{good[4]} blockxhead", "s")]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    found = toxicity.classify(frame(spark, rows + probes), labels, learn=learn).collect()
    got = {r["doc_id"]: r for r in found}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(found) == len(rows) + len(probes) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    assert len({r["score"] for r in found if r["doc_id"] == 3}) == 1 and got[None]["predicted"] == 1
    assert np.mean([got[i]["predicted"] == int(i >= len(good)) for i in held]) > 0.95
    assert all(got[i]["predicted"] == 1 for i in (500, 501, 502, 506)) and all(got[i]["predicted"] == 0 for i in (503, 504, 505))
    assert [r["score"] for r in toxicity.classify(frame(spark, rows[:1]), labels.limit(0)).collect()] == [0.0]
    assert toxicity.classify(frame(spark, []), labels).count() == 0


def test_kernel_tolerates_gaps():
    k = lambda a, b: toxicity.kernel(toxicity.subsequences(a, 8, 0.8), toxicity.subsequences(b, 8, 0.8))
    near = lambda a, b: k(a, b) / (k(a, a) * k(b, b)) ** 0.5
    assert near("idiot", "idiot") == pytest.approx(1) and near("idiot", "idxiot") > 0.6 > 0.2 > near("idiot", "theory")
    assert list(toxicity.subsequences("abc", 8, 0.5).values()) == [0.125] and toxicity.subsequences("ab", 8, 0.5) == {}


def test_kernels_equal_the_plain_kernel():
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(0, 25))) for _ in range(300)] + ["aaaaaaa", "abcabcabc", "", "ab"]
    model = toxicity.KernelModel(landmarks=[w for w in words if len(w) >= 3][:40])
    sub = {w: toxicity.subsequences(w, model.span, model.decay) for w in words}
    plain = [[(toxicity.kernel(sub[a], sub[b]) / (toxicity.kernel(sub[a], sub[a]) * toxicity.kernel(sub[b], sub[b])) ** 0.5) ** model.power if sub[a] else 0 for b in model.landmarks] for a in words]
    assert np.allclose(model.kernels(words), plain, atol=1e-4)
    for w in words[:20]:  # and the weights against a sum over all places
        want = {}
        for i, j, m in combinations(range(len(w)), 3):
            if m - i < model.span:
                code = tuple(toxicity.coded([w])[0][[i, j, m]].tolist())
                want[code] = want.get(code, 0) + model.decay ** (m - i + 1)
        assert sorted(sub[w].values()) == pytest.approx(sorted(want.values()))


def test_text_values_are_sums_over_sentences():
    model = toxicity.KernelModel(landmarks=["nitwit", "gentle"], beta=np.array([2.0, -1.0], np.float32), bias=-0.5, curve=np.ones(6 + 2 * len(toxicity.MARKS) - 1), name=1)
    text = "You nitwit, n i t w i t. A gentle word\nand nitwits! " + "plain " * 40 + "nitwit"
    x = model.features(*toxicity.encoded([text.encode(), b"", b" \n "]))
    value = lambda *w: float(np.clip(model.values(list(w)).sum() - 0.5, -3, 3))
    want = sorted([value("you", "nitwit", "nitwit"), value("gentle", "word"), value("and", "nitwits"), value(*["plain"] * 32), value(*["plain"] * 8, "nitwit")], reverse=True)
    assert x[0, :3] == pytest.approx(want[:3], abs=1e-4) and x[1, :3] == pytest.approx([-1] * 3)
    assert sum(map(len, toxicity.sentences_of([t for t in toxicity.split([text.encode()])[0].as_py() if t]))) == 2 + 1 + 2 + 2 + 40 + 1


def test_toxicity_of_held_out_texts(spark):
    """At 0.7 on sf0.1: held-out toxic texts (6 in 100 of them have no insult at all), the same with a letter put into each insult, and clean ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(*quality.sample(docs, labels, "toxic", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, 1500, 4_000_000))
    rows = [r for r in labels.join(docs, "doc_id").select("doc_id", "toxic", "text").collect() if r["toxic"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    insult = re.compile(r"\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron|(?:réeux|réê|achlich|achkeit|bomente|boco)\w+)\b")
    caught = lambda texts: np.mean(model.score([t.encode() for t in texts]) >= 0.7)
    toxic, clean = ([r["text"] for r in rows if r["toxic"] == y] for y in (1, 0))
    rng = random.Random(15)

    def put_in(match):
        word, at = match[0], rng.randrange(1, len(match[0]))
        return f"{word[:at]}x{word[at:]}"

    assert caught(toxic) > 0.9 and caught([insult.sub(put_in, t) for t in toxic]) > 0.8 and caught(clean) < 0.02


def test_staged_tables_go_with_the_process(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from colonnade.llm import common
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}").getOrCreate()
kept = common.stage_table(spark.range(5), "five")
gone = common.stage_table(spark.range(3), "three")
common.drop_table(gone)
assert kept.count() == 5 and len(common.staged()) == 1
{{end}}
"""
    for end in ("", "spark.stop()"):
        subprocess.run([sys.executable, "-c", code.replace("{end}", end)], check=True, capture_output=True, timeout=120)
        assert not [*tmp_path.glob("five-*"), *tmp_path.glob("three-*")]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Cluster:
        conf = Conf
        sparkContext = type("Context", (), {"master": "spark://somewhere:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Cluster)


def test_ranges(spark):
    df = spark.createDataFrame([(int(i), 1) for i in [*range(1000), 10**12, -(10**9), 5, 5]] + [(None, 1)], "id long, w int")
    found = common.ranges(df, "id", F.col("w"), 100)
    bounds = found.bounds.tolist()
    assert bounds == sorted(set(bounds)) and bounds[-1] == 10**12 and len(bounds) >= 9 and found.total == 1005
    ids = [r["id"] for r in df.collect()]
    want = [-1 if i is None else next(n for n, b in enumerate(bounds) if i <= b) for i in ids]
    assert found.place(pa.array(ids, pa.int64()), np.arange(len(ids), dtype=np.uint64)).tolist() == want
    packs = common.packed(df.withColumn("salt", F.xxhash64("w")), found, "id", "salt").collect()
    assert sorted((r["part"], i) for r in packs for i in common.from_ipc([r["rows"]])["id"].to_pylist() if i is not None) == sorted((n, i) for n, i in zip(want, ids) if i is not None)
    assert len(common.ranges(df.limit(0), "id", F.col("w"), 5).bounds) == 0


def test_ranges_split_heavy_and_null_keys_in_few_jobs(spark):
    df = spark.createDataFrame([(5, i) for i in range(3000)] + [(None, i) for i in range(3000)] + [(i * 10**9, i) for i in range(3000)], "id long, salt long")
    tracker, seen = spark.sparkContext.statusTracker(), []
    for target in (200, 2):
        spark.sparkContext.setJobGroup(f"ranges-{target}", "")
        found = common.ranges(df, "id", F.lit(1), target)
        seen.append(len(tracker.getJobIdsForGroup(f"ranges-{target}")))
        table = df.select("id", F.xxhash64("salt").alias("salt")).toArrow()
        parts, counts = np.unique(found.place(table["id"].combine_chunks(), table["salt"].to_numpy().view(np.uint64)), return_counts=True)
        assert counts.max() <= 4 * target + 8 and parts.min() < -3000 / (4 * target)
    assert max(seen) <= 24 and len(found.bounds) > 1000  # a number of jobs that does not follow the number of ranges
    spark.sparkContext.setJobGroup(None, None)
