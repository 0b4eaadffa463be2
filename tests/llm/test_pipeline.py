"""The pipeline's stages on the smallest fixtures, against plain versions where decisions are exact; the op queries' columns."""

import re

import duckdb
import pytest

import corpus_pipeline as P
from colonnade.llm import decontam, queries
from colonnade.llm.common import stage_table

DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"],
    "op2": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["doc_id", "size", "source_size", "target", "taken"],
    "op7": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9": ["doc_id", "fingerprint", "component_id"],
    "op10": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
}


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_columns(spark, name):
    df = queries.queries()[name](spark, DIR)
    want = COLUMNS.get(name.split("_")[0], [])
    assert [c for c in want if c not in df.columns] == []
    assert df.count() > 0


def same_as_oracle(spark, name, folder):
    c = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = found.fetchall()
    df = queries.queries()[name](spark, folder)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_oracle(spark, name):
    same_as_oracle(spark, name, DIR)
    same_as_oracle(spark, name, "/root/testdata/sf0.01")


def test_base_columns_of_licences_and_sizes_of_the_mix(spark):
    """What SQL can say of two queries whose other columns it can't."""
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    phrases = " UNION ALL ".join(f"SELECT '{p}' AS p, '{label}' AS label, {len(p.split())} AS n" for p, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")))
    want = c.execute(rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        found AS (SELECT doc_id, i - 1 AS i, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), ({phrases}) WHERE array_to_string(w[i : i + n - 1], ' ') = p)
        SELECT doc_id, len(w), count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM d LEFT JOIN found USING (doc_id) GROUP BY ALL
    """).fetchall()
    got = queries.op2_license_scan(spark, DIR).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(r["n_base"] for r in got) > 0
    want = c.execute(r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n, sum(n) OVER (PARTITION BY source) FROM documents").fetchall()
    got = queries.op6_mixing(spark, DIR).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"]) for r in got) == sorted(want)


def test_op5_oracle_where_steps_are_above_one(spark):
    large = "/root/testdata/sf0.1"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{large}/embeddings.parquet'")
    found = c.execute(queries.oracle_sql()["op5_exact_top_k"]).fetchall()
    got = queries.queries()["op5_exact_top_k"](spark, large).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(found)


def test_op8_against_every_pair(spark):
    """Myers' distance of every item to every whole text, without pieces."""
    docs = [(r["doc_id"], decontam.normalise(r["text"])) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    items = [(r["item_id"], decontam.normalise(r["text"])) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    want = []
    for item, text in items:
        masks: dict[str, int] = {}
        for i, c in enumerate(f" {text} "):
            masks[c] = masks.get(c, 0) | 1 << i
        for doc, plain in docs:
            if (best := decontam.myers(masks, len(text) + 2, f" {plain} ")[0]) <= int(0.08 * len(text)):
                want.append((doc, item, best))
    got = queries.op8_benchmark_decontamination(spark, DIR).select("doc_id", "item_id", "distance").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    kinds = []
    for name, stage in P.STAGES[:-1]:
        docs = stage_table(stage(spark, docs, DIR), "stage")
        assert docs.columns == P.COLUMNS
        now = {r["doc_id"]: r for r in docs.collect()}
        assert set(now) <= set(before) and len(now) == docs.count()
        kinds.append((name, before, now))
        before = now
    _, before, now = kinds[2]  # substring dedup
    first = {}
    for i in sorted(before):
        w = re.findall(r"[^\x20\x09-\x0D]+", before[i]["text"])
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, r in before.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        if len(gone) == len(w) and w:
            assert i not in now
        else:
            assert now[i]["text"] == (r["text"] if not gone else " ".join(x for k, x in enumerate(w) if k not in gone)) and now[i]["n_chars"] == len(now[i]["text"])
    _, before, now = kinds[3]  # decontamination: exact leaks at least must go
    items = [decontam.normalise(r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    assert not [i for i, r in now.items() if any(x in decontam.normalise(r["text"]) for x in items)]
    mixed = P.run(spark, DIR).collect()
    assert sorted(r["doc_id"] for r in mixed) == sorted(now) and all(r["taken"] <= 3 * r["size"] for r in mixed)


def test_edited_copies_go(spark):
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join(words), " ".join([*words[:60], "edited", *words[61:100], "too", *words[101:]]), " ".join(words[:40] + words[90:])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in P.near_dedup_stage(spark, docs, DIR).collect()) == [0, 2]


def test_repeated_doc_ids(spark):
    text = lambda start: " ".join(f"w{k}" for k in range(start, start + 30))
    rows = [(1, text(0)), (2, text(100)), (2, text(100)), (3, text(0)), (3, text(200)), (4, text(300)), (4, text(400)), (5, text(300)), (5, text(400)), (None, text(0)), (6, text(500)), (None, text(600)), (None, text(600))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_dedup_stage(spark, docs, DIR)
    want = [(1, text(0)), (2, text(100)), (3, text(200)), (4, text(300)), (4, text(400)), (6, text(500)), (None, text(600))]
    assert got.columns == P.COLUMNS and sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that the stages use themselves."""
    text = lambda start, n=60: " ".join(f"w{k}" for k in range(start, start + n)) + "."
    rows = [(i, text(1000 * i), "en", f"s{i % 2}", 5) for i in range(20)]
    rows += [(30, None, "en", "s0", None), (31, "", None, None, 0), (None, None, None, None, None), (32, " \n\t", "de", "s1", 3), (33, text(10**6, 30_000), "en", "s1", 9), (34, "x" * 150_000, "en", "s1", 9)]
    rows += [(5, text(5000), "en", "s1", 5)] * 3 + [(None, text(10**7), "en", "s0", 5)] * 2 + [(35, f"{text(7000)[:-1]} {text(20_000_000)}", "fr", "s0", 1)]
    extra = ["row1", "row2", "own", "key", "root", "part", "rows", "n", "size", "fp", "_text", "h", "score"]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*r, *extra) for r in rows], kinds), rows


def test_each_stage_takes_odd_rows(spark):
    docs, rows = odd_documents(spark)
    for name, stage in P.STAGES:
        out = stage(spark, docs, DIR)
        got = out.collect()
        if name == "mixing sources to target weights":
            assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in got)
            continue
        assert out.columns == P.COLUMNS and len(got) <= len(rows)
        kept = sorted(((r["doc_id"], r["text"]) for r in got), key=str)
        if name == "SimHash near-dedup":  # one of the rows without words, one of the repeated ones, one of those with null ids
            want = {(i, t) for i, t, *_ in rows if (t or "").strip()} | {(30, None)}
            assert kept == sorted(want, key=str)
        elif name == "substring dedup":  # null ids lose nothing, repeated rows of an id keep each other's words
            assert sum(r["doc_id"] is None for r in got) == 3 and sum(r["doc_id"] == 5 for r in got) == 4
            assert next(r for r in got if r["doc_id"] == 35)["text"].startswith("w7059 w20000000 ")
        elif name == "benchmark decontamination":
            assert len(got) == len(rows)


def test_run_removes_what_it_staged(spark):
    from colonnade.llm.common import staged

    before = len(staged())
    assert P.run(spark, DIR).count() > 0
    assert len(staged()) - before < 8  # the mixing stage's own tables and the one it reads


def test_empty_table_passes_through(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage_table(stage(spark, docs, DIR), "empty")
    assert docs.count() == 0
