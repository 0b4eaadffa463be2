"""Every registered query against its oracle at the smallest size, and the entry point without the llm package."""

import builtins
import importlib
import sys

import duckdb
import pytest

from colonnade.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def rows(cursor_rows):
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(plain, r)) for r in cursor_rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_equals_oracle(spark, duck, name):
    df = catalogue.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    found = duck.execute(catalogue.oracle_sql()[name])
    places = {d[0]: i for i, d in enumerate(found.description)}
    assert columns == sorted(places)
    want = [tuple(r[places[c]] for c in columns) for r in found.fetchall()]
    assert rows(tuple(r[c] for c in columns) for r in df.collect()) == rows(want)


def test_entry_without_llm(monkeypatch, spark):
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name.startswith(("colonnade.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.startswith(("colonnade.llm", "corpus_pipeline", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(catalogue.queries())
    assert entry.entry(spark).count() > 0
    monkeypatch.delitem(sys.modules, "__spark_entry__")
