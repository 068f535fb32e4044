"""Every registered query against its SQL counterpart on the smallest tables."""

import importlib.util
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from pagemill.registry import oracle
from pagemill.registry import queries as registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("events", "documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_entry_lists_the_registry():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_a_missing_library_of_llm_leaves_the_other_queries(monkeypatch):
    """The tokenizers may be absent, and the queries of llm with them."""
    for name in [m for m in sys.modules if m.startswith("pagemill.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    import pagemill

    monkeypatch.delattr(pagemill, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    spec = importlib.util.spec_from_file_location("entry_alone", entry.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert set(alone.queries()) == set(QUERIES) and set(alone.oracle_sql()) == set(SQL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    wanted = duck.execute(SQL[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, wanted.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["fid", "hash", "samelen"]
