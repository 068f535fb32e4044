"""Every query of the subpackage: against its SQL, or for its shape where SQL has none."""

import duckdb
import pytest

from pagemill.llm.queries import queries
from pagemill.llm.sql import oracle_sql

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    wanted = duck.execute(SQL[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, wanted.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_one_query_for_each_operator():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_source_mix", "op10_personal_data"])
def test_reruns_agree(spark, name):
    one, two = (sorted(map(tuple, QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert one == two and len(one) == 200
