"""Source divergence against DuckDB, with digests that collide as well."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagemill.llm import divergence
from pagemill.llm.sql import _source_divergence


def by_sql(rows):
    docs = pd.DataFrame(rows, columns=["text", "lang", "source"], dtype=object)
    con = duckdb.connect()
    con.execute("CREATE TABLE given (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.execute("INSERT INTO given FROM docs")
    return sorted(con.execute(_source_divergence("given")).fetchall())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    # Names that the operator uses itself.
    return df.withColumns({n: F.lit("x") for n in ("doc_id", "group", "digest", "term", "n", "rank", "value", "item")})


def many_rows():
    words = "Ärger alpha Beta gamma delta epsilon zeta eta théta iota 漢字 kappa".split()
    rows = []
    for i in range(240):
        picked = [words[(i * k + k * k) % (5 + i % 8)] for k in range(i % 17)]
        rows.append(("-".join(picked) + " x1y\t_z", ["de", "en", None][i % 3], [None, "a", "b", "é", "b b"][i % 5 if i % 7 else 1]))
    return rows


@pytest.mark.parametrize("values", [None, 1, 3])
def test_equals_sql_whatever_the_digest(spark, values):
    """Digests of few values, where nearly all terms collide, change nothing."""
    rows = many_rows()
    options = {"digest": lambda t: F.pmod(F.xxhash64(t), F.lit(values))} if values else {}
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), **options).collect())
    assert got == by_sql(rows) and {r[2] for r in got} == {"pair", "term"}


def test_ties_at_the_last_rank_go_by_text(spark):
    names = [f"{a}{b}{c}" for a in "abcdefg" for b in "zyxwvut" for c in "klmnopq"]
    rows = [(" ".join(names), "en", "a")] * 3 + [("other words", "en", "b")] * 3
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect())
    assert got == by_sql(rows)
    assert [r[3] for r in got if r[2] == "term" and r[1] == "a"] == sorted(names)[: divergence.TOP]


def test_groups_without_terms_nulls_and_odd_texts(spark):
    rows = [
        (None, "en", "none"), ("", "en", "empty"), ("1 2 3", "en", "digits"), ("once", "en", "rare"), (None, None, None),
        ("", "", "a"), ("a A a", "en", "x"), ("a", "en", "x"), ("a", "en", "x"), ("word " * 5000, "en", "x"),
        ("a" * 100_000, "en", "y"), ("a" * 100_000, "en", "y"), ("A" * 100_000, "en", "y"),
    ]
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect())
    assert got == by_sql(rows)
    assert {(r[0], r[1], r[3], r[4]) for r in got if r[0] == ""} == {("", "", "a", 0), ("", "a", "", 0)}


def test_repeated_rows_and_empty_table(spark):
    rows = [("one two", "en", "a")] * 5 + [("two", "en", "b")] * 2
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect()) == by_sql(rows)
    assert divergence.audit(frame(spark, [])).collect() == []
    assert divergence.audit(frame(spark, rows[:1])).collect() == []


def test_only_digests_are_shuffled_while_counting(spark, tmp_path):
    """No exchange below the counts carries the strings of terms."""
    cells = "group long, term string, n long, docs long"
    spark.createDataFrame([(1, "w", 1, 1)], cells).write.parquet(str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells")).withColumn("digest", divergence.term_digest(F.col("term")))
    langs = spark.createDataFrame([(1, "en")], "group long, lang string")
    plan = divergence._counted(stored, langs, ["digest"], 1)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert below and not any("term" in line for line in below)


def test_counts_add_up_over_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 64)
    monkeypatch.setattr(divergence, "HELD_ROWS", 40)
    rows = many_rows()
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect()) == by_sql(rows)


def test_shares_are_exact(spark):
    big = 10**15
    rows = [(0, 1, 0), (big, 3 * big, 7), (big - 1, big, 1), (0, 0, 0), (2, 3, 0)]
    df = spark.createDataFrame(rows, "n long, total long, terms long")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + (10**9 * (n + 1) // (t + v) if t + v else 0) for n, t, v in rows]
