"""Lists of any size: Bloom filters, the three ways to join with a list, and the automaton."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.functions.automaton import automaton
from pagemill.functions.bloom import MOST_BITS, bloom_filter
from pagemill.operators import joins, neardup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most_bits", [MOST_BITS, 1 << 10])
def test_filters_never_miss_a_key(spark, most_bits):
    """Also one that has far more keys than its bits suit."""
    keys = spark.range(0, 30_000, 3).selectExpr("id", "concat('k', id) AS name")
    rows = spark.range(30_000).selectExpr("id", "concat('k', id) AS name")
    for columns in (["id"], ["id", "name"]):
        made = bloom_filter(keys.select(columns), most_bits)
        assert len(made.words) * 64 <= most_bits
        held = {r.id for r in rows.where(made.might_hold(rows, *columns)).select("id").collect()}
        assert held >= set(range(0, 30_000, 3))
        if most_bits == MOST_BITS:
            assert len(held) < 10_000 + 600


def test_filters_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id long")
    assert rows.where(bloom_filter(rows).might_hold(rows, "id")).collect() == [(1,)]
    assert rows.where(bloom_filter(rows.limit(0)).might_hold(rows, "id")).collect() == []


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_all_ways_to_join_a_list_agree(spark, how):
    df = spark.range(3000).selectExpr("nullif(id % 1000, 7) AS id", "id AS n", "concat('t', id) AS text")
    keys = spark.createDataFrame([(i,) for i in (None, 3, 3, 7, 500, 5000)], "id long").distinct()
    wanted = sorted(map(repr, df.join(keys, "id", how).select("n", "text").collect()))
    for max_bytes in (None, 0):
        joined = joins.join_listed(df, keys, "id", how, max_bytes)
        assert sorted(map(repr, joined.select("n", "text").collect())) == wanted
    short = joins.join_listed(df, keys.selectExpr("CAST(id AS INT) AS id"), "id", how, 0)
    assert sorted(map(repr, short.select("n", "text").collect())) == wanted


def test_a_long_list_moves_only_the_rows_that_may_be_listed(spark):
    pages = spark.range(20_000).selectExpr(
        "id AS fid", "'u' AS furl", "'t' AS ftitle", "'k' AS fkeywords", "repeat('x', 9) AS fcontent"
    )
    clusters = spark.range(0, 20_000, 200).selectExpr("id AS fid", "id AS hash", "3L AS samelen")
    report = neardup.dup_report(clusters, pages, 2, max_bytes=0)
    text = plan(report)
    before = text.index("ArrowEvalPython")
    assert text.rindex("Exchange hashpartitioning(fid", 0, before) > 0 and "SortMergeJoin" in text
    may = bloom_filter(clusters.select("fid"))
    assert report.count() == 100 and pages.where(may.might_hold(pages, "fid")).count() < 600


def test_automaton_equals_a_loop_over_the_list():
    rng = random.Random(4)
    for _ in range(40):
        listed = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 12))]
        texts = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 14))) for _ in range(60)]
        got = automaton(s.encode() for s in [*listed, ""]).contained(pa.array(texts))
        assert got.tolist() == [any(s in t for s in listed) for t in texts]


def test_automaton_of_many_strings():
    listed = [f"site{i * 7}.example" for i in range(100_000)]
    texts = [f"http://site{i}.example.org" for i in range(20_000)]
    got = automaton(s.encode() for s in listed).contained(pa.array(texts))
    assert got.tolist() == [i % 7 == 0 for i in range(20_000)]


def test_urls_are_dropped_in_one_pass_without_a_shuffle(spark):
    pages = spark.createDataFrame([(1, "http://a.b"), (2, None)], "fid long, furl string")
    listed = spark.createDataFrame([("a.b",), ("c",)], "value string")
    df = neardup.drop_urls(pages, listed)
    assert "Exchange" not in plan(df) and [r.fid for r in df.collect()] == [2]
    assert df.where(F.col("fid") == 1).count() == 0
