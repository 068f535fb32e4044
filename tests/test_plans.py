"""Shapes of physical plans that must hold whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

from pagemill.functions.hashing import signed64
from pagemill.operators import joins, neardup, textprep, topics, userstats
from pagemill.registry.standins import StandIns
from pagemill.sources.scratch import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views(spark):
    return StandIns(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


PYTHON = ("ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "BatchEvalPython")


def test_only_the_scanned_columns_are_read(views):
    text = plan(userstats.user_reads(views.reader_log(), "view"))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    assert "EqualTo(event_type,view)" in text
    assert shuffles(userstats.user_reads(views.reader_log(), "view")) == 1


def test_page_preparation_does_not_shuffle(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr(
        "page_id AS fid", "url AS furl", "url AS ftitle", "html AS fcontent"
    )
    assert "Exchange" not in plan(textprep.prepare_pages(pages, r"\p{L}"))


def test_exact_groups_combine_before_the_shuffle(spark):
    hashes = spark.range(10).selectExpr("id AS fid", "xxhash64(id) AS hash")
    text = plan(neardup.same_hash(hashes))
    assert text.count("HashAggregate") == 2 and text.count("Exchange hash") == 1


def test_a_filter_on_the_hash_does_not_hash_twice(views):
    text = plan(neardup.same_hash(views.hashes()))
    assert text.count("ArrowEvalPython") == 1 == text.count("regexp_extract_all(")


def test_sizes_of_lists_are_summed_up_in_tasks(spark):
    rows = spark.createDataFrame([(1, "ab", [1, 2], None), (None, None, None, 2.0)], "a long, b string, c array<int>, d double")
    assert joins.estimated_bytes(rows) == 2 * (joins.ROW_BYTES + 16) + 2 + len('{"c":[1,2]}') + len("{}")
    assert joins.estimated_bytes(rows.limit(0)) == 0


def test_near_pairs_of_one_full_key(spark):
    """65,536 hashes that agree in 48 bits: each meets its neighbours, not all others."""
    same = spark.range(1 << 16).selectExpr("id AS fid", "(id << 16) | 7 AS hash", "1L AS samelen")
    pairs = neardup.near_pairs(same, 1)
    assert pairs.count() == (1 << 16) * 16 // 2
    few = neardup.near_pairs(same.where("fid < 4096"), 2)
    assert few.groupBy("distance").count().orderBy("distance").collect() == [(1, 4096 * 6), (2, 4096 * 33)]


def test_no_pairing_by_nested_loop(spark):
    same = spark.range(10).selectExpr("id AS fid", "id AS hash", "1L AS samelen")
    junk = spark.range(5).selectExpr("id AS value")
    for df in (neardup.near_pairs(same), neardup.match_hashes(same, junk), neardup.drop_hashes(same, junk)):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def shuffled_rows(node):
    """Rows that a plan which has run wrote to its exchanges."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(node.plan())
    written = node.metrics().get("shuffleRecordsWritten")
    below = (node.children().apply(i) for i in range(node.children().size()))
    return (written.get().value() if written.isDefined() else 0) + sum(map(shuffled_rows, below))


def test_words_of_large_models_are_shuffled_once_a_block(spark):
    """Not once for each document that holds them."""
    vocabulary = [f"w{i}" for i in range(60)]
    lines = [("all", label, " ".join(vocabulary[i::2])) for i, label in enumerate("ab")]
    models = topics.fit_topics(spark.createDataFrame(lines, "model string, label string, text string"))
    large = topics.topic_models(models.weights, models.labels, max_bytes=0)
    n = 1000
    docs = spark.range(n).select(F.col("id").alias("fid"), F.lit(" ".join(vocabulary)).alias("words"))
    scored = topics.classify_parent(docs, large)
    assert len(scored.collect()) == n
    assert n <= shuffled_rows(scored._jdf.queryExecution().executedPlan()) < n * len(vocabulary) / 4


def test_documents_scored_twice_are_stored_once(spark, monkeypatch):
    lines = [("all", "a", "x y"), ("all", "b", "z")]
    models = topics.fit_topics(spark.createDataFrame(lines, "model string, label string, text string"))
    large = topics.topic_models(models.weights, models.labels, max_bytes=0)
    docs = spark.createDataFrame([(1, "x z"), (None, "z"), (1, None), (1, "x z")], "fid bigint, words string")
    numbered = topics.numbered(docs)
    stored = []
    monkeypatch.setattr(topics, "materialize", lambda df: stored.append(df.columns) or materialize(df))
    found = [topics.classify_parent(numbered, m) for m in (models, large)]
    assert not any("words" in columns for columns in stored)
    wanted = topics.classify_parent(docs, large)
    assert any("words" in columns for columns in stored)
    for df in found:
        assert df.columns == wanted.columns
        assert sorted(map(repr, df.collect())) == sorted(map(repr, wanted.collect()))


def test_scoring_with_small_models_does_not_shuffle(spark):
    lines = spark.createDataFrame([("all", "a", "x y"), ("all", "b", "z")], "model string, label string, text string")
    models = topics.fit_topics(lines)
    docs = spark.createDataFrame([(1, "x z")], "fid bigint, words string")
    text = plan(topics.classify_parent(docs, models))
    assert "Exchange" not in text and "Join" not in text
    large = topics.topic_models(models.weights, models.labels, max_bytes=0)
    text = plan(topics.classify_parent(docs, large))
    assert "SortAggregate" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("MapInArrow") == 1 and "ArrowEvalPython" not in text  # distinct words are stored


def test_few_but_huge_rows_are_merged(spark):
    rows = spark.range(40).selectExpr("id", "repeat('x', 2 * 1024 * 1024) AS title")
    assert not joins.fits(rows) and joins.fits(rows.select("id"))
    assert "strategy=merge" in joins.sized(rows)._jdf.queryExecution().analyzed().toString()


def test_a_short_cluster_list_leaves_the_texts_in_place(spark):
    pages = spark.range(50).selectExpr(
        "id AS fid", "'u' AS furl", "'t' AS ftitle", "'k' AS fkeywords", "repeat('x', 9) AS fcontent"
    )
    clusters = spark.range(5).selectExpr("id AS fid", "id AS hash", "3L AS samelen")
    topic = spark.range(9).selectExpr("id AS fid", "'c' AS cat", "0.5D AS prob")
    for df in (neardup.dup_report(clusters, pages, 2), neardup.dup_report(clusters, pages, 2, topic)):
        assert df.count() == 5 and not shuffles(df) and "BroadcastHashJoin" in plan(df)


def test_merge_round_shuffles_once_for_all_branches(spark):
    rows = spark.range(10).selectExpr("id AS fid", "xxhash64(id) AS hash", "1L AS samelen")
    df = neardup.merge_round(rows)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("+- Exchange") == 1 and final.count("ReusedExchange") == 2


def test_relational_operators_stay_in_the_jvm(views):
    article_reads = userstats.user_reads(views.reader_log(), "view")
    for df in (
        textprep.prepare_articles(views.articles(), article_reads),
        topics.pick_topic(views.spark.createDataFrame([(1, "a", 0.5)], "fid bigint, cat string, prob double")),
    ):
        assert not any(node in plan(df) for node in PYTHON)


@pytest.mark.parametrize("hot_rows", [1_000_000, 1_000])
def test_a_third_of_all_rows_under_one_hash(spark, monkeypatch, hot_rows):
    """Results stay whole when one hash is hot, looked up in place or shuffled."""
    monkeypatch.setattr(neardup, "HOT_ROWS", hot_rows)
    hot = signed64(0xFFFF000012345678)
    docs = spark.range(30_000).selectExpr(
        "id AS fid", f"CASE WHEN id % 3 = 0 THEN {hot}L ELSE xxhash64(id) END AS hash"
    )
    clusters, members = neardup.near_dup_clusters(docs)
    assert clusters.selectExpr("sum(samelen)").first()[0] == 30_000 == members.count()
    assert clusters.selectExpr("max(samelen)").first()[0] == 10_000
    assert members.groupBy("rep_fid").count().selectExpr("max(count)").first()[0] == 10_000
