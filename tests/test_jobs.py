import pytest
from pyspark.sql import functions as F

from pagemill.operators import neardup, topics
from pagemill.plans import jobs
from pagemill.plans.store import Store
from pagemill.registry import queries as registry
from pagemill.registry.standins import DAY, REST, StandIns
from pagemill.sources.tables import read_training

CUT = jobs.Cutting(script=r"\p{L}", mode="letters", partitions=4)


@pytest.fixture(scope="module")
def views(spark):
    return StandIns(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return Store(spark, str(tmp_path_factory.mktemp("store")))


@pytest.fixture(scope="module")
def models(views, store):
    taxonomy = views.taxonomy()
    counts = jobs.training_data(
        store, views.articles(), taxonomy, views.lexicon(), DAY, text="content", cutting=CUT
    )
    lines = read_training(store.spark, jobs.training_path(store, DAY))
    assert counts.selectExpr("sum(n)").first()[0] == lines.where("model = 'all'").count() > 0
    store.save_models(topics.fit_topics(lines))
    return store.load_models()


def test_near_duplicates(views, store):
    docs = views.documents()
    report = jobs.near_duplicates(store, docs, views.lexicon(), DAY, threshold=2, cutting=CUT)
    hashes = store.read("hash", DAY)
    clusters, members = neardup.near_dup_clusters(hashes)
    stored = store.read("distance_1_3", DAY)
    assert sorted(map(tuple, stored.select("fid", "hash", "samelen").collect())) == sorted(
        map(tuple, clusters.select("fid", "hash", "samelen").collect())
    )
    assert sorted(map(tuple, store.read("members", DAY).select("rep_fid", "fid").collect())) == sorted(
        map(tuple, members.collect())
    )
    assert report.count() == clusters.where("samelen >= 2").count() > 0


def test_page_topics(views, store, models):
    docs = views.documents()
    junk = store.spark.createDataFrame([("//src1.",)], "value string")
    hashes = views.hashes().join(views.junk_ids(), "fid", "left_semi").select("hash")
    report = jobs.page_topics(store, docs, None, hashes, junk, models, DAY, cutting=CUT)
    kept = store.read("discard", DAY)
    assert kept.count() == store.read("pcat", DAY).count() > 0
    assert kept.where("hash = -1").count() == 0
    children = store.read("ccat", DAY, where=F.col("cat_part") == "en")
    assert children.count() == store.read("pcat", DAY).where("cat = 'en'").count() > 0
    assert {"cat", "prob", "furl"} <= set(report.columns)


def test_user_topics(views, store, models):
    log, clicks = views.reader_log(), views.click_log()
    counts = jobs.user_topics(store, views.articles(), log, clicks, models, DAY, "view", cutting=CUT, rest=REST)
    fid_cat = store.read("fid_cat", DAY)
    reads = store.read("user_pv", DAY)
    wanted = reads.join(fid_cat, "fid").selectExpr("sum(sumcnt)").first()[0]
    clicked = clicks.where("category != ''").count()
    assert counts.selectExpr("sum(cnt)").first()[0] == wanted + clicked

    before = fid_cat.count()
    jobs.user_topics(store, views.articles(), log, clicks, models, DAY + 1, "view", editor_only=True, rest=REST)
    assert 0 < store.read("fid_cat", DAY + 1).count() < before
    assert store.read("fid_cat", DAY).count() == before


def test_the_query_of_user_topics_predicts_what_editors_left_out(spark, tmp_path):
    texts = ["goal ball team"] * 2 + ["vote law court"] * 2 + ["ball goal goal"]
    documents = [(i, t, "fr" if "law" in t else "es", "src1", len(t)) for i, t in enumerate(texts)]
    labels = [(i, i % 2, 0) for i in range(4)]
    events = [(10 * i, f"u{i}") for i in range(5)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(events, "event_id long, user_id string").selectExpr(
        "event_id", "timestamp '2024-01-01' AS ts", "user_id", "'view' AS event_type", "1D AS value", "'{}' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = {}
    for name in ("job_user_topics", "job_user_topics_full"):
        rows = registry.queries()[name](spark, str(tmp_path)).collect()
        found[name] = sorted((r.imei, r.pcat, r.ccat, r.cnt) for r in rows)
    assert {r[1] for r in found["job_user_topics"] if r[0] == "u4"} == {"es"}
    assert found["job_user_topics"] == found["job_user_topics_full"]
