from pagemill.operators import userstats

LOG = [
    ("u", "7", 1, "view_article"), ("u", "07", 2, "view_article"), ("u", "abc", 4, "view_article"),
    ("u", "", 8, "view_article"), ("u", None, 16, "view_article"), (None, "7", 32, "view_article"),
    ("u", "7", 64, "other"), ("v", "7", 1, "view_article"),
]


def reads(spark):
    return userstats.user_reads(
        spark.createDataFrame(LOG, "imei string, article_id string, read_cnt bigint, event_name string")
    )


def test_user_reads_join_equal_numbers(spark):
    got = sorted(((r.imei, r.fid, r.sumcnt) for r in reads(spark).collect()), key=str)
    assert got == [("u", 7, 3), ("u", None, 4), ("v", 7, 1)]
    assert [r.fid for r in userstats.distinct_reads(reads(spark)).collect()] == [7]


def test_user_topic_counts(spark):
    topics = spark.createDataFrame([(7, "Sport golf"), (7, "news"), (8, "x")], "fid bigint, cat string")
    clicks = spark.createDataFrame(
        [("u", "sport_golf", 5), ("u", "", 9), ("u", None, 9), ("v", "news-other", 1)],
        "imei string, category string, pv bigint",
    )
    got = userstats.user_topic_counts(reads(spark), topics, clicks, "+").collect()
    assert sorted(map(tuple, got)) == [
        ("u", "news", "news+", 3), ("u", "sport", "golf", 8),
        ("v", "news", "news+", 2), ("v", "sport", "golf", 1),
    ]
