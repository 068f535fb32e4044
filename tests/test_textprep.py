import base64

import pytest

from pagemill.operators import textprep
from pagemill.operators.taxonomy import lower_taxonomy


def b64(text):
    return base64.b64encode(text.encode()).decode()


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [("the", "u"), ("and", "c"), ("goal", "n"), ("of", "p"), ("of", "n")]
    return spark.createDataFrame(rows, "word string, cls string")


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_drop_classes_shipped_and_joined_agree(spark, lexicon, max_bytes):
    rows = [(1, ["b", "the", "a", "and", "b"]), (2, ["the"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "fid bigint, words array<string>")
    kept = textprep.drop_classes(df, lexicon, max_bytes=max_bytes)
    assert {r.fid: r.words for r in kept.collect()} == {1: ["b", "a", "b"], 2: [], 3: [], 4: None}


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_drop_classes_keeps_rows_of_null_and_repeated_ids_apart(spark, lexicon, max_bytes):
    rows = [(1, ["the", "cat"], ["x"]), (1, ["a", "dog"], []), (None, ["x", None, "the"], ["the"]), (None, ["y"], None)]
    df = spark.createDataFrame(rows, "fid bigint, title array<string>, body array<string>")
    kept = textprep.drop_classes(df, lexicon, cols=("title", "body"), max_bytes=max_bytes)
    got = sorted((r.fid or 0, r.title, r.body) for r in kept.collect())
    assert [g[0] for g in got] == [0, 0, 1, 1] and kept.columns == df.columns
    assert [g[1] for g in got][1:] == [["y"], ["a", "dog"], ["cat"]] and got[0][2] == []
    assert got[0][1] == ["x", None]


def test_word_classes(spark, lexicon):
    df = spark.createDataFrame([(1, ["goal", "x", "the"])], "fid bigint, words array<string>")
    got = textprep.word_classes(df, lexicon.where("word != 'of'")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "goal", "n"), (1, 1, "x", "n"), (1, 2, "the", "u")]


def test_prepare_pages(spark):
    rows = [
        (1, "http://h/x", None, "新闻联播1天气预报abc好"),
        (2, None, "t", "\n \t"),
        (3, "", "t", None),
        (4, "u", "t", "短文"),
    ]
    pages = spark.createDataFrame(rows, "fid bigint, furl string, ftitle string, fcontent string")
    got = {r.fid: r for r in textprep.prepare_pages(pages, "一-鿋", "han").collect()}
    assert set(got) == {1, 4}
    assert got[1].words == "新闻 闻联 联播 天气 气预 预报 好" and got[1].furl == "http://h" and got[1].ftitle == ""
    assert got[1].hash != -1 and got[4].hash == -1


def test_prepare_articles_takes_read_ones_without_category(spark):
    rows = [
        (1, "T <b>x</b>", b64("c\nd<br>e"), None),
        (2, "t", b64("c"), "a b"),
        (3, None, None, " "),
        (4, "t", b64("c"), None),
    ]
    articles = spark.createDataFrame(rows, "fid bigint, ftitle string, fcontent string, fcategory string")
    reads = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "fid bigint")
    prepared = textprep.prepare_articles(articles, reads)
    assert sorted(map(tuple, prepared.collect())) == [(1, "t x", "c d e"), (3, "", "")]
    assert sorted(map(tuple, textprep.content_words(prepared).collect())) == [(1, "c d e"), (3, "")]
    assert sorted(map(tuple, textprep.title_words(prepared).collect())) == [(1, "t x"), (3, "")]


def test_training_rows_lines_and_counts(spark, lexicon):
    taxonomy = lower_taxonomy(
        spark.createDataFrame([("exact", "sport,soccer", "sport,foot")], "kind string, src string, dst string"),
        spark.createDataFrame([("sport",), ("sport,foot",), ("sport,golf",), ("news",), ("news,tv",)], "label string"),
    )
    rows = [
        (1, "The goal <i>of</i> a team", b64("x"), "Sport Soccer", 2),
        (2, "Vote results", b64("x"), "news tv", 2),
        (3, "Clip title", b64("x"), "sport", 1),
        (4, "the", b64("x"), "sport", 2),
        (5, "Some thing", b64("x"), "else", 2),
        (6, "Any thing", b64("x"), None, 2),
    ]
    articles = spark.createDataFrame(
        rows, "fid bigint, ftitle string, fcontent string, fcategory string, fresource_type bigint"
    )
    train = textprep.training_rows(articles, taxonomy, lexicon)
    assert sorted(map(tuple, train.collect())) == [
        ("else", "some thing", "", 2), ("news,tv", "vote results", "", 2), ("sport", "", "", 2),
        ("sport", "clip title", "", 1), ("sport,foot", "goal team", "", 2),
    ]
    labelled = textprep.labelled_rows(train, taxonomy)
    lines = textprep.training_lines(labelled, taxonomy)
    assert sorted(map(tuple, lines.collect())) == [
        ("all", "__label__news\tvote results"),
        ("all", "__label__sport\tgoal team"),
        ("all", "__label__unknow\tsome thing"),
        ("sport", "__label__sport_foot\tgoal team"),
    ]
    assert sorted(map(tuple, textprep.label_counts(labelled).collect())) == [
        ("news_tv", 1), ("sport_foot", 1), ("unknow", 1),
    ]
