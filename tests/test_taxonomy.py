import pytest

from pagemill.operators import taxonomy


@pytest.fixture(scope="module")
def rules(spark):
    mapping = [
        ("exact", "游戏,网页游戏", "游戏,PC游戏"),
        ("exact", "萌宠", "宠物"),
        ("parent", "国际", "时政,国际"),
        ("user", "科学,军事", "军事,资讯"),
        ("user", "军事,资讯", "军事,中国军情"),
        ("user", "宠物", "动物"),
    ]
    labels = ["游戏", "游戏,PC游戏", "游戏,手游", "军事", "军事,中国军情", "时政", "时政,国际", "宠物", "手游"]
    return taxonomy.lower_taxonomy(
        spark.createDataFrame(mapping, "kind string, src string, dst string"),
        spark.createDataFrame([(x,) for x in labels], "label string"),
    )


def test_normalize_collapses_separators(column):
    values = [" A _b ", "a__b", "\ta-b_c\n", "其它", None, "OTHER"]
    assert column(taxonomy.normalize_cat, values) == ["a,b", "a,b", "a,b,c", "其他", None, "other"]


def test_map_category(spark, rules):
    raw = ["国际 社会", "科学 军事", "游戏_网页游戏", "萌宠", "军事-资讯", "x", None, ","]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, cat string")
    got = [r.cat for r in taxonomy.map_category(df, rules).orderBy("i").collect()]
    # Each map is applied once: a mapped value is not looked up in the same map again.
    assert got == ["时政,国际", "军事,资讯", "游戏,pc游戏", "动物", "军事,中国军情", "x", None, ","]


def test_allowed_label(spark, rules):
    cats = ["游戏,pc游戏", "游戏,端游", "体育,手游", "体育,足球", "宠物", "x", "a,", None]
    df = spark.createDataFrame(list(enumerate(cats)), "i int, cat string")
    got = [r.label for r in taxonomy.allowed_label(df, rules.labels).orderBy("i").collect()]
    # The label set is lower-cased, so mixed-case entries of the taxonomy still match.
    assert got == ["游戏_pc游戏", "游戏", "手游", "unknow", "宠物", "unknow", "unknow", "unknow"]


def test_parents_with_children(rules):
    assert sorted(r.model for r in taxonomy.parents_with_children(rules.labels).collect()) == ["all", "游戏"]


def test_parent_of(column):
    assert column(taxonomy.parent_of, ["a_b", "a_b_c", "a", "_a", "__a", "a_", None]) == [
        "a", "a_b", "a", "_a", "_", "a", None,
    ]


def test_split_topic_keeps_empty_parts(column):
    values = ["A b", "a", "a_other", "a__b", "a,", "其它-x", None]
    got = column(lambda c: taxonomy.split_topic(c, "+"), values)
    assert [tuple(r) for r in got] == [
        ("a", "b"), ("a", "a+"), ("a", "a+"), ("a", ""), ("a", ""), ("其他", "x"), (None, None),
    ]


def test_read_taxonomy(spark, tmp_path):
    (tmp_path / "map.tsv").write_text("exact\tA\tB,C\nuser\tb\tc\n")
    (tmp_path / "labels.txt").write_text("B,C\nx\n")
    rules = taxonomy.read_taxonomy(spark, str(tmp_path / "map.tsv"), str(tmp_path / "labels.txt"))
    assert sorted(map(tuple, rules.mapping.collect())) == [("exact", "a", "b,c"), ("user", "b", "c")]
    assert sorted(r.label for r in rules.labels.collect()) == ["b,c", "x"]
