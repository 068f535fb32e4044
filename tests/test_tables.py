import pytest
from pyspark.sql import functions as F

from pagemill.operators import neardup
from pagemill.schemas import SEG, conform
from pagemill.sources import scratch, tables


def test_day_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "x"), (2, "y")], "fid bigint, cat string")
    tables.write_day(one, path, 20240101)
    tables.write_day(one.limit(1), path, 20240102)
    tables.write_day(one.where("fid = 2"), path, 20240101)
    assert [tuple(r) for r in tables.read_day(spark, path, 20240101).collect()] == [(2, "y")]
    assert tables.read_day(spark, path, 20240102, ["fid"]).columns == ["fid"]


def test_a_day_without_rows_replaces_the_old_one(spark, tmp_path):
    rows = spark.createDataFrame([(1, "5"), (2, "y")], "fid bigint, words string")
    for by in (None, "words"):
        path = str(tmp_path / f"e{by}")
        tables.write_day(rows, path, 20240101, by)
        assert tables.read_day(spark, path, 20240101, schema=SEG).count() == 2
        tables.write_day(rows.where("fid > 5"), path, 20240101, by)
        assert tables.read_day(spark, path, 20240101, schema=SEG).count() == 0


@pytest.mark.parametrize("by", [None, "words"])
def test_a_write_that_fails_midway_leaves_the_day_as_it_was(spark, tmp_path, by):
    path = str(tmp_path / "w")
    tables.write_day(spark.createDataFrame([(1, "x"), (2, "y")], "fid bigint, words string"), path, 20240101, by)
    before = sorted(map(tuple, tables.read_day(spark, path, 20240101, ["fid", "words"] if not by else ["fid"]).collect()))
    failing = spark.range(100, numPartitions=4).selectExpr(
        "id AS fid", "IF(id = 99, raise_error('stopped'), concat('w', id % 3)) AS words"
    )
    with pytest.raises(Exception, match="stopped"):
        tables.write_day(failing, path, 20240101, by)
    again = tables.read_day(spark, path, 20240101, ["fid", "words"] if not by else ["fid"])
    assert sorted(map(tuple, again.collect())) == before
    assert tables.superseded(spark, path).collect() == []


def test_readers_see_one_version(spark, tmp_path):
    """Who read a day before it was replaced goes on reading what was there."""
    path = str(tmp_path / "v")
    for turn in range(3):
        tables.write_day(spark.range(10).selectExpr("id AS fid", f"'{turn}' AS words"), path, 20240101)
        if turn == 0:
            early = tables.read_day(spark, path, 20240101)
    assert {r.words for r in early.collect()} == {"0"} and early.count() == 10
    assert {r.words for r in tables.read_day(spark, path, 20240101).collect()} == {"2"}
    old = [r.folder for r in tables.superseded(spark, path).collect()]
    assert len(old) == 2 and all(spark.read.parquet(f).count() == 10 for f in old)
    assert tables.read_day(spark, path, 20240109).collect() == []


def test_days_in_plain_folders_are_read_too(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(4).selectExpr("id AS fid", "20240101 + id % 2 AS stat_date").write.partitionBy("stat_date").parquet(path)
    assert sorted(r.fid for r in tables.read_day(spark, path, 20240102).collect()) == [1, 3]


def test_single_categories_and_then_the_day_again(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "fid bigint, cat string")

    def fids():
        return sorted(r.fid for r in tables.read_day(spark, path, 20240101, ["fid"]).collect())

    tables.write_day(rows.selectExpr("fid + 10 AS fid", "cat").where("cat = 'a'"), path, 20240101, "cat", False)
    assert fids() == [11]
    tables.write_day(rows, path, 20240101, "cat")
    assert fids() == [1, 2, 3]
    tables.write_day(rows.selectExpr("fid + 20 AS fid", "cat").where("cat <> 'c'"), path, 20240101, "cat", False)
    assert fids() == [3, 21, 22]
    tables.write_day(rows.selectExpr("fid + 30 AS fid", "cat").where("cat = 'b'"), path, 20240101, "cat", False)
    assert fids() == [3, 21, 32] and tables.superseded(spark, path).count() == 1


def test_single_categories_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([(1, "5", "a"), (2, "y", "b")], "fid bigint, words string, cat string")
    tables.write_day(rows, path, 20240101, "cat")
    tables.write_day(rows.where("fid = 1").selectExpr("9L AS fid", "words", "cat"), path, 20240101, "cat", False)
    assert sorted(r.fid for r in tables.read_day(spark, path, 20240101, schema=SEG).collect()) == [2, 9]


def test_category_partitions_prune(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.range(50).selectExpr("id AS fid", "IF(id % 5 < 3, '体育', concat('c', id % 5)) AS cat")
    tables.write_day(rows, path, 20240101, by="cat")
    one = tables.read_day(spark, path, 20240101, ["fid"], F.col("cat_part") == "体育")
    assert one.count() == 30
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cat_part" in plan.split("PartitionFilters")[1].split("]")[0]


def test_lists(spark, tmp_path):
    (tmp_path / "l").write_text(" 7\n\n\t-3 \nx\n \n")
    path = str(tmp_path / "l")
    assert [r.value for r in tables.read_list(spark, path).collect()] == ["7", "-3", "x"]
    with pytest.raises(Exception, match="not a number in a list of ids: x"):
        tables.read_list(spark, path, as_long=True).collect()
    (tmp_path / "l").write_text(" 7\n\n\t-3 \n \n")
    spark.catalog.refreshByPath(path)
    assert [r.value for r in tables.read_list(spark, path, as_long=True).collect()] == [7, -3]


def test_training_text_round_trip(spark, tmp_path):
    lines = spark.createDataFrame([("all", "__label__a\tx y"), ("a", "__label__a_b\tz")], "model string, line string")
    path = str(tmp_path / "train")
    tables.write_training(lines, path)
    got = sorted(map(tuple, tables.read_training(spark, path).select("model", "label", "text").collect()))
    assert got == [("a", "a_b", "z"), ("all", "a", "x y")]


def test_export_and_keep_ids(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b", 5), (2, "c", 6)], "fid bigint, words string, hash bigint")
    ids = spark.createDataFrame([(2,), (9,)], "value bigint")
    tables.export_ids(rows, ids, str(tmp_path / "csv"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "csv")).collect()] == [("2", "c", "6")]
    assert neardup.keep_ids(rows, ids).count() == 1


def test_parallelism(spark):
    df = spark.range(0, 100, 1, 2).withColumnRenamed("id", "fid")
    assert tables.ensure_parallelism(df, 2).rdd.getNumPartitions() == 2
    assert tables.ensure_parallelism(df, 6, "fid").rdd.getNumPartitions() == 6
    assert tables.ensure_parallelism(df, 6).rdd.getNumPartitions() == 6


def test_partitions_of_equal_bytes(spark):
    """Long texts stand together, and a key rules out nothing: no partition has more than the mean and a text."""
    texts = [None, ""] + ["x" * (5_000 if 200 <= i < 260 else i % 7) for i in range(1_000)] + ["y" * 90_000]
    df = spark.createDataFrame(list(enumerate(texts)), "fid bigint, fid_bytes string").repartition(3)
    df = scratch.materialize(df)
    out = tables.balance_bytes(df, 8, F.octet_length("fid_bytes"))
    assert out.rdd.getNumPartitions() == 8 and out.columns == df.columns
    placed = out.select("fid", F.spark_partition_id().alias("part"), F.coalesce(F.octet_length("fid_bytes"), F.lit(0)).alias("n")).collect()
    assert sorted(r.fid for r in placed) == list(range(len(texts)))
    held = [sum(r.n for r in placed if r.part == p) for p in range(8)]
    mean = sum(held) / 8
    assert all(h <= mean + 90_000 for h in held) and sorted(held)[-2] <= mean + 5_000
    assert tables.balance_bytes(df.limit(0), 4, F.lit(1)).count() == 0


def test_schema_projection(spark):
    df = spark.createDataFrame([("1", "w", 0)], "fid string, words string, extra int")
    assert conform(df, SEG).schema.simpleString() == "struct<fid:bigint,words:string>"


def test_materialize_uses_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(root)
    df = scratch.materialize(spark.range(3))
    assert df.count() == 3 and root.split(":")[-1] in spark.sparkContext.getCheckpointDir()
