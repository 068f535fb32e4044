"""Day-partitioned tables, list files and text exports."""

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pagemill.constants import LABEL_PREFIX
from pagemill.functions.text import trim_blanks
from pagemill.operators.joins import keep_listed

DAY = "stat_date"
CATEGORY_PART = "cat_part"
# What a write publishes: the version of a day, or of one of its categories, and its columns.
_COMMIT = f"{DAY} int, version string, category string, fields string"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    """What was published at ``path``, or None if nothing was written there by ``write_day``."""
    try:
        return spark.read.schema(_COMMIT).parquet(_commit_path(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commit_path(path: str) -> str:
    return f"{path.rstrip('/')}.commits"


def _published(
    spark: SparkSession, path: str, stat_date: int, schema: StructType | None
) -> tuple[DataFrame, list[str]] | None:
    """The day as last published, with its partition columns, and the names of the columns written;
    None where days are plain folders. A category that was replaced alone comes from its own
    version, the rest from that of the day."""
    commits = _commits(spark, path)
    if commits is None:
        return None
    last = commits.where(F.col(DAY) == stat_date).groupBy("category").agg(F.max(F.struct("version", "fields")).alias("v"))
    rows = {r.category: r.v for r in last.collect()}
    parts = [StructField(DAY, IntegerType()), StructField(CATEGORY_PART, StringType())]

    def columns(fields: str) -> list[StructField]:
        return [f for f in schema or StructType.fromJson(json.loads(fields)) if f.name != CATEGORY_PART]

    if not rows:
        written = commits.select("fields").first()[0]
        return spark.createDataFrame([], StructType([*columns(written), *parts])), _names(written)
    whole = rows.pop(None, None)
    newer = {c: v for c, v in rows.items() if whole is None or v.version > whole.version}

    def version(v: Row) -> DataFrame:
        root = f"{path.rstrip('/')}/version={v.version}"
        reader = spark.read.option("basePath", root).schema(StructType([*columns(v.fields), *parts]))
        return reader.parquet(f"{root}/{DAY}={stat_date}")

    found = []
    if whole is not None:
        day = version(whole)
        found.append(day.where(~F.coalesce(F.col(CATEGORY_PART).isin(*newer), F.lit(False))) if newer else day)
    for v in sorted(set(newer.values())):
        found.append(version(v).where(F.col(CATEGORY_PART).isin(*(c for c in newer if newer[c] == v))))
    return reduce(DataFrame.unionByName, found), _names((whole or next(iter(newer.values()))).fields)


def _names(fields: str) -> list[str]:
    return StructType.fromJson(json.loads(fields)).names


def read_day(
    spark: SparkSession,
    path: str,
    stat_date: int,
    cols: Sequence[str] | None = None,
    where: Column | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """One day of a table; the day prunes partitions, ``where`` is pushed down.

    A table that ``write_day`` made is read as last published. With a schema, a day stored
    without rows reads as empty, and the category partition stays text even if its
    values look like numbers.
    """
    published = _published(spark, path, stat_date, schema)
    if published is not None:
        day, written = published
        cols = cols or (schema.names if schema is not None else written)
        kept = day.where(F.col(DAY) == stat_date)
    else:
        reader = spark.read
        if schema is not None:
            parts = [StructField(DAY, IntegerType()), StructField(CATEGORY_PART, StringType())]
            reader = reader.schema(StructType([*schema.fields, *parts]))
            cols = cols or schema.names
        kept = reader.parquet(path).where(F.col(DAY) == stat_date)
    if where is not None:
        kept = kept.where(where)
    return kept.select(*cols) if cols else kept.drop(DAY)


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """An unpartitioned dimension."""
    table = spark.read.parquet(path)
    return table.select(*cols) if cols else table


def write_day(
    df: DataFrame, path: str, stat_date: int, by: str | None = None, whole_day: bool = True
) -> None:
    """Replace one day; without ``whole_day``, only the categories ``df`` holds.

    Rows go to a folder of a new version, which nobody reads before it is complete. Then one
    small file, put beside the table, publishes it. A write that fails leaves the day
    as it was, and whoever reads an older version goes on reading it; ``superseded``
    lists the folders that may be removed once they are done.

    With ``by``, rows are gathered per category before the write so that each
    task does not open a file in every category; rebalancing splits a category
    that is too big for one task.
    """
    spark = df.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/version={version}/{DAY}={stat_date}"
    categories, fields = [None], df.schema
    if by is None:
        df.write.parquet(folder)
    else:
        split = df.withColumn(CATEGORY_PART, F.col(by)).hint("rebalance", CATEGORY_PART)
        split.write.partitionBy(CATEGORY_PART).parquet(folder)
        fields = StructType([*df.schema, StructField(CATEGORY_PART, StringType())])
        if not whole_day:
            written = spark.read.schema(fields).parquet(folder).select(CATEGORY_PART).distinct()
            categories = [r[0] for r in written.collect()]
    commit = [(stat_date, version, c, fields.json()) for c in categories]
    spark.createDataFrame(commit, _COMMIT).coalesce(1).write.mode("append").parquet(_commit_path(path))


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(folder) of versions of which nothing is read any more."""
    commits = _commits(spark, path)
    if commits is None:
        return spark.createDataFrame([], "folder string")
    whole = commits.where("category IS NULL").groupBy(DAY).agg(F.max("version").alias("whole"))
    newest = commits.groupBy(DAY, "category").agg(F.max("version").alias("version"))
    current = newest.join(whole, DAY, "left").where("whole IS NULL OR version >= whole").select(DAY, "version")
    old = commits.select(DAY, "version").distinct().join(current, [DAY, "version"], "left_anti")
    root = f"{path.rstrip('/')}/version="
    return old.select(F.concat(F.lit(root), "version", F.lit(f"/{DAY}="), DAY).alias("folder"))


def clean_list(lines: DataFrame, as_long: bool = False) -> DataFrame:
    """One-column lines to trimmed, non-empty values in column ``value``. A list of
    numbers that holds anything else fails when it is read: it is not used in part."""
    value = trim_blanks(F.col(lines.columns[0]))
    kept = lines.select(value.alias("value")).where(F.length("value") > 0)
    if as_long:
        number = F.col("value").try_cast("bigint")
        wrong = F.raise_error(F.concat(F.lit("not a number in a list of ids: "), "value"))
        kept = kept.select(F.when(number.isNotNull(), number).otherwise(wrong.cast("bigint")).alias("value"))
    return kept


def read_list(spark: SparkSession, path: str, as_long: bool = False) -> DataFrame:
    return clean_list(spark.read.text(path), as_long)


def ensure_parallelism(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """At least ``n`` partitions before costly per-row work.

    Meant for scans of few large files; after a shuffle the adaptive planner
    sizes partitions itself.
    """
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, key) if key else df.repartition(n)


def balance_bytes(df: DataFrame, n: int, size: Column) -> DataFrame:
    """``df`` in ``n`` partitions of about equal ``size``, a number of bytes for each row.

    Running sums of the sizes, within each partition and over the partitions before, tell the range
    of bytes that a row begins in; that is its partition. None is larger than the mean plus
    its last row. Only one sum for each partition passes the driver; rows are shuffled
    once, whatever their keys. A null size counts as 0, and so does a negative one. Meant for
    scans and stored tables; where partitions come out otherwise when they are read again, rows
    stay whole and only the balance suffers.
    """
    longest = max(df.columns, key=len)
    bytes_, part = f"{longest}_bytes", f"{longest}_part"
    weighed = df.withColumn(bytes_, F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)))
    sums = weighed.groupBy(F.spark_partition_id()).agg(F.sum(bytes_)).collect()
    before, total = {}, 0
    for number, held in sorted(map(tuple, sums)):
        before[number] = total
        total += held

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            held = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(held)
            at = int(ends[-1]) if len(ends) else at
            parts = pa.array(np.clip((ends - held) * (n / max(total, 1)), 0, n - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], parts], names=[*batch.schema.names[:-1], part])

    placed = weighed.mapInArrow(place, StructType([*df.schema, StructField(part, IntegerType())]))
    return placed.repartitionById(n, F.col(part)).drop(part)


def write_training(lines: DataFrame, path: str) -> None:
    """Labelled text, one folder per model; a model too big for one task is split."""
    (
        lines.select("model", "line")
        .hint("rebalance", "model")
        .write.partitionBy("model")
        .mode("overwrite")
        .text(path)
    )


def read_training(spark: SparkSession, path: str) -> DataFrame:
    """Labelled text back as (model, label, text)."""
    return split_training(spark.read.text(path).withColumnRenamed("value", "line"))


def split_training(lines: DataFrame) -> DataFrame:
    """(model, line) to (model, label, text); the prefix is cut off the label."""
    parts = F.split("line", "\t", 2)
    return lines.select(
        "model",
        F.regexp_replace(F.get(parts, 0), f"^{LABEL_PREFIX}", "").alias("label"),
        F.get(parts, 1).alias("text"),
    )


def export_ids(df: DataFrame, ids: DataFrame, path: str) -> None:
    """Rows (fid, words, hash) whose fid is listed, as CSV."""
    rows = keep_listed(df.select("fid", "words", "hash"), ids.toDF("fid"), "fid")
    rows.write.mode("overwrite").csv(path)
