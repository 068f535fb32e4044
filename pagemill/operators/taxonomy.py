"""Free-form categories onto a fixed taxonomy, given as two small tables."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.constants import (
    CATEGORY_BREAK,
    CATEGORY_BREAKS,
    ALL_MODEL,
    CATEGORY_STANDARD,
    CATEGORY_VARIANT,
    REST_SUFFIX,
    UNKNOWN,
)
from pagemill.functions.text import trim_blanks
from pagemill.operators.joins import sized


@dataclass(frozen=True)
class Taxonomy:
    """``mapping``: kind (exact, parent, user), src, dst. ``labels``: label.

    Both carry the join hint that fits their size.
    """

    mapping: DataFrame
    labels: DataFrame


def lower_taxonomy(mapping: DataFrame, labels: DataFrame) -> Taxonomy:
    """Lower-case the entries, so that mapped values can match the allowed labels,
    and keep one row per source value, so that mapping never multiplies rows."""
    lower = mapping.select("kind", F.lower("src").alias("src"), F.lower("dst").alias("dst"))
    unique = lower.groupBy("kind", "src").agg(F.max("dst").alias("dst"))
    return Taxonomy(sized(unique), sized(labels.select(F.lower("label").alias("label")).distinct()))


def read_taxonomy(spark: SparkSession, mapping_path: str, labels_path: str) -> Taxonomy:
    """Taxonomy from tab-separated files: kind, src, dst and one label per line."""
    tsv = spark.read.option("sep", "\t")
    return lower_taxonomy(
        tsv.schema("kind string, src string, dst string").csv(mapping_path),
        tsv.schema("label string").csv(labels_path),
    )


def _standard(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(CATEGORY_VARIANT), F.lit(CATEGORY_STANDARD))


def normalize_cat(c: Column) -> Column:
    """Trim, lower, one spelling variant, separator runs to one comma."""
    return F.regexp_replace(_standard(trim_blanks(c)), CATEGORY_BREAKS, ",")


def map_category(df: DataFrame, taxonomy: Taxonomy, col: str = "cat") -> DataFrame:
    """Normalise ``col``, then map it once by whole value, by first part (replacing
    the whole value), and by whole value again."""

    def mapped(frame: DataFrame, kind: str, key: Column) -> DataFrame:
        lookup = taxonomy.mapping.where(F.col("kind") == kind).select(
            F.col("src").alias("_src"), F.col("dst").alias("_dst")
        )
        joined = frame.join(lookup, key == F.col("_src"), "left")
        return joined.withColumn(col, F.coalesce("_dst", col)).drop("_src", "_dst")

    out = df.withColumn(col, normalize_cat(F.col(col)))
    out = mapped(out, "exact", F.col(col))
    out = mapped(out, "parent", F.get(F.split(col, ","), F.lit(0)))
    return mapped(out, "user", F.col(col))


def allowed_label(
    df: DataFrame, labels: DataFrame, col: str = "cat", out: str = "label"
) -> DataFrame:
    """Fit ``col`` to the allowed labels (each listed once): itself, else its parent,
    else its child, else unknown."""
    parts = F.split(trim_blanks(F.col(col)), ",")
    two = F.contains(F.col(col), F.lit(","))
    def found(frame: DataFrame, key: Column, name: str) -> DataFrame:
        hit = labels.select(F.col("label").alias(name))
        return frame.join(hit, key == F.col(name), "left")

    joined = found(df, F.col(col), "_whole")
    joined = found(joined, F.when(two, F.get(parts, F.lit(0))), "_parent")
    joined = found(joined, F.when(two, F.get(parts, F.lit(1))), "_child")
    label = F.coalesce(F.replace("_whole", F.lit(","), F.lit("_")), "_parent", "_child", F.lit(UNKNOWN))
    return joined.withColumn(out, label).drop("_whole", "_parent", "_child")


def parents_with_children(labels: DataFrame) -> DataFrame:
    """Models to train: parents with more than two allowed entries, and the overall one."""
    parent = F.get(F.split("label", ","), F.lit(0)).alias("model")
    groups = labels.groupBy(parent).agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    overall = labels.sparkSession.range(1).select(F.lit(ALL_MODEL).alias("model"))
    return groups.select("model").unionByName(overall)


def parent_of(c: Column) -> Column:
    """Cut a label at its last ``_``, unless that is its first character."""
    return F.regexp_replace(c, r"(?s)^(.+)_[^_]*$", "$1")


def split_topic(c: Column, rest: str = REST_SUFFIX) -> Column:
    """(pcat, ccat) of a topic; without a child it is the parent plus ``rest``."""
    topic = F.regexp_replace(_standard(c), CATEGORY_BREAK, ",")
    parts = F.split(topic, ",")
    parent, child = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    of_rest = child.isNull() | (child == "other")
    return F.struct(
        parent.alias("pcat"),
        F.when(of_rest, F.concat(parent, F.lit(rest))).otherwise(child).alias("ccat"),
    )
