"""What users read: counts per user and article, and per user and topic."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.constants import REST_SUFFIX, VIEW_EVENT
from pagemill.operators.taxonomy import split_topic
from pagemill.schemas import USER_PV, USER_TOPICS, conform


def user_reads(log: DataFrame, event: str = VIEW_EVENT) -> DataFrame:
    """Reads per user and article. Ids are compared as numbers, decimals cut to
    their whole part; one that is not a number becomes a null fid and finds no partner
    later."""
    wanted = log.where(
        (F.col("event_name") == event) & F.col("imei").isNotNull() & (F.col("article_id") != "")
    )
    fid = F.col("article_id").try_cast("decimal(38,18)").try_cast("bigint").alias("fid")
    return conform(wanted.groupBy("imei", fid).agg(F.sum("read_cnt").alias("sumcnt")), USER_PV)


def distinct_reads(reads: DataFrame) -> DataFrame:
    """Ids of the articles read."""
    return reads.select("fid").where("fid is not null").distinct()


def reads_with_topics(reads: DataFrame, topics: DataFrame) -> DataFrame:
    """(imei, cat, cnt) of reads whose article has a topic.

    A much-read article makes its fid hot on the side of the reads only; the
    adaptive skew join splits that side.
    """
    return reads.join(topics.select("fid", "cat"), "fid").select(
        "imei", "cat", F.col("sumcnt").alias("cnt")
    )


def clicks_with_topics(clicks: DataFrame) -> DataFrame:
    """(imei, cat, cnt) of clicks that carry a category."""
    return clicks.where(F.col("category") != "").select(
        "imei", F.col("category").alias("cat"), F.col("pv").alias("cnt")
    )


def topic_events(reads: DataFrame, topics: DataFrame, clicks: DataFrame) -> DataFrame:
    return reads_with_topics(reads, topics).unionByName(clicks_with_topics(clicks))


def user_topic_counts(
    reads: DataFrame, topics: DataFrame, clicks: DataFrame, rest: str = REST_SUFFIX
) -> DataFrame:
    """Reads and clicks per user, parent topic and child topic. Article topics are
    split before the join, once per article and not once per read."""

    def split(df: DataFrame, *others: str) -> DataFrame:
        return df.select(*others, F.inline(F.array(split_topic(F.col("cat"), rest))))

    read = reads.join(split(topics, "fid"), "fid").select(
        "imei", "pcat", "ccat", F.col("sumcnt").alias("cnt")
    )
    clicked = split(clicks_with_topics(clicks), "imei", "cnt")
    counts = (
        read.unionByName(clicked).groupBy("imei", "pcat", "ccat").agg(F.sum("cnt").alias("cnt"))
    )
    return conform(counts, USER_TOPICS)
