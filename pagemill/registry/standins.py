"""The shared test tables in the shapes the jobs read (see FIXTURES.md)."""

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import words
from pagemill.operators.neardup import hash_documents
from pagemill.operators.taxonomy import Taxonomy, lower_taxonomy
from pagemill.sources.tables import ensure_parallelism

DAY = 20240101
REST = "_rest"

LEXICON = [
    ("the", "u"), ("of", "p"), ("and", "c"), ("to", "p"), ("in", "p"), ("is", "vshi"),
    ("it", "rr"), ("that", "rz"), ("de", "p"), ("la", "u"), ("le", "u"), ("les", "u"),
    ("et", "c"), ("der", "u"), ("die", "u"), ("und", "c"), ("el", "u"), ("que", "c"),
    ("token", "n"), ("e", "x"), ("a", "x"),
]
MAPPING = [
    ("exact", "en,good", "en,fine"),
    ("parent", "fr", "Romance,French"),
    ("user", "de,bad", "de"),
]
LABELS = [
    "en", "fr", "de", "es", "en,fine", "en,bad", "es,good", "es,bad", "romance,french", "de,good",
]
JUNK_URLS = ["example.net", "//m."]


class StandIns:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def texts(self, name: str, key: str) -> DataFrame:
        """A table whose texts are about to be cut, spread over all cores."""
        return ensure_parallelism(self.table(name), self.spark.sparkContext.defaultParallelism, key)

    def inline(self, **columns: list[str]) -> DataFrame:
        return self.spark.createDataFrame(pa.table(columns))

    def documents(self) -> DataFrame:
        """Documents as crawled pages: fid, furl, ftitle, fkeywords, fcontent, lang."""
        site = F.concat(F.lit("http://"), "source", F.lit(".example.org/"), "lang", F.lit("/"), "doc_id")
        return self.texts("documents", "doc_id").select(
            F.col("doc_id").alias("fid"),
            site.alias("furl"),
            F.substring_index("text", "\n", 1).alias("ftitle"),
            F.nullif("source", F.lit("src0")).alias("fkeywords"),
            F.col("text").alias("fcontent"),
            "lang",
        )

    def word_lists(self) -> DataFrame:
        """fid and the words of each document as an array."""
        return self.documents().select("fid", words(F.col("fcontent")).alias("words"))

    def hashes(self) -> DataFrame:
        return hash_documents(self.word_lists())

    def pages(self) -> DataFrame:
        html = F.col("html")
        return self.texts("pages", "page_id").select(
            F.col("page_id").alias("fid"),
            F.col("url").alias("furl"),
            F.regexp_extract(html, "<title>(.*?)</title>", 1).alias("ftitle"),
            F.nullif(F.regexp_extract(html, '<a href="/([^"]*)"', 1), F.lit("The")).alias("fkeywords"),
            html.alias("fcontent"),
        )

    def articles(self) -> DataFrame:
        docs, labels = self.texts("documents", "doc_id"), self.table("labels")
        grade = F.when(F.col("quality") == 1, "good").otherwise("bad")
        return docs.join(labels, "doc_id", "left").select(
            F.col("doc_id").alias("fid"),
            F.substring_index("text", "\n", 1).alias("ftitle"),
            F.base64(F.encode("text", "utf-8")).alias("fcontent"),
            F.when(F.col("quality").isNotNull(), F.concat_ws("_", "lang", grade)).alias("fcategory"),
            F.when(F.col("toxic") == 1, 1).otherwise(2).cast("bigint").alias("fresource_type"),
        )

    def reader_log(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").cast("string").alias("imei"),
            # Ten events stand for each document, so that every document is read.
            F.floor(F.col("event_id") / 10).cast("string").alias("article_id"),
            F.lit(1).cast("bigint").alias("read_cnt"),
            F.col("event_type").alias("event_name"),
            F.date_format("ts", "yyyyMMdd").cast("int").alias("stat_date"),
        )

    def click_log(self) -> DataFrame:
        value = F.col("value")
        category = (
            F.when(value < 5, "en good").when(value < 10, "FR-bad").when(value < 15, "de_other")
            .when(value < 20, "es").when(value < 40, "")
        )
        return self.table("events").where("event_type = 'click'").select(
            F.col("user_id").cast("string").alias("imei"),
            category.alias("category"),
            F.lit(1).cast("bigint").alias("pv"),
        )

    def lexicon(self) -> DataFrame:
        word, cls = map(list, zip(*LEXICON))
        return self.inline(word=word, cls=cls)

    @cache
    def taxonomy(self) -> Taxonomy:
        kind, src, dst = map(list, zip(*MAPPING))
        return lower_taxonomy(self.inline(kind=kind, src=src, dst=dst), self.inline(label=LABELS))

    def junk_urls(self) -> DataFrame:
        return self.inline(value=JUNK_URLS)

    def junk_ids(self) -> DataFrame:
        """Documents known to be toxic."""
        return self.table("labels").where("toxic = 1").select(F.col("doc_id").alias("fid"))

    def junk_titles(self) -> DataFrame:
        """Titles several pages share."""
        shared = self.pages().groupBy("ftitle").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
        return shared.select(F.col("ftitle").alias("value"))
