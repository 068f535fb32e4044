"""Documents to training tokens: language, boilerplate lines, near copies, mix, tokens."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, jaccard, langid, lines, mixing
from pagemill.llm.queries import vocabulary
from pagemill.sources.scratch import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Documents whose language has less than so many times the probability of a guess among the
# learned languages are rejected; with one to four of them, those below 0.4.
OVER_CHANCE, MOST_NEEDED = 1.6, 0.4
# A line on so many sites is boilerplate, a long one on so many.
CROSS_SITES, LONG_CROSS_SITES = 3, 2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no certain language.

    Where no document tells its language, none can be learned, and all documents stay. Null
    and empty texts have no letter. Null and repeated ids are rows like any other.
    """
    model = langid.fit(docs)
    if not model.languages:
        return docs.select(COLUMNS)
    known = langid.predict(docs.select(COLUMNS), model)
    least = min(MOST_NEEDED, OVER_CHANCE / len(model.languages))
    sure = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least)
    return known.where(sure).select(COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that stand on several sites, and documents that had nothing else.

    A document of null source is a site of its own. Repeats within one source are left
    to the join of near copies.
    """
    alone = F.concat(F.lit("\0"), F.coalesce(F.col("doc_id").cast("string"), F.sha2("text", 256)))
    site = F.coalesce(F.col("source"), alone)
    cleaned = lines.drop_spread_lines(docs, CROSS_SITES, LONG_CROSS_SITES, site)
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"\S")
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one of the smallest id. Null and
    empty texts and rows of null id are no copies of others; of equal rows one stays."""
    return jaccard.one_of_each(docs).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts documents so that the sources have their target weights. Null texts
    are not taken; a null source is one of its own; of equal rows one stands for all."""
    return mixing.take(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix; a null or empty text has none."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary(), parts=("ids",))
    return coded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mix", mix_sources),
    ("byte-level BPE", encode_tokens),
]

# SQL has no counterpart of the learned language model or of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
