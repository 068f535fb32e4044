"""Documents to words: class filters, and the preparation step of each job."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType

from pagemill.constants import (
    ALL_MODEL,
    ARTICLE_BOILERPLATE,
    ARTICLE_RESOURCE,
    LABEL_PREFIX,
    MIN_TOKENS,
    NON_TOPIC_CLASSES,
)
from pagemill.functions.hashing import simhash
from pagemill.functions.text import (
    blank_if_null,
    decode_b64,
    has_class,
    join_words,
    keep_script,
    min_word_len,
    nonblank,
    nonblank_sql,
    site_of,
    untagged,
    untagged_html,
    words,
)
from pagemill.operators.joins import fits, keep_listed, sized
from pagemill.operators.taxonomy import (
    Taxonomy,
    allowed_label,
    map_category,
    parent_of,
    parents_with_children,
)
from pagemill.schemas import KEY, SEG, TRAIN, conform
from pagemill.sources.scratch import materialize


def word_classes(df: DataFrame, lexicon: DataFrame, col: str = "words", unknown: str = "n") -> DataFrame:
    """(fid, pos, word, cls) of every word. The lexicon has one class per word;
    ``unknown`` is the class of a word it lacks."""
    tokens = df.select("fid", F.posexplode(col).alias("pos", "word"))
    tagged = tokens.join(sized(lexicon.select("word", "cls")), "word", "left")
    return tagged.select("fid", "pos", "word", F.coalesce("cls", F.lit(unknown)).alias("cls"))


def drop_classes(
    df: DataFrame,
    lexicon: DataFrame,
    classes: str = NON_TOPIC_CLASSES,
    cols: Sequence[str] = ("words",),
    max_bytes: int | None = None,
) -> DataFrame:
    """Drop the words of array columns ``cols`` whose lexicon class is listed.

    Each row is filtered by itself, whatever its id. The listed words are looked up in
    a set that every worker holds; a list of more than ``max_bytes`` is joined with the
    words instead, under row numbers made for the purpose, and drops the same words.
    """
    listed = materialize(lexicon.where(has_class(F.col("cls"), classes)).select("word").distinct())
    if not fits(listed, max_bytes):
        return _drop_joined(df, listed, cols)
    shipped = df.sparkSession.sparkContext.broadcast(listed.toArrow()["word"].combine_chunks())

    @arrow_udf(ArrayType(StringType()))
    def kept(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        keep = pc.invert(pc.is_in(flat, value_set=shipped.value))
        before = np.append(0, np.cumsum(keep.to_numpy(zero_copy_only=False)))
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), flat.filter(keep))

    empty = F.array().cast("array<string>")
    return df.withColumns({c: F.when(F.col(c).isNotNull(), kept(F.coalesce(c, empty))) for c in cols})


def _drop_joined(df: DataFrame, listed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """As ``drop_classes``; the rows are numbered in storage, so a retry numbers alike."""
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    out, empty = numbered, F.array().cast("array<string>")
    for c in cols:
        kept = (
            numbered.select("_row", F.posexplode(c).alias("pos", "word"))
            .join(listed.hint("merge"), "word", "left_anti")
            .groupBy("_row")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "word")))["word"].alias("_kept"))
        )
        value = F.when(F.col(c).isNotNull(), F.coalesce("_kept", empty))
        out = out.join(kept, "_row", "left").withColumn(c, value).drop("_kept")
    return out.select(*df.columns)


def segment_pages(pages: DataFrame, script: str, mode: str = "letters") -> DataFrame:
    """(fid, words) of page contents, words as an array."""
    text = keep_script(F.col("fcontent"), script)
    return pages.select("fid", words(text, mode).alias("words"))


def prepare_pages(
    pages: DataFrame,
    script: str,
    mode: str = "letters",
    lexicon: DataFrame | None = None,
    classes: str = "w",
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """(fid, words, hash, furl, ftitle) of non-blank pages in one pass, no shuffle."""
    kept = pages.where(nonblank(F.col("fcontent")))
    cut = kept.withColumn("words", words(keep_script(F.col("fcontent"), script), mode))
    if lexicon is not None:
        cut = drop_classes(cut, lexicon, classes)
    return conform(
        cut.select(
            "fid",
            join_words(F.col("words")).alias("words"),
            simhash(F.col("words"), min_tokens).alias("hash"),
            site_of(F.col("furl")).alias("furl"),
            blank_if_null(F.col("ftitle")).alias("ftitle"),
        ),
        KEY,
    )


def prepare_articles(articles: DataFrame, reads: DataFrame, mode: str = "letters") -> DataFrame:
    """(fid, title_words, content_words) of the articles read that have no category."""
    unnamed = articles.where(~nonblank_sql(F.col("fcategory")))
    read = reads.select("fid").distinct()

    def cut(c: Column) -> Column:
        return join_words(words(untagged(c), mode))

    return keep_listed(unnamed, read, "fid").select(
        "fid",
        cut(F.col("ftitle")).alias("title_words"),
        cut(decode_b64(F.col("fcontent"))).alias("content_words"),
    )


def title_words(prepared: DataFrame) -> DataFrame:
    return conform(prepared.select("fid", F.col("title_words").alias("words")), SEG)


def content_words(prepared: DataFrame) -> DataFrame:
    return conform(prepared.select("fid", F.col("content_words").alias("words")), SEG)


def training_rows(
    articles: DataFrame,
    taxonomy: Taxonomy,
    lexicon: DataFrame,
    mode: str = "letters",
    boilerplate: tuple[str, ...] = ARTICLE_BOILERPLATE,
    min_len: int = 2,
) -> DataFrame:
    """(cat, title, content, resource_type) of articles with a category: the mapped
    category, and the topic words of title and body."""
    named = articles.where(nonblank_sql(F.col("fcategory"))).select(
        "fid",
        F.col("fcategory").alias("cat"),
        words(untagged_html(F.col("ftitle"), boilerplate), mode).alias("title"),
        words(untagged_html(decode_b64(F.col("fcontent")), boilerplate), mode).alias("content"),
        F.col("fresource_type").alias("resource_type"),
    )
    texts = ("title", "content")
    kept = drop_classes(named, lexicon, NON_TOPIC_CLASSES, texts)
    kept = kept.withColumns({c: join_words(min_word_len(F.col(c), min_len)) for c in texts})
    return conform(map_category(kept, taxonomy), TRAIN)


def labelled_rows(
    train: DataFrame, taxonomy: Taxonomy, text: str = "title", resource_type: int = ARTICLE_RESOURCE
) -> DataFrame:
    """(label, text) of the usable training rows."""
    usable = train.where(
        (F.col("resource_type") == resource_type)
        & nonblank_sql(F.col("cat"))
        & nonblank_sql(F.col(text))
    )
    return allowed_label(usable, taxonomy.labels).select("label", F.col(text).alias("text"))


def training_lines(labelled: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(model, line): each row for the overall model under its parent label, and a
    row with a child label once more, in full, for its parent's model."""
    parent = parent_of(F.col("label"))
    models = sized(parents_with_children(taxonomy.labels)).withColumnRenamed("model", "_own")

    def line(label: Column) -> Column:
        return F.concat(F.lit(LABEL_PREFIX), label, F.lit("\t"), F.col("text"))

    own = F.when(parent != F.col("label"), parent)
    copies = F.array_compact(
        F.array(
            F.struct(F.lit(ALL_MODEL).alias("model"), line(parent).alias("line")),
            F.when(
                F.col("_own").isNotNull(),
                F.struct(F.col("_own").alias("model"), line(F.col("label")).alias("line")),
            ),
        )
    )
    return labelled.join(models, own == F.col("_own"), "left").select(F.inline(copies))


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows per label, before the child part is cut off."""
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
