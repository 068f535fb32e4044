"""Removing lines that stand on many sites.

HyperLogLog sketches count the distinct sites of each line hash and merge by
aggregation. Where the estimate comes near the threshold, the sites are counted
exactly before anything is removed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.chars import text_or_empty
from pagemill.llm.names import unused
from pagemill.operators.joins import join_listed
from pagemill.sources.scratch import materialize

# Sites that share a line by more than chance, whatever their number in the corpus.
SITES = 3
# A line of so many characters, blanks squeezed, is a passage that sites do not share by chance.
LONG_CHARS = 150
# Sketches have 2^12 registers, a standard error of 1.6 %. Estimates within this share
# of the threshold, and always within two, are counted exactly.
SKETCH_BITS = 12
NEAR = 0.1
SKETCH_PARTS = 8


def plain_line(line: Column) -> Column:
    """The line in lower case, blanks squeezed."""
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def line_hash(line: Column) -> Column:
    """Hash of a line in lower case, blanks squeezed; null for a blank line."""
    plain = plain_line(line)
    return F.when(plain != "", F.xxhash64(plain))


def split_lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def spread_lines(lines: DataFrame) -> DataFrame:
    """(hash) of the lines that stand on at least ``least`` distinct sites, from rows
    (hash, site, least). A line needs as many occurrences as sites, so only frequent ones
    get sketches: one for each of ``SKETCH_PARTS`` parts of its sites, made where its rows are as
    far as the list of frequent lines is small, and merged by line in the end."""
    often = lines.groupBy("hash").agg(F.count("site").alias("n"), F.min("least").alias("least"))
    often = often.where(F.col("n") >= F.col("least")).select("hash", "least")
    common = join_listed(lines.drop("least").where("site IS NOT NULL"), often, "hash")
    part = F.pmod(F.xxhash64("site"), F.lit(SKETCH_PARTS)).alias("part")
    parts = common.groupBy("hash", part).agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("least").alias("least"))
    sketched = materialize(
        parts.groupBy("hash").agg(
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.min("least").alias("least")
        )
    )
    off = F.abs(F.col("estimate") - F.col("least"))
    close = off <= F.greatest(F.lit(2.0), NEAR * F.col("least"))
    near = sketched.where(close).select("hash", "least")
    exact = join_listed(common.drop("least"), near, "hash").select("hash", "site", "least").distinct()
    exact = exact.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"))
    sure = sketched.where(~close & (F.col("estimate") > F.col("least"))).select("hash")
    return sure.unionByName(exact.where(F.col("n") >= F.col("least")).select("hash"))


def drop_spread_lines(
    docs: DataFrame, sites: int = SITES, long_sites: int | None = None, site: Column | None = None
) -> DataFrame:
    """``docs`` with the text less the lines that stand on ``sites`` sources or more,
    and n_lines, n_dropped; all columns stay. Lines of ``LONG_CHARS`` characters or more
    go from ``long_sites`` sources on, if given. ``site`` names the site of a document
    where that is not its source.

    The first place of a line, by id, then text hash and position, keeps it, so that
    no content is lost from the whole. Blank lines stay. A null source is no site, and a
    line that repeats within one source only stands on one site, however often; a null text
    stays null and has no lines; a null id comes last. Rows equal in id and text are treated
    alike. An empty table gives no rows.
    """
    key, other_id, other_key, out = unused(docs, "_key", "_id", "_k", "_gone")
    keyed = docs.withColumn(key, F.xxhash64(text_or_empty(F.col("text"))))
    site = F.col("source") if site is None else site
    least = F.lit(sites)
    if long_sites is not None:
        least = F.when(F.length(plain_line(F.col("line"))) >= LONG_CHARS, long_sites).otherwise(sites)
    lines = keyed.select("doc_id", F.col(key).alias("_key"), site.alias("site"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    hashed = lines.select("doc_id", "_key", "site", "pos", line_hash(F.col("line")).alias("hash"), least.alias("least"))
    lines = materialize(hashed.where("hash IS NOT NULL"))
    spread = spread_lines(lines.select("hash", "site", "least"))
    hits = join_listed(lines, spread, "hash").select("doc_id", "_key", "pos", "hash")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_key", "pos")
    first = hits.groupBy("hash").agg(F.min(place).alias("first"))
    gone = (
        join_listed(hits, first, "hash")
        .where(place != F.col("first"))
        .groupBy(F.col("doc_id").alias(other_id), F.col("_key").alias(other_key))
        .agg(F.collect_set("pos").alias(out))
    )
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    none = F.array().cast("array<int>")
    found = keyed.join(gone, same, "left").withColumn(out, F.coalesce(out, none))
    parts = split_lines(F.col("text"))
    kept = F.filter(parts, lambda line, i: ~F.array_contains(F.col(out), i))
    text = F.when(F.size(out) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("bigint")
    return found.withColumns(
        {"n_lines": n_lines, "n_dropped": F.size(out).cast("bigint"), "text": text}
    ).drop(key, other_id, other_key, out)
