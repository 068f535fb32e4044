"""How the sources of a language differ in the terms that they use.

Terms travel as fixed-width digests. Texts are read once: each task stores its counts by
group and term. What counts terms shuffles their digests only. For digests that reach the result,
the smallest and the largest string are compared: where they differ, several terms
share the digest and are counted again apart. Strings are joined back to rows that
are kept.

Divergences are exact sums of integers. Of two sources, most kept terms occur in one or
none, where the other's share is that of a count of 0; such terms are summed by the
number of terms of a share. Only terms that occur in both are compared one by one.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm import chars, slices
from pagemill.operators.joins import fits, sized
from pagemill.sources.scratch import materialize, scratch_path

LEAST_DOCS = 3
TOP = 200
SHARE = 1_000_000_000
# Bytes of text counted together, rows of counts that a task adds up before it hands them
# on, rows of a batch, and pairs of numbers worked on at once.
CHUNK_BYTES = 1 << 22
HELD_ROWS = 2_000_000
BATCH_ROWS = 1 << 16
STEP = 1 << 18

_CELLS = "lang string, source string, term string, n bigint, docs bigint"


def term_bytes() -> np.ndarray:
    """Of each byte, the byte of a term that it stands for: A to Z as small letters, 0 if
    it parts terms."""
    table = np.arange(256, dtype=np.uint8)
    table[:0x80] = 0
    small = np.arange(ord("a"), ord("z") + 1)
    table[small] = small
    table[small - 32] = small
    return table


def _chunk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """(lang, source, term, occurrences, documents) of each part of a batch."""
    table = term_bytes()
    for batch in batches:
        at = 0
        for texts in chars.chunks(batch.column(2), CHUNK_BYTES):
            data, bounds = chars.raw(texts)
            lower = table[data]
            terms, starts = slices.cut(lower, lower > 0, slices.text_starts(len(data), bounds))
            coded = terms.dictionary_encode()
            names = [batch.column(i).slice(at, len(texts)).dictionary_encode() for i in (0, 1)]
            at += len(texts)
            if not len(terms):
                continue
            n_terms, n_sources = len(coded.dictionary), len(names[1].dictionary)
            in_doc = slices.owners(starts, bounds) * n_terms + coded.indices.to_numpy()
            in_doc, counts = np.unique(in_doc, return_counts=True)
            group = names[0].indices.to_numpy().astype(np.int64) * n_sources + names[1].indices.to_numpy()
            cells, cell = np.unique(group[in_doc // n_terms] * n_terms + in_doc % n_terms, return_inverse=True)
            group, term = np.divmod(cells, n_terms)
            columns = [
                names[0].dictionary.take(pa.array(group // n_sources)),
                names[1].dictionary.take(pa.array(group % n_sources)),
                coded.dictionary.take(pa.array(term)).cast(pa.string()),
                pa.array(np.bincount(cell, counts, len(cells)).astype(np.int64)),
                pa.array(np.bincount(cell, minlength=len(cells)).astype(np.int64)),
            ]
            yield pa.table(columns, ["lang", "source", "term", "n", "docs"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a task's parts, added up as far as ``HELD_ROWS`` rows allow."""

    def added() -> pa.Table:
        sums = pa.concat_tables(held).group_by(["lang", "source", "term"], use_threads=False)
        return sums.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(
            {"n_sum": "n", "docs_sum": "docs"}
        ).select(["lang", "source", "term", "n", "docs"])

    held: list[pa.Table] = []
    for counts in _chunk_counts(batches):
        held.append(counts)
        if sum(t.num_rows for t in held) > HELD_ROWS:
            held = [added()]
            if held[0].num_rows > HELD_ROWS // 2:
                yield from held.pop().to_batches(BATCH_ROWS)
    if held:
        yield from added().to_batches(BATCH_ROWS)


def term_digest(term: Column) -> Column:
    return F.xxhash64(term)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + terms)), exact; 1 where there is nothing to share."""
    among = F.nullif(total + terms, F.lit(0)).cast("decimal(20,0)")
    part = (n + 1).cast("decimal(20,0)") * F.lit(SHARE).cast("decimal(10,0)")
    return F.lit(1).cast("bigint") + F.coalesce(F.call_function("div", part, among), F.lit(0).cast("bigint"))


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shipped(stored: DataFrame, small: bool) -> DataFrame:
    """A stored table, broadcast if it is known to be small."""
    return F.broadcast(stored) if small else stored.hint("merge")


def numbered_groups(read: DataFrame) -> DataFrame:
    """(lang, source, group, seed) of every group that occurs, stored. ``group`` is a 64-bit hash,
    by the first seed that gives no two groups the same."""
    groups, seed = materialize(read.select("lang", "source").distinct()), 0
    while True:
        numbered = groups.withColumn("group", F.xxhash64(F.lit(seed), "lang", "source"))
        if numbered.groupBy("group").count().where("count > 1").isEmpty():
            return numbered.withColumn("seed", F.lit(seed))
        seed += 1


def _counted(cells: DataFrame, langs: DataFrame, key: list[str], least_docs: int) -> DataFrame:
    """(lang, digest, term, total, counts) of the terms in enough documents of a language."""
    by_group = cells.groupBy("group", *key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = F.collect_list(F.struct("group", "n")).alias("counts")
    terms = by_group.join(langs, "group").groupBy("lang", *key)
    terms = terms.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), counts)
    return terms.where(F.col("docs") >= least_docs)


def term_counts(
    docs: DataFrame, groups: DataFrame, least_docs: int, digest: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """(lang, digest, term, total, counts) of every kept term, ``counts`` listing (group, n), and
    the (digest, least, most) strings of the digests. ``term`` is empty but for terms that
    share their digest; ``total`` counts the language. Both come from storage."""
    spark = docs.sparkSession
    path = scratch_path(spark, "term-counts")
    seed = (groups.select("seed").head() or [0])[0]
    counted = docs.mapInArrow(_count_terms, _CELLS)
    counted.select(F.xxhash64(F.lit(seed), "lang", "source").alias("group"), "term", "n", "docs").write.parquet(path)
    # Digests take more room than the terms; each task makes them anew from its own strings.
    cells = spark.read.parquet(path).withColumn("digest", digest(F.col("term")))
    langs = _shipped(groups.select("group", "lang"), fits(groups))
    columns = ["lang", "digest", "term", "total", "counts"]
    terms = materialize(_counted(cells, langs, ["digest"], least_docs).withColumn("term", F.lit("")).select(columns))
    strings = cells.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    texts = materialize(strings.join(sized(terms.select("digest").distinct()), "digest", "left_semi"))
    shared = texts.where("least <> most").select("digest")
    shared = _shipped(shared, fits(shared))
    apart = _counted(cells.join(shared, "digest", "left_semi"), langs, ["digest", "term"], least_docs)
    apart = materialize(apart.select(columns))
    return terms.join(shared, "digest", "left_anti").select(columns).unionByName(apart), texts


def _pair_rows(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(values)], ["a", "b", "value"])


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of every two groups of a language as if no term occurred in both, from rows (group,
    zero, other, shares, others): what a count of 0 gives, the number of kept terms
    that do not occur in the group, the shares of those that do, and the groups."""
    for batch in batches:
        for row in range(batch.num_rows):
            group, zero, other = (batch.column(i)[row].as_py() for i in range(3))
            own, others = batch.column(3)[row].values, batch.column(4)[row].values
            p, n = own.field("p").to_numpy(), own.field("n").to_numpy()
            step = max(1, STEP // max(len(p), 1))
            for at in range(0, len(others), step):
                part = others.slice(at, step)
                ids, zeros = part.field("group").to_numpy(), part.field("zero").to_numpy()
                mine = (gap(p[:, None], zeros) * n[:, None]).sum(0) + other * gap(zero, zeros)
                theirs = ((gap(zeros[:, None], p) - gap(zeros, zero)[:, None]) * n).sum(1)
                me = np.full_like(ids, group)
                yield _pair_rows(np.append(me, ids), np.append(ids, me), np.append(mine, theirs))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every two groups, what their common terms change in the sum, from rows of the
    (group, p, zero) in which a term occurs; pairs of groups are summed up step by step."""
    for batch in batches:
        lists = batch.column(0)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.flatten()
        group, p, zero = (flat.field(c).to_numpy() for c in ("group", "p", "zero"))
        bounds = bounds - bounds[0]
        sizes = np.repeat(np.diff(bounds), np.diff(bounds))  # partners of each entry
        first = np.repeat(bounds[:-1], np.diff(bounds))
        ends = np.cumsum(sizes)
        at = 0
        while at < len(group):
            before = ends[at] - sizes[at]
            stop = max(at + 1, int(np.searchsorted(ends, before + STEP, side="right")))
            own = np.repeat(np.arange(at, stop), sizes[at:stop])
            partner = first[own] + np.arange(len(own)) - (ends[own] - sizes[own] - before)
            apart = own != partner
            own, partner = own[apart], partner[apart]
            change = gap(p[own], p[partner]) - gap(p[own], zero[partner])
            change += gap(zero[own], zero[partner]) - gap(zero[own], p[partner])
            order = np.lexsort((group[partner], group[own]))
            a, b = group[own][order], group[partner][order]
            heads = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
            if len(heads):
                yield _pair_rows(a[heads], b[heads], np.add.reduceat(change[order], heads))
            at = stop


_PAIRS = "a bigint, b bigint, value bigint"


def _pair_values(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, value) of every two groups of a language."""
    shares = rows.groupBy("group", "p").agg(F.count(F.lit(1)).alias("n"))
    shares = shares.groupBy("group").agg(F.collect_list(F.struct("p", "n")).alias("shares"), F.sum("n").alias("used"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("group", "zero")).alias("others"))
    none = F.array().cast("array<struct<p:bigint,n:bigint>>")
    whole = groups.join(shares, "group", "left").join(sized(others), "lang")
    whole = whole.select(
        "group", "zero", F.col("terms") - F.coalesce("used", F.lit(0)), F.coalesce("shares", none), "others"
    )
    common = rows.groupBy("lang", "digest", "term").agg(F.collect_list(F.struct("group", "p", "zero")).alias("l"))
    common = common.where(F.size("l") > 1).select("l")
    parts = whole.mapInArrow(_apart, _PAIRS).unionByName(common.mapInArrow(_together, _PAIRS))
    value = F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value")
    return parts.where("a <> b").groupBy("a", "b").agg(value)


def _top_terms(rows: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    """(group, item, value, rank) of each group's terms of highest value.

    The value that the last of them has is found on digests; terms of that value and above
    get their strings, which settle ties. Ranking keeps ``top`` rows of a group in each
    task before they meet.
    """
    p, q = F.col("p"), F.col("q")
    value = F.call_function("div", (p - q) * (p - q), q).alias("value")
    scored = materialize(rows.where(p > q).select("group", "digest", "term", value))
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.col("value").desc()))
    last = scored.select("group", "value").withColumn("rank", place).where(F.col("rank") <= top)
    last = last.groupBy("group").agg(F.min("value").alias("least_value"))
    kept = scored.join(sized(last), "group").where("value >= least_value").drop("least_value")
    item = F.when(F.col("term") != "", F.col("term")).otherwise(F.col("least"))
    named = kept.join(texts.select("digest", "least"), "digest").select("group", item.alias("item"), "value")
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.col("value").desc(), F.col("item")))
    return named.withColumn("rank", place).where(F.col("rank") <= top)


def audit(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    digest: Callable[[Column], Column] = term_digest,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source) of the documents.

    Part ``pair`` has every other source of the language with the divergence from it, part
    ``term`` the ``top`` terms that the group uses more than its language. Ranks run from 1 in
    each group and part, by value descending, then by the bytes of the item.

    A null text, lang or source is the empty string; malformed UTF-8 in a text is U+FFFD. A
    row is a document, whatever its id, so repeated rows count each time. A text without
    terms still makes its group occur; a language without kept terms has pairs of value
    0 and no terms. Further columns are not read. An empty table gives no rows.
    """
    empty = F.lit("")
    read = docs.select(
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
        F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        chars.text_or_empty(F.col("text")).alias("text"),
    )
    groups = numbered_groups(read)
    terms, texts = term_counts(read, groups, least_docs, digest)
    rows = terms.select("lang", "digest", "term", "total", F.inline("counts"))

    totals = rows.groupBy("group").agg(F.sum("n").alias("words"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_words"))
    zero = F.lit(0).cast("bigint")
    known = groups.drop("seed").join(sized(totals), "group", "left").join(sized(kept), "lang", "left")
    known = known.fillna(0, ["words", "terms", "lang_words"])
    known = materialize(known.withColumn("zero", share(zero, F.col("words"), F.col("terms"))))
    small = fits(known)
    rows = rows.join(_shipped(known.drop("lang", "source"), small), "group")
    rows = rows.withColumns({
        "p": share(F.col("n"), F.col("words"), F.col("terms")),
        "q": share(F.col("total"), F.col("lang_words"), F.col("terms")),
    })

    names = known.select("group", "lang", "source")
    others = names.select(F.col("group").alias("b"), F.col("source").alias("item"))
    pairs = _pair_values(rows, known).join(_shipped(others, small), "b")
    order = Window.partitionBy("a").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumnRenamed("a", "group")
    columns = ["group", "part", "item", "value", "rank"]
    both = pairs.withColumn("part", F.lit("pair")).select(columns)
    both = both.unionByName(_top_terms(rows, texts, top).withColumn("part", F.lit("term")).select(columns))
    return both.join(_shipped(names, small), "group").select("lang", "source", "part", "item", "value", "rank")
