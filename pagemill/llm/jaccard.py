"""Near copies among documents: Jaccard similarity of word five-grams.

Documents of equal word sequence form a class; classes are compared. MinHash bands
bring classes together, and Bayesian pruning goes through the MinHash values of a
pair in steps, dropping it once the posterior probability that its similarity reaches
the threshold falls below a tolerance. Pairs left tie classes into groups; within a
group all pairs are pruned the same way and the rest verified on exact sets.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from pagemill.llm import blocks, chars, shingles
from pagemill.llm.components import components
from pagemill.llm.names import unused
from pagemill.sources.scratch import materialize

SIMILARITY = 0.8
NGRAM = 5
# A pair of similarity 0.8 misses all 24 bands of 4 with a probability of 3e-6.
BANDS, BAND_ROWS = 24, 4
STEP = 16
TOLERANCE = 1e-6
SEED = 2

_SKETCH = "struct<k1:bigint,k2:bigint,words:bigint,sig:binary,bands:array<bigint>>"


def least_matches(threshold: float, tolerance: float, values: int) -> list[tuple[int, int]]:
    """(values compared, matches needed) after each step.

    With a uniform prior and m of n values equal, the posterior is Beta(m+1, n-m+1),
    and its mass at or above t is that of at most m successes in n+1 trials of
    probability t. Values are kept as single bytes, 1 in 256 of which agree by chance.
    """
    t = threshold + (1 - threshold) / 256
    steps = []
    for n in range(STEP, values + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def sketch_texts(texts: pa.Array, classes: np.ndarray, ngram: int, seed: int) -> pa.StructArray:
    words, bounds = shingles.word_hashes(texts, classes)
    hashes, runs = shingles.shingle_hashes(words, bounds, ngram)
    k1, k2 = shingles.sequence_keys(words, bounds)
    filled = np.flatnonzero(np.diff(runs))
    values = np.zeros((len(texts), BANDS * BAND_ROWS), np.uint32)
    rng = np.random.default_rng(seed)
    for k in range(values.shape[1]):
        a, b = rng.integers(1 << 63, size=2, dtype=np.uint64)
        if len(filled):
            permuted = ((hashes * (a | np.uint64(1)) + b) >> np.uint64(32)).astype(np.uint32)
            values[filled, k] = np.minimum.reduceat(permuted, runs[filled])
    sig = values.astype(np.uint8)
    bands = np.stack(
        [
            shingles.span_hashes(values[:, b * BAND_ROWS : (b + 1) * BAND_ROWS].reshape(-1),
                                 np.arange(len(texts)) * BAND_ROWS, np.arange(1, len(texts) + 1) * BAND_ROWS) + np.uint64(b)
            for b in range(BANDS)
        ],
        axis=1,
    ).view(np.int64)
    rows = np.arange(len(texts) + 1, dtype=np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(k1),
            pa.array(k2),
            pa.array(np.diff(bounds).astype(np.int64)),
            pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(rows * sig.shape[1]), pa.py_buffer(sig)]),
            pa.ListArray.from_arrays(pa.array(rows * BANDS), bands.reshape(-1)),
        ],
        names=["k1", "k2", "words", "sig", "bands"],
    )


def _sketch(spark, ngram: int, seed: int):
    shipped = spark.sparkContext.broadcast(chars.classes())

    @arrow_udf(_SKETCH)
    def run(texts: pa.Array) -> pa.Array:
        parts = [sketch_texts(part, shipped.value, ngram, seed) for part in chars.chunks(texts)]
        return pa.concat_arrays(parts)

    return run


def _shingle_sets(spark, ngram: int):
    shipped = spark.sparkContext.broadcast(chars.classes())

    @arrow_udf(BinaryType())
    def run(texts: pa.Array) -> pa.Array:
        """The distinct shingle hashes of each text, as bytes."""
        out = []
        for part in chars.chunks(texts):
            hashes, runs = shingles.shingle_hashes(*shingles.word_hashes(part, shipped.value), ngram)
            out += [np.unique(hashes[i:j]).tobytes() for i, j in zip(runs, runs[1:])]
        return pa.array(out, pa.binary())

    return run


def probable(sig: np.ndarray, steps: list[tuple[int, int]]) -> blocks.Linked:
    """Whether the pair's MinHash values leave it a chance to reach the threshold."""

    def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        left, matches = np.arange(len(i)), np.zeros(len(i), np.int64)
        for n, needed in steps:
            window = slice(n - STEP, n)
            matches = matches + (sig[i[left], window] == sig[j[left], window]).sum(axis=1)
            kept = matches >= needed
            left, matches = left[kept], matches[kept]
        out = np.zeros(len(i), bool)
        out[left] = True
        return out

    return linked


def similar(sets: list[bytes], threshold: float, likely: blocks.Linked) -> blocks.Linked:
    """Exact Jaccard similarity of the sets, for pairs that are likely to reach it."""
    sizes = np.array([len(s) // 8 for s in sets], np.int64)
    ids = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)[1]
    begin = np.append(0, np.cumsum(sizes))
    marked = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)

    def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        long_enough = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j])
        open_ = np.flatnonzero(long_enough)
        open_ = open_[likely(i[open_], j[open_])]
        for row in np.unique(i[open_]):
            at = open_[i[open_] == row]
            own = ids[begin[row] : begin[row + 1]]
            marked[own] = True
            common = np.array([np.count_nonzero(marked[ids[begin[c] : begin[c + 1]]]) for c in j[at]])
            marked[own] = False
            out[at] = common >= threshold * (sizes[row] + sizes[j[at]] - common)
        return out

    return linked


def near_documents(
    docs: DataFrame, threshold: float = SIMILARITY, ngram: int = NGRAM, tolerance: float = TOLERANCE, seed: int = SEED
) -> DataFrame:
    """(doc_id, class_id, n_links, kept) of every row of (doc_id, text).

    ``n_links`` counts the other rows whose set of word five-grams has a Jaccard
    similarity of at least ``threshold``; ``class_id`` is the smallest id reachable by
    links; ``kept`` marks one row of each class (of rows equal in id and text, all).
    Texts of one to four words have one shingle, the whole text. Texts of other characters
    only have no shingles; equal ones link. Null and empty texts, and rows without an id,
    link with nothing and are kept, named by their own id. Repeated rows are rows like
    any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    steps = least_matches(threshold, tolerance, BANDS * BAND_ROWS)
    text = chars.text_or_empty(F.col("text"))
    rows = docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sketched = rows.select("*", _sketch(spark, ngram, seed)(F.col("text")).alias("s"))
    # What is without a word is told apart by the text itself.
    plain = F.when((F.col("s.words") == 0) & (F.col("text") != ""), F.sha2("text", 256)).alias("plain")
    sketched = materialize(sketched.select("doc_id", "text_hash", plain, "s.*"))
    fit = (F.col("words") > 0) & F.col("doc_id").isNotNull()
    wordless = F.col("plain").isNotNull() & F.col("doc_id").isNotNull()
    first = F.min(F.struct("doc_id", "text_hash", "sig", "bands")).alias("f")
    grouped = sketched.where(fit).groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n"))
    classes = materialize(grouped.select(F.col("k1").alias("node"), "k1", "k2", "n", "f.*"))

    filed = classes.select("node", F.explode("bands").alias("key"))
    met = filed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = filed.join(met, "key").join(classes.select("node", "sig"), "node")
    dealt = blocks.blocked(members, "key", "node", F.col("size"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks.whole_groups(batches, "block"):
            block, nodes, part, mixed = blocks.flags(table, ["block", "node", "part", "mixed"])
            sig = blocks.fixed_rows(table.column("sig"), "u1", BANDS * BAND_ROWS)
            labels = blocks.tie(blocks.group_bounds(block), part, mixed, probable(sig, steps))
            moved = labels != np.arange(len(labels))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[labels[moved]])], ["a", "b"])

    maybe = dealt.select("block", "node", "part", "mixed", "sig").mapInArrow(meet, "a long, b long")
    groups = materialize(components(maybe))

    sized = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    likely = groups.join(sized, "component").join(classes.select("node", "n", "sig", "doc_id", "text_hash"), "node")
    texts = rows.where("doc_id IS NOT NULL")
    sets = likely.join(texts, ["doc_id", "text_hash"]).dropDuplicates(["node"]).select(
        "component", "size", "node", "n", "sig", _shingle_sets(spark, ngram)(F.col("text")).alias("set")
    )
    dealt = blocks.blocked(sets, "component", "node", F.col("size"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks.whole_groups(batches, "block"):
            block, nodes, part, mixed, n = blocks.flags(table, ["block", "node", "part", "mixed", "n"])
            sig = blocks.fixed_rows(table.column("sig"), "u1", BANDS * BAND_ROWS)
            linked = similar(table.column("set").to_pylist(), threshold, probable(sig, steps))
            sums, labels = blocks.count(blocks.group_bounds(block), part, mixed, n, linked)
            arrays = [pa.array(nodes), pa.array(sums), pa.array(nodes[labels])]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "links", "tied"])

    found = dealt.select("block", "node", "part", "mixed", "n", "sig", "set").mapInArrow(
        compare, "node long, links long, tied long"
    )
    found = materialize(found)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(found.select("node", "tied"))
    named = (
        classes.select("node", "k1", "k2", "n", "doc_id", "text_hash")
        .join(links, "node", "left")
        .join(tied, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    named = materialize(named)
    heads = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("head"))
    named = named.join(heads, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "head"
    )
    linked = sketched.where(fit).join(named, ["k1", "k2"]).select(
        "doc_id",
        "text_hash",
        F.col("head.doc_id").alias("class_id"),
        "n_links",
        (F.struct("doc_id", "text_hash") == F.col("head")).alias("kept"),
    )
    head = F.min(F.struct("doc_id", "text_hash")).alias("head")
    copies = sketched.where(wordless).groupBy("plain").agg((F.count(F.lit(1)) - 1).alias("n_links"), head)
    plain = sketched.where(wordless).join(copies, "plain").select(
        "doc_id",
        "text_hash",
        F.col("head.doc_id").alias("class_id"),
        "n_links",
        (F.struct("doc_id", "text_hash") == F.col("head")).alias("kept"),
    )
    alone = sketched.where(~fit & ~wordless).select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("kept")
    )
    return linked.unionByName(plain).unionByName(alone)


def one_of_each(docs: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` that ``near_documents`` keeps, all columns; of rows equal
    in id and text one."""
    key, other_id, other_key = unused(docs, "_text_hash", "_id", "_hash")
    keys = near_documents(docs, **options).where("kept").select(
        F.col("doc_id").alias(other_id), F.col("text_hash").alias(other_key)
    )
    hashed = docs.withColumn(key, F.xxhash64(chars.text_or_empty(F.col("text"))))
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    return hashed.join(keys.distinct(), same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
