"""Exact and near copies: grouping by fingerprint, merging, discarding, reporting.

Hashes are unique once ``same_hash`` has run. Rows that share a 48-bit block key
then differ in one 16-bit block only, so a block group never exceeds 65,536 rows
however large or skewed the input is. For k > 1 a merge round does not see pairs whose
differing bits fall into several blocks; that is how the merge is defined. ``near_pairs``
lists all pairs.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from pagemill.constants import MEMBER_PART, NEAR_BITS, SHORT_HASH
from pagemill.functions.hashing import (
    BLOCK_BITS,
    BLOCKS,
    ball,
    block_key,
    block_shift,
    signed64,
    simhash,
    within,
)
from pagemill.functions.automaton import Automaton, automaton
from pagemill.functions.nearby import NearIndex
from pagemill.functions.text import site_of, squash
from pagemill.operators.joins import drop_listed, estimated_bytes, join_listed, keep_listed, sized
from pagemill.operators.ordering import ranked
from pagemill.schemas import DISTANCE, MEMBERS, SAME, conform
from pagemill.sources.scratch import materialize

# Block groups up to this size are merged by an expression, larger ones by numpy.
FOLD_ROWS = 64
# Estimated bytes of the neighbours of listed hashes up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
# Estimated bytes of listed substrings in one automaton, which takes about ten times as much.
LISTED_BYTES = 16 << 20
# Listed hashes in one index of those within 3 bits or more, and most bits.
INDEXED_HASHES = 1 << 21
MOST_BITS = 7
# Documents of one hash from which on it is looked up in place.
HOT_ROWS = 1_000_000


def hash_documents(df: DataFrame, words: str = "words", min_tokens: int = 5) -> DataFrame:
    """(fid, hash) of documents whose words are an array column."""
    return df.select("fid", simhash(F.col(words), min_tokens).alias("hash"))


def same_hash(hashes: DataFrame) -> DataFrame:
    """One row per hash: smallest fid and number of documents. Documents too short to
    fingerprint are no copies of one another and have no row."""
    groups = drop_short(hashes).groupBy("hash").agg(F.min("fid").alias("fid"), F.count("fid").alias("samelen"))
    return conform(groups, SAME)


def _attach_reps(hashes: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep_fid, fid) of every document, from (hash, rep_fid, samelen) of every hash.

    A hash shared by very many documents would send them all to one task. Such
    hashes are few, at most one per ``HOT_ROWS`` documents, so they are looked up
    where the documents are; only the others are shuffled.
    """
    hot = F.col("samelen") >= HOT_ROWS
    lookup = sized(reps.where(hot).select("hash", F.col("rep_fid").alias("hot_fid")))
    looked_up = hashes.join(lookup, "hash", "left")
    found = looked_up.where("hot_fid IS NOT NULL").select(F.col("hot_fid").alias("rep_fid"), "fid")
    others = looked_up.where("hot_fid IS NULL").select("hash", "fid")
    spread = others.join(reps.where(~hot), "hash").select("rep_fid", "fid")
    return conform(found.unionByName(spread), MEMBERS)


def same_members(hashes: DataFrame, same: DataFrame) -> DataFrame:
    """(rep_fid, fid) of every document, by exact hash; ``same`` is best stored. A
    document too short to fingerprint stands for itself."""
    reps = same.withColumnRenamed("fid", "rep_fid")
    return _attach_reps(drop_short(hashes), reps).unionByName(_alone(hashes))


def _alone(hashes: DataFrame) -> DataFrame:
    short = hashes.where(F.col("hash").eqNullSafe(F.lit(SHORT_HASH)))
    return conform(short.select(F.col("fid").alias("rep_fid"), "fid"), MEMBERS)


def block_keys(hashes: DataFrame) -> DataFrame:
    """Each row once per block, with the block's key."""
    h = F.col("hash")
    keys = F.array(
        *(F.struct(F.lit(b).alias("block"), block_key(h, b).alias("key")) for b in range(BLOCKS))
    )
    return hashes.select("*", F.inline(keys))


def _flip_masks(k: int) -> list[int]:
    """Every non-zero 16-bit pattern of at most ``k`` bits."""
    sizes = range(1, min(k, BLOCK_BITS) + 1)
    return sorted(sum(1 << i for i in bits) for n in sizes for bits in combinations(range(BLOCK_BITS), n))


def _kept_blocks(k: int) -> list[int]:
    """Masks that keep three of k + 3 blocks of the hash. Bits that differ in k places
    leave three blocks at least untouched, so every near pair agrees under some mask."""
    edges = [64 * i // (k + 3) for i in range(k + 4)]
    blocks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [signed64(sum(kept)) for kept in combinations(blocks, 3)]


def _with_company(same: DataFrame, k: int) -> DataFrame:
    """(fid, hash) of the hashes that agree with another one in three of k + 3 blocks.
    No other hash has one within ``k`` bits. Only counts of keys are compared."""
    keys = F.array(*(F.col("hash").bitwiseAND(F.lit(m).cast("bigint")) for m in _kept_blocks(k)))
    keyed = same.select("fid", "hash", F.posexplode(keys).alias("number", "key"))
    shared = keyed.groupBy("number", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keyed.join(shared, ["number", "key"], "left_semi").select("fid", "hash").distinct()


def near_pairs(same: DataFrame, k: int = NEAR_BITS) -> DataFrame:
    """All pairs of distinct hashes within ``k`` bits, k being 1, 2 or 3; ``same`` is best stored.

    Two hashes that are so near have a value half-way between them. Every hash is filed under
    the values within half of ``k`` bits, rounded up, and looked up under those within the other
    half. A value holds 65 hashes at most for k up to 2 and 2,081 for k of 3, however the
    hashes are distributed. Of several values half-way, the pair counts under one: that
    which the hash of the larger fid reaches by flipping the lowest bits that differ.
    """
    if k not in (1, 2, 3):
        raise ValueError("pairs are listed within 1, 2 or 3 bits")
    near = materialize(_with_company(same, k))

    def filed(fid: str, hash_: str, radius: int) -> DataFrame:
        return near.select("fid", "hash", F.explode(ball(F.col("hash"), radius)).alias("key")).toDF(fid, hash_, "key")

    a, b = F.col("fid"), F.col("other_fid")
    differ = F.col("hash").bitwiseXOR(F.col("other_hash"))
    step = F.col("other_hash").bitwiseXOR(F.col("key"))
    lowest = F.when(F.bit_count(differ) > 1, differ.bitwiseAND(-differ)).otherwise(0)
    met = filed("fid", "hash", (k + 1) // 2).hint("merge").join(filed("other_fid", "other_hash", k // 2), "key")
    return met.where((a < b) & (F.bit_count(differ) <= k) & (step == lowest)).select(
        a.alias("fid_a"), b.alias("fid_b"), F.bit_count(differ).cast("int").alias("distance")
    )


_LEADERS = "array<struct<fid:bigint,hash:bigint,samelen:bigint,members:array<bigint>>>"


def _fold_group(rows: Column, k: int) -> Column:
    """Leaders of one block group, from rows in leader order.

    Taking the head, absorbing all within k and repeating gives each row to the
    first leader within k, so one pass over the sorted rows is the same.
    """

    def leader(x: Column) -> Column:
        return F.struct(
            x["fid"].alias("fid"),
            x["hash"].alias("hash"),
            x["samelen"].alias("samelen"),
            F.array(x["fid"]).alias("members"),
        )

    def step(leaders: Column, x: Column) -> Column:
        near = F.transform(leaders, lambda w: within(w["hash"], x["hash"], k))
        first = F.array_position(near, F.lit(True))

        def absorb(w: Column, i: Column) -> Column:
            merged = F.struct(
                w["fid"].alias("fid"),
                w["hash"].alias("hash"),
                (w["samelen"] + x["samelen"]).alias("samelen"),
                F.concat(w["members"], F.array(x["fid"])).alias("members"),
            )
            return F.when(i + 1 == first, merged).otherwise(w)

        return F.when(first == 0, F.concat(leaders, F.array(leader(x)))).otherwise(
            F.transform(leaders, absorb)
        )

    return F.aggregate(rows, F.array().cast(_LEADERS), step)


def merge_block_group(
    fids: np.ndarray, values: np.ndarray, lens: np.ndarray, masks: np.ndarray
) -> list[tuple[int, int, np.ndarray]]:
    """(leader row, samelen, member rows) of one group, from rows in leader order.

    ``values`` are the 16 bits that tell the rows of a group apart; a leader looks
    its neighbours up in a table over them instead of scanning the group.
    """
    row_at = np.full(1 << BLOCK_BITS, -1, dtype=np.int64)
    row_at[values] = np.arange(len(values))
    free = np.ones(len(values), dtype=bool)
    merged = []
    for head in range(len(values)):
        if not free[head]:
            continue
        near = row_at[values[head] ^ masks]
        near = near[near >= 0]
        taken = np.sort(near[free[near]])
        free[taken] = False
        merged.append((head, int(lens[taken].sum()), fids[taken]))
    return merged


def _merge_large(groups: DataFrame, k: int, block: int) -> DataFrame:
    masks = np.array([0, *_flip_masks(k)], dtype=np.int64)
    shift = np.uint64(block_shift(block))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                cols = {c: rows.values.field(c).to_numpy() for c in ("fid", "hash", "samelen")}
                values = (cols["hash"].view(np.uint64) >> shift) & np.uint64((1 << BLOCK_BITS) - 1)
                merged = merge_block_group(cols["fid"], values.astype(np.int64), cols["samelen"], masks)
                heads = [head for head, _, _ in merged]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cols["fid"][heads]),
                        pa.array(cols["hash"][heads]),
                        pa.array([n for _, n, _ in merged], pa.int64()),
                        pa.array([m for _, _, m in merged], pa.list_(pa.int64())),
                    ],
                    names=DISTANCE.names,
                )

    return groups.mapInArrow(merge, DISTANCE)


def merge_round(clusters: DataFrame, k: int = NEAR_BITS, block: int = 0) -> DataFrame:
    """One merge round over (fid, hash, samelen) rows with unique hashes.

    Leaders go by samelen descending, then fid. ``members`` are the rows of the
    previous round that a leader absorbed, itself included. Most rows are alone
    under their key and pass through; all three branches read one shuffle.
    """
    row = F.struct((-F.col("samelen")).alias("rank"), "fid", "hash", "samelen")
    keyed = clusters.select("fid", "hash", "samelen", block_key(F.col("hash"), block).alias("key"))
    counted = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))

    def groups(condition: Column) -> DataFrame:
        rows = F.array_sort(F.collect_list(row)).alias("rows")
        return counted.where(condition).groupBy("key").agg(rows).select("rows")

    n = F.col("n")
    alone = counted.where(n == 1).select("fid", "hash", "samelen", F.array("fid").alias("members"))
    small = groups((n > 1) & (n <= FOLD_ROWS)).select(F.inline(_fold_group(F.col("rows"), k)))
    large = _merge_large(groups((n > 1) & (n > FOLD_ROWS)), k, block)
    return conform(alone.unionByName(small).unionByName(large), DISTANCE)


def absorbed(merged: DataFrame) -> DataFrame:
    """(fid, rep_fid) of the rows a round gave to another leader."""
    edges = merged.where(F.size("members") > 1).select(
        F.explode("members").alias("member"), F.col("fid").alias("rep_fid")
    )
    return edges.where("member != rep_fid").select(F.col("member").alias("fid"), "rep_fid")


def _final_leaders(rounds: list[DataFrame]) -> DataFrame:
    """(fid, rep_fid) of every row absorbed in any round, at its last leader.

    A row is absorbed at most once, so walking back from the last round resolves
    each chain with joins on the absorbed rows alone.
    """

    def extend(later: DataFrame, edges: DataFrame) -> DataFrame:
        moved = later.select(F.col("fid").alias("rep_fid"), F.col("rep_fid").alias("last"))
        resolved = edges.join(moved, "rep_fid", "left").select(
            "fid", F.coalesce("last", "rep_fid").alias("rep_fid")
        )
        return later.unionByName(resolved)

    return reduce(extend, reversed(rounds))


def cluster_members(hashes: DataFrame, same: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(rep_fid, fid) of every document, from the merge rounds in order; documents too
    short to fingerprint stand for themselves."""
    moved = _final_leaders([absorbed(r) for r in rounds]).withColumnRenamed("rep_fid", "last")
    reps = same.join(moved, "fid", "left").select(
        "hash", F.coalesce("last", "fid").alias("rep_fid"), "samelen"
    )
    return _attach_reps(drop_short(hashes), materialize(reps)).unionByName(_alone(hashes))


def near_dup_clusters(hashes: DataFrame, k: int = NEAR_BITS) -> tuple[DataFrame, DataFrame]:
    """Clusters (fid, hash, samelen, members) after one round per block, each
    reading the one before, and the members (rep_fid, fid) of all documents.

    Rounds only carry distinct hashes; each is stored, since the next round and
    the member table both read it.
    """
    same = materialize(same_hash(hashes))
    level, rounds = same, []
    for block in range(BLOCKS):
        level = materialize(merge_round(level.select("fid", "hash", "samelen"), k, block))
        rounds.append(level)
    return level, cluster_members(hashes, same, rounds)


def member_string(members: DataFrame, part_ids: int = MEMBER_PART, sep: str = ",") -> DataFrame:
    """(rep_fid, part, samefid): the fids of each cluster in order, in strings of at most
    ``part_ids`` ids, the parts numbered from 0. All ids are kept.

    Ids are numbered by one sort over ranges, so that a large cluster is spread over
    tasks and no group holds more than one part.
    """
    placed = ranked(members.select("rep_fid", "fid"), F.col("rep_fid"), F.col("fid"))
    first = placed.groupBy("rep_fid").agg(F.min("rank").alias("first"))
    part = F.floor((F.col("rank") - F.col("first")) / part_ids).alias("part")
    fids = F.transform(F.array_sort(F.collect_list("fid")), lambda f: f.cast("string"))
    parts = placed.join(first, "rep_fid").select("rep_fid", "fid", part).groupBy("rep_fid", "part")
    return parts.agg(F.array_join(fids, sep).alias("samefid"))


def hash_ball(listed: DataFrame, k: int = NEAR_BITS) -> DataFrame:
    """Every hash within ``k`` bits of a listed one, so that distance becomes equality."""
    # The ball of 3 bits would have 43,745 hashes for each listed one.
    if k not in range(3):
        raise ValueError("hashes within 0, 1 or 2 bits are listed")
    near = listed.toDF("hash").distinct()
    for _ in range(k):
        near = near.select(F.explode(ball(F.col("hash"))).alias("hash"))
    return near


def _match(df: DataFrame, listed: DataFrame, k: int, how: str) -> DataFrame:
    return join_listed(df, hash_ball(listed, k), "hash", how, BROADCAST_BYTES).select(*df.columns)


def _is_near(hash_: Column, listed: DataFrame, k: int) -> Column:
    """Whether a hash is within ``k`` bits of one of a bounded list; a null one is not."""
    shipped = listed.sparkSession.sparkContext.broadcast(listed.toArrow().column(0).to_numpy())
    indexes = []

    @arrow_udf(BooleanType())
    def run(hashes: pa.Array) -> pa.Array:
        if not indexes:
            indexes.append(NearIndex(shipped.value, k))
        return pa.array(indexes[0].near(hashes.to_numpy(zero_copy_only=False)))

    return hash_.isNotNull() & run(F.coalesce(hash_, F.lit(0).cast("bigint")))


def _match_far(df: DataFrame, listed: DataFrame, k: int, keep: bool, most: int) -> DataFrame:
    """Rows near a listed hash, or the others, by an index that is shipped to the tasks: no
    shuffle. A list of more than ``most`` hashes is dealt out to several indexes, and the
    distinct hashes that none has met yet pass them one after another."""
    if k not in range(MOST_BITS + 1):
        raise ValueError(f"listed hashes are matched within 0 to {MOST_BITS} bits")
    junk = materialize(listed.toDF("listed").where("listed IS NOT NULL").distinct())
    parts = max(1, -(-junk.count() // most))
    if parts == 1:
        near = _is_near(F.col("hash"), junk, k)
        return df.where(near if keep else ~near)
    dealt = junk.withColumn("part", F.pmod(F.xxhash64("listed"), F.lit(parts)))
    left = materialize(df.select("hash").where("hash IS NOT NULL").distinct())
    hits = []
    for part in range(parts):
        own = dealt.where(F.col("part") == part).select("listed")
        told = materialize(left.withColumn("near", _is_near(F.col("hash"), own, k)))
        hits.append(told.where("near").select("hash"))
        left = told.where("NOT near").select("hash")
    return join_listed(df, reduce(DataFrame.unionByName, hits), "hash", "left_semi" if keep else "left_anti").select(*df.columns)


def match_hashes(df: DataFrame, listed: DataFrame, k: int = NEAR_BITS, most: int = INDEXED_HASHES) -> DataFrame:
    """Rows whose hash is within ``k`` bits of a listed one, ``k`` being 7 at most. Up to 1 bit the
    neighbours of the listed hashes are joined, 65 of each; beyond that an index of at most
    ``most`` of them is searched within the row."""
    return _match(df, listed, k, "left_semi") if k in range(2) else _match_far(df, listed, k, True, most)


def drop_hashes(df: DataFrame, listed: DataFrame, k: int = NEAR_BITS, most: int = INDEXED_HASHES) -> DataFrame:
    """Rows whose hash is not within ``k`` bits of any listed one; the same two ways."""
    return _match(df, listed, k, "left_anti") if k in range(2) else _match_far(df, listed, k, False, most)


def _contains_listed(df: DataFrame, col: str, pieces: DataFrame) -> Column:
    """Whether the text of a row contains one of the strings of ``pieces``, which is small. Each
    distinct text of a batch is read once; a null one contains nothing."""
    listed = [r[0].encode() for r in pieces.collect()]
    # Arrays are shipped, not the object: its class need not be known where a broadcast is read.
    shipped = df.sparkSession.sparkContext.broadcast(automaton(listed).parts())

    @arrow_udf(BooleanType())
    def run(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        return pa.array(Automaton(*shipped.value).contained(coded.dictionary)).take(coded.indices)

    return run(F.coalesce(col, F.lit("")))


def drop_urls(df: DataFrame, listed: DataFrame, max_bytes: int = LISTED_BYTES) -> DataFrame:
    """Rows whose furl contains none of the listed strings, found by an automaton of all of
    them that reads a furl once. A list of more than ``max_bytes`` is dealt out to several
    automata, and the distinct furl values pass them one after another."""
    urls = materialize(listed.toDF("piece").where(F.length("piece") > 0).distinct())
    parts = -(-estimated_bytes(urls) // max_bytes)
    if parts <= 1:
        return df.where(~_contains_listed(df, "furl", urls))
    dealt = urls.withColumn("part", F.pmod(F.xxhash64("piece"), F.lit(parts)))
    sites = materialize(df.select("furl").distinct())

    def hit(part: int) -> DataFrame:
        own = dealt.where(F.col("part") == part).select("piece")
        return materialize(sites.where(_contains_listed(sites, "furl", own)))

    hits = reduce(DataFrame.unionByName, [hit(part) for part in range(parts)])
    return drop_listed(df, hits.distinct(), "furl").select(*df.columns)


def drop_short(df: DataFrame) -> DataFrame:
    """Rows that were long enough to fingerprint."""
    return df.where(~F.col("hash").eqNullSafe(F.lit(SHORT_HASH)))


def drop_titles(df: DataFrame, listed: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Rows whose title is not listed."""
    return drop_listed(df, listed.toDF("ftitle"), "ftitle", max_bytes).select(*df.columns)


def keep_ids(df: DataFrame, listed: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Rows whose fid is listed."""
    return keep_listed(df, listed.toDF("fid"), "fid", max_bytes).select(*df.columns)


def discard(
    keyed: DataFrame, hashes: DataFrame, urls: DataFrame, titles: DataFrame | None = None
) -> DataFrame:
    """Pages that are not junk, as (fid, words, hash): junk has a listed URL part,
    too few words, or a hash next to a listed one. A title list is optional."""
    kept = drop_hashes(drop_short(drop_urls(keyed, urls)), hashes, NEAR_BITS)
    if titles is not None:
        kept = drop_titles(kept, titles)
    return kept.select("fid", "words", "hash")


def dup_report(
    clusters: DataFrame,
    pages: DataFrame,
    threshold: int,
    topics: DataFrame | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Clusters of at least ``threshold`` documents with the page fields of their
    representative; with topics, also the topic, and the text fields condensed."""
    large = clusters.where(F.col("samelen") >= threshold).select("fid", "hash", "samelen")
    if topics is not None:
        large = large.join(topics.select("fid", "cat", "prob"), "fid")
    # The narrow list first; of a list too long to ship, texts of listed pages are shuffled.
    wide = pages.select("fid", "furl", "ftitle", "fkeywords", "fcontent")
    report = join_listed(wide, large, "fid", max_bytes=max_bytes)
    if topics is None:
        return report.select("fid", "hash", "samelen", "furl", "ftitle", "fkeywords", "fcontent")
    return report.select(
        "fid",
        "hash",
        "samelen",
        site_of(F.col("furl")).alias("furl"),
        *(squash(F.col(c)).alias(c) for c in ("ftitle", "fkeywords", "fcontent")),
        "cat",
        "prob",
    )
