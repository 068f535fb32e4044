"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix has as many words as the documents. It is cut into blocks of equal size;
the method of highest quotients gives each source an integer number of them, and
each source's blocks to its shards. A shard is a part of its source's documents in
a seeded order. It gives whole passes over its documents first and then, from a
seeded block on, as many consecutive blocks as its quota still asks for, so almost
all documents are taken whole. No step holds more than one shard's document sizes.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.chars import text_or_empty
from pagemill.llm.names import unused
from pagemill.operators.ordering import ranked
from pagemill.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 8
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# A source of n documents has about sqrt(n) / 4 shards, so that neither the shards of
# a source nor the documents of a shard become many.
SHARD_SCALE = 4.0


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash) of every document; a null text has size 0."""
    text = text_or_empty(F.col("text"))
    return docs.select("doc_id", "source", word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, n_docs, target): the weights go round the sources in code
    point order, null last; no target exceeds ``repeats`` times its source, and what
    that leaves over is shared again by weight until none does. Stored.

    Each round is one sum over the sources. A round settles every source it finds
    above its limit, so their number is that of the distinct levels, rarely over ten.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    numbered = ranked(totals, F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(w) for w in weights))
    limit = F.lit(repeats) * F.col("source_size")
    sources = materialize(
        numbered.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).cast("bigint"))
    )
    level, full = None, F.lit(False)
    while True:
        open_, closed = F.when(~full, F.col("weight")), F.when(full, limit)
        row = sources.agg(F.sum("source_size"), F.sum(open_), F.coalesce(F.sum(closed), F.lit(0))).first()
        total, weight, taken = row[0] or 0, row[1] or 0, row[2]
        if not weight:
            break
        level = (total - taken) / weight
        above = full | (F.col("weight") * F.lit(level) > limit)
        if not sources.where(above & ~full).limit(1).count():
            break
        full = above
    share = F.col("weight") * F.lit(level) if level is not None else F.lit(0.0)
    target = F.when(full, limit.cast("double")).otherwise(share)
    return materialize(sources.select("source", "source_size", "n_docs", target.cast("double").alias("target")))


def apportion(parties: DataFrame, group: Sequence[str], key: str, claim: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the seats of each group by highest quotients
    claim / (2 q + 1); of equal quotients the smallest key's comes first.

    Rounding claim / divisor, the divisor being claims over seats, already gives every
    party its seats up to a few per group. Only the quotients around that border are
    listed: about two per party and one per seat still open.
    """
    by = Window.partitionBy(*group)
    per_seat = F.sum(claim).over(by) / F.col(seats)
    start = F.when(F.col(seats) > 0, F.floor(F.col(claim) / per_seat + 0.5)).otherwise(0).cast("bigint")
    rough = parties.withColumn("_q", F.coalesce(start, F.lit(0).cast("bigint"))).withColumns(
        {"_open": F.col(seats) - F.sum("_q").over(by), "_n": F.count(F.lit(1)).over(by), "_all": F.sum(claim).over(by)}
    )
    reach = F.ceil(F.col(claim) / F.col("_all") * (F.abs("_open") + F.col("_n"))) + 1
    near = F.sequence(F.lit(0), F.coalesce(reach, F.lit(1)).cast("int"))
    listed = rough.where("_open <> 0").select(*group, key, claim, "_q", "_open", F.explode(near).alias("_i"))
    seat = F.when(F.col("_open") > 0, F.col("_q") + F.col("_i")).otherwise(F.col("_q") - 1 - F.col("_i"))
    quotient = F.col(claim) / (2 * F.col("_seat") + 1)
    up = F.col("_open") > 0
    order = Window.partitionBy(*group).orderBy(
        F.when(up, -quotient).otherwise(quotient), F.when(up, F.col(key)).asc_nulls_last(), F.when(~up, F.col(key)).desc()
    )
    moved = (
        listed.withColumn("_seat", seat)
        .where("_seat >= 0")
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= F.abs("_open"))
        .groupBy(*group, key)
        .agg(F.sum(F.signum("_open")).cast("bigint").alias("_moved"))
    )
    mine = rough.alias("a").join(
        moved.alias("b"), _same([*group, key]), "left"
    )
    quota = F.col("a._q") + F.coalesce("b._moved", F.lit(0).cast("bigint"))
    return mine.select("a.*", quota.alias("quota")).drop("_q", "_open", "_n", "_all")


def _same(names: Sequence[str]) -> Column:
    """Equal keys of frames a and b, null equal to null."""
    condition = F.col(f"a.{names[0]}").eqNullSafe(F.col(f"b.{names[0]}"))
    for name in names[1:]:
        condition = condition & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return condition


def _hash(seed: int, *cols: str) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(c) for c in cols))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = 1,
) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, passes, cut_from, cut_to, taken) of
    every row of (doc_id, source, text).

    A document is taken whole ``passes`` times, and once more its words from
    ``cut_from`` to before ``cut_to`` (and, if ``cut_from`` > ``cut_to``, those before
    ``cut_to`` and from ``cut_from``). A null text has no words and is taken 0 times;
    a null source is a source of its own, the last; null and repeated ids are rows
    like any other (equal rows share a place in the order, which follows the rest of
    the row); an empty table gives no rows. A source without words has target 0.
    """
    sizes = materialize(sized_documents(docs))
    sources = source_targets(sizes, weights, repeats)
    seats = F.round(F.sum("target").over(Window.partitionBy("_all")) / block_words).cast("bigint")
    whole = sources.withColumn("_all", F.lit(0)).withColumn("_seats", seats)
    quotas = materialize(apportion(whole, ["_all"], "source", "target", "_seats").drop("_all", "_seats"))

    shards = F.greatest(F.ceil(F.sqrt("n_docs") / SHARD_SCALE), F.lit(1)).cast("bigint")
    listed = quotas.withColumn("n_shards", shards)
    placed = (
        sizes.alias("a")
        .join(listed.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select("a.*", "source_size", "target", F.col("quota").alias("_seats"), "n_shards")
        .withColumn("_hash", _hash(seed, "doc_id", "text_hash"))
        .withColumn("shard", F.pmod("_hash", F.col("n_shards")))
    )
    in_shard = Window.partitionBy("source", "shard")
    running = in_shard.orderBy(_hash(seed + 1, "doc_id", "text_hash"), "doc_id", "text_hash", "size")
    placed = materialize(placed.withColumns({
        "_end": F.sum("size").over(running.rowsBetween(Window.unboundedPreceding, 0)),
        "shard_size": F.sum("size").over(in_shard),
    }))
    parts = placed.groupBy("source", "shard").agg(
        F.first("shard_size").alias("shard_size"), F.first("_seats").alias("_seats")
    )
    parts = apportion(parts, ["source"], "shard", "shard_size", "_seats")
    words = F.least(F.col("quota") * block_words, F.lit(repeats) * F.col("shard_size"))
    has = F.col("shard_size") > 0
    parts = parts.select(
        "source",
        "shard",
        F.when(has, F.floor(words / F.col("shard_size"))).otherwise(0).cast("bigint").alias("passes"),
        F.when(has, words % F.col("shard_size")).otherwise(0).cast("bigint").alias("rest"),
        F.when(has, F.pmod(_hash(seed + 2, "source", "shard"), F.ceil(F.col("shard_size") / block_words)) * block_words)
        .otherwise(0).cast("bigint").alias("first"),
    )
    joined = placed.alias("a").join(parts.alias("b"), _same(["source", "shard"]))
    start, size = F.col("_end") - F.col("size"), F.col("size")

    def inside(low: Column, high: Column) -> Column:
        """Words of the document that lie in [low, high) of its shard, as a pair."""
        return F.least(F.greatest(low - start, F.lit(0)), size), F.least(F.greatest(high - start, F.lit(0)), size)

    stop = F.col("first") + F.col("rest")
    low, high = inside(F.col("first"), F.least(stop, F.col("shard_size")))
    _, around = inside(F.lit(0), F.greatest(stop - F.col("shard_size"), F.lit(0)))
    wraps = around > 0
    # Words before ``around`` come in as well where the blocks pass the shard's end.
    cut_from = F.when(wraps & (high <= low), F.lit(0)).otherwise(low)
    cut_to = F.when(wraps & (high <= low), around).when(wraps, around).otherwise(high)
    both = wraps & (high > low)
    extra = (high - low) + around
    return joined.select(
        "doc_id",
        "a.source",
        "text_hash",
        "size",
        "source_size",
        "target",
        "passes",
        cut_from.cast("bigint").alias("cut_from"),
        F.when(both, around).otherwise(cut_to).cast("bigint").alias("cut_to"),
        (F.col("passes") * size + F.greatest(extra, F.lit(0))).cast("bigint").alias("taken"),
    )


def take(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, all columns: a whole text once for
    each pass, and a row with the words of the cut where there is one. A text keeps the
    blanks between the words it keeps."""
    keys = ["doc_id", "source", "text_hash"]
    cut = F.when(F.col("cut_from") != F.col("cut_to"), F.struct("cut_from", "cut_to"))
    shares = mix(docs, **options).groupBy(*keys).agg(
        F.sum("passes").alias("_passes"), F.collect_list(cut).alias("_cuts")
    )
    free = unused(docs, "_doc_id", "_source", "_text_hash", "_passes", "_cuts", "text_hash_", "_texts", "_text")
    doc_id, source, text_hash, passes, cuts, own_hash, all_texts, one_text = free
    named = shares.toDF(doc_id, source, text_hash, passes, cuts)
    hashed = docs.withColumn(own_hash, F.xxhash64(text_or_empty(F.col("text"))))
    one = hashed.dropDuplicates(["doc_id", "source", own_hash])
    same = (
        F.col("doc_id").eqNullSafe(F.col(doc_id))
        & F.col("source").eqNullSafe(F.col(source))
        & (F.col(own_hash) == F.col(text_hash))
    )
    pieces = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))

    def cut_text(c: Column) -> Column:
        low, high = c["cut_from"].cast("int"), c["cut_to"].cast("int")
        inner = F.slice(pieces, low + 1, F.greatest(high - low, F.lit(0)))
        outer = F.concat(F.slice(pieces, F.lit(1), high), F.slice(pieces, low + 1, F.size(pieces)))
        return F.array_join(F.when(low < high, inner).otherwise(outer), "")

    whole = F.array_repeat(F.col("text"), F.col(passes).cast("int"))
    texts = F.concat(whole, F.transform(cuts, cut_text))
    taken = one.join(named, same).withColumn(all_texts, texts).withColumn(one_text, F.explode(all_texts))
    return taken.select(*(F.col(one_text).alias("text") if c == "text" else F.col(c) for c in docs.columns))
