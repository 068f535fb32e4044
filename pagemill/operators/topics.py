"""Two-level topic classification and the choice between competing topics.

The built-in classifier is multinomial naive Bayes, fitted with joins and sums. A model
is a table of word weights; small ones are shipped to the tasks, which score every
document where it is. External classifiers take their place as ``ExternalModels``.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from pagemill.constants import (
    ALL_MODEL,
    LABEL_PREFIX,
    OTHER_SUFFIX,
    PROB_BLANK_OR_ERROR,
    PROB_NO_CHILD_ANSWER,
    PROB_NO_PARENT_ANSWER,
    UNKNOWN,
)
from pagemill.functions.text import VISIBLE, nonblank_sql
from pagemill.operators.joins import BROADCAST_BYTES, fits, keep_listed, row_bytes, sized
from pagemill.schemas import EDITOR_TOPICS, FID_CAT, PREDICTION, conform
from pagemill.sources.scratch import materialize

# Bytes of texts in a block, the weights of whose words a task holds at once, and words that it
# adds up at once.
BLOCK_BYTES = 64 << 20
BLOCK_CELLS = 8_000_000
BLOCKS_A_CORE = 4
# Words that are looked up in a block's weights at once.
LOOKUP_CELLS = 1_000_000
# The column of row numbers.
ROW = "_stored_row"


@dataclass(frozen=True)
class TopicModels:
    """Naive Bayes models by name.

    ``weights``: model, word, scores array<double>, the log of the smoothed count
    under each label of the model.
    ``labels``: model, labels array<struct<label, prior, denominator>>, the labels
    in the order of the scores.
    ``width`` is the largest number of labels of a model; ``small`` tells that both
    tables stay within the bytes a list may have to be broadcast. Of larger weights, those of
    words of at least ``least_strength`` do (none if it is null), and ``rest_bytes`` are the others'.
    """

    weights: DataFrame
    labels: DataFrame
    width: int
    small: bool
    least_strength: int | None = None
    rest_bytes: int = 0

    def score(self, docs: DataFrame) -> DataFrame:
        return _score_in_row(docs, self) if self.small else _score_joined(docs, self)

    def named(self) -> DataFrame:
        return self.labels.select("model")


def topic_models(weights: DataFrame, labels: DataFrame, max_bytes: int | None = None) -> TopicModels:
    width = labels.select(F.max(F.size("labels"))).first()[0] or 0
    left = BROADCAST_BYTES if max_bytes is None else max_bytes
    sizes = weights.groupBy(_strength().alias("strength")).agg(F.sum(row_bytes(weights)).alias("bytes")).collect()
    total = sum(r.bytes for r in sizes)
    small = total <= left and fits(labels, max_bytes)
    least, shipped = None, 0
    for r in sorted(sizes, key=lambda r: -r.strength):
        if shipped + r.bytes > left:
            break
        least, shipped = r.strength, shipped + r.bytes
    return TopicModels(weights, labels, width, small, least, total - shipped)


def _strength() -> Column:
    """How often the training text has a word, in eighths of a power of two: some hundred values."""
    often = F.aggregate("scores", F.lit(0.0), lambda total, score: total + F.exp(score))
    strength = F.floor(F.log2(often) * 8).cast("int")
    return F.coalesce(F.greatest(F.least(strength, F.lit(1000)), F.lit(-1000)), F.lit(-1000))


def fit_topics(lines: DataFrame) -> TopicModels:
    """Fit one model per ``model`` from (model, label, text), Laplace smoothing 1.

    The result is stored, as model files would be: the text is read once, and
    scoring reads finished weights.
    """
    counts = word_counts(lines)
    is_word = F.col("word").isNotNull()
    label_totals = materialize(
        counts.groupBy("model", "label")
        .agg(
            F.sum(F.when(~is_word, F.col("n"))).alias("docs"),
            F.sum(F.when(is_word, F.col("n")).otherwise(0)).alias("tokens"),
        )
        .groupBy("model")
        .agg(
            F.sum("docs").alias("all_docs"),
            F.array_sort(F.collect_list(F.struct("label", "docs", "tokens"))).alias("labels"),
        )
    )
    by_label = F.map_from_entries(F.collect_list(F.struct("label", "n")))

    def score(row: Column) -> Column:
        return F.log(F.coalesce(F.element_at("by_label", row["label"]), F.lit(0)) + 1.0)

    weights = materialize(
        counts.where(is_word)
        .groupBy("model", "word")
        .agg(by_label.alias("by_label"))
        .join(sized(label_totals), "model")
        .select("model", "word", F.transform("labels", score).alias("scores"))
    )
    vocabulary = weights.groupBy("model").agg(F.count(F.lit(1)).alias("vocabulary"))

    def entry(row: Column) -> Column:
        return F.struct(
            row["label"].alias("label"),
            F.log(row["docs"] / F.col("all_docs")).alias("prior"),
            F.log(row["tokens"] + F.col("vocabulary")).alias("denominator"),
        )

    labels = label_totals.join(vocabulary, "model").select(
        "model", F.transform("labels", entry).alias("labels")
    )
    return topic_models(weights, materialize(labels))


def word_counts(lines: DataFrame) -> DataFrame:
    """(model, label, word, n), stored. A null word counts the lines of a label."""
    texts = lines.select("model", "label", "text").where("text is not null")
    counted = texts.mapInArrow(_batch_counts, "model string, label string, word string, n bigint")
    return materialize(counted.groupBy("model", "label", "word").agg(F.sum("n").alias("n")))


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word_counts`` of each batch by itself, so that a word is handed on once a batch."""
    for batch in batches:
        if not len(batch):
            continue
        names, labels = (batch.column(c).dictionary_encode(null_encoding="encode") for c in ("model", "label"))
        code = names.indices.to_numpy().astype(np.int64) * len(labels.dictionary) + labels.indices.to_numpy()
        groups, group, lines = np.unique(code, return_inverse=True, return_counts=True)
        lists = pc.split_pattern(batch.column("text"), " ")
        words = lists.flatten().dictionary_encode()
        size = max(len(words.dictionary), 1)
        cells = np.repeat(group, np.diff(lists.offsets.to_numpy())) * size + words.indices.to_numpy()
        cells, n = np.unique(cells, return_counts=True)
        said = words.dictionary.take(pa.array(cells % size))
        kept = pc.not_equal(said, "")
        own = groups[np.append(cells // size, np.arange(len(groups)))]
        counts = pa.RecordBatch.from_arrays(
            [
                names.dictionary.take(pa.array(own // len(labels.dictionary))),
                labels.dictionary.take(pa.array(own % len(labels.dictionary))),
                pa.concat_arrays([said, pa.nulls(len(groups), said.type)]),
                pa.array(np.append(n, lines)),
            ],
            ["model", "label", "word", "n"],
        )
        yield counts.filter(pa.concat_arrays([kept, pa.array(np.ones(len(groups), bool))]))


def _few(labels: DataFrame) -> DataFrame:
    """Labels, broadcast if they are known to be small: most rows name the same model, and a
    join by its name would bring them into one task."""
    return F.broadcast(labels) if fits(labels) else labels.hint("merge")


def weight_rows(models: TopicModels) -> DataFrame:
    """Log weight of each word under each label of its model."""
    zipped = F.arrays_zip(F.col("scores"), F.col("labels"))
    rows = models.weights.join(_few(models.labels), "model").select(
        "model", "word", F.explode(zipped).alias("z")
    )
    label = F.col("z.labels")
    return rows.select(
        "model",
        label["label"].alias("label"),
        "word",
        (F.col("z.scores") - label["denominator"]).alias("log_weight"),
        label["prior"].alias("prior"),
    )


def _with_fallbacks(scored: DataFrame) -> DataFrame:
    """(fid, words, model, cat, prob) to a prediction for every row."""
    blank = F.col("words").isNull() | ~F.col("words").rlike(VISIBLE)
    silent = F.col("cat").isNull()
    parent = F.col("model") == ALL_MODEL
    cat = (
        F.when(blank | (silent & parent), UNKNOWN)
        .when(silent, F.concat("model", F.lit(OTHER_SUFFIX)))
        .otherwise(F.regexp_replace("cat", LABEL_PREFIX, ""))
    )
    prob = (
        F.when(blank, PROB_BLANK_OR_ERROR)
        .when(silent & parent, PROB_NO_PARENT_ANSWER)
        .when(silent, PROB_NO_CHILD_ANSWER)
        .otherwise(F.col("prob"))
    )
    return scored.withColumns({"cat": cat, "prob": prob})


def _posterior(known: Column, sums: Column, labels: Column) -> Column:
    """Best (cat, prob) from per-label sums; ties go to the first label."""

    def score(row: Column, total: Column) -> Column:
        value = row["prior"] - known * row["denominator"] + total
        return F.struct(value.alias("score"), row["label"].alias("label"))

    scores = F.zip_with(labels, F.slice(sums, F.lit(1), F.size(labels)), score)
    best = F.array_max(F.transform(scores, lambda s: s["score"]))
    winners = F.filter(scores, lambda s: s["score"] == best)
    mass = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s["score"] - best))
    return F.struct(
        F.array_min(F.transform(winners, lambda s: s["label"])).alias("cat"),
        (F.lit(1.0) / mass).alias("prob"),
    )


@dataclass(frozen=True)
class _Shipped:
    """One small model as arrays: words, a row of scores for each, and its labels."""

    words: pa.Array
    scores: np.ndarray
    labels: list[str]
    priors: np.ndarray
    denominators: np.ndarray


def _model_arrays(models: TopicModels) -> dict[str, tuple]:
    """The fields of ``_Shipped`` by model name; called for small models only."""
    weights = models.weights.toArrow()
    names = weights["model"].combine_chunks()
    arrays = {}
    for row in models.labels.collect():
        own = weights.filter(pc.equal(names, row.model))
        flat = own["scores"].combine_chunks().flatten().to_numpy()
        labels = [x.label for x in row.labels]
        values = (np.array([x[c] for x in row.labels]) for c in ("prior", "denominator"))
        arrays[row.model] = (own["word"].combine_chunks(), flat.reshape(-1, len(labels)), labels, *values)
    return arrays


def score_texts(texts: pa.Array, model: _Shipped) -> tuple[list[str | None], list[float | None]]:
    """Best label and its probability of each text, None where no word is known."""
    lists = pc.split_pattern(texts, " ")
    tokens = lists.flatten().dictionary_encode()
    known = pc.index_in(tokens.dictionary, value_set=model.words).fill_null(-1).to_numpy()
    ids = known[tokens.indices.to_numpy()] if len(tokens) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[ids >= 0]
    ids = ids[ids >= 0]
    counts = np.bincount(owner, minlength=len(texts))
    sums = np.stack(
        [np.bincount(owner, model.scores[ids, k], minlength=len(texts)) for k in range(len(model.labels))], axis=1
    )
    scores = model.priors - counts[:, None] * model.denominators + sums
    best = scores.argmax(axis=1)
    mass = np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
    cats = [model.labels[b] if n else None for b, n in zip(best, counts)]
    return cats, [1 / m if n else None for m, n in zip(mass, counts)]


def _score_in_row(docs: DataFrame, models: TopicModels) -> DataFrame:
    """Every row scored where it is: ids are not looked at and nothing is shuffled."""
    shipped = docs.sparkSession.sparkContext.broadcast(_model_arrays(models))

    @arrow_udf("struct<cat:string,prob:double>")
    def run(words: pa.Array, names: pa.Array) -> pa.Array:
        cats = np.full(len(words), None, object)
        probs = np.full(len(words), None, object)
        for name in names.unique().to_pylist():
            if name not in shipped.value:
                continue
            rows = np.flatnonzero(pc.equal(names, name).to_numpy(zero_copy_only=False))
            cats[rows], probs[rows] = score_texts(words.take(pa.array(rows)), _Shipped(*shipped.value[name]))
        return pa.StructArray.from_arrays([pa.array(cats, pa.string()), pa.array(probs, pa.float64())], ["cat", "prob"])

    return docs.withColumn("_said", run(F.coalesce("words", F.lit("")), F.col("model"))).select(
        "*", F.col("_said.cat").alias("cat"), F.col("_said.prob").alias("prob")
    ).drop("_said")


def _frequent_arrays(models: TopicModels) -> dict[str, tuple[pa.Array, np.ndarray]]:
    """Words and a row of scores for each, by model name, of the words that may be shipped."""
    if models.least_strength is None:
        return {}
    strong = models.weights.where(_strength() >= models.least_strength).select("model", "word", "scores").toArrow()
    names = strong["model"].combine_chunks()
    arrays = {}
    for name in names.unique().drop_null().to_pylist():
        own = strong.filter(pc.equal(names, name))
        scores = own["scores"].combine_chunks().flatten().to_numpy()
        arrays[name] = (own["word"].combine_chunks(), scores.reshape(len(own), -1))
    return arrays


def _sum_frequent(texts: pa.Array, shipped: tuple[pa.Array, np.ndarray] | None, width: int) -> tuple:
    """How many shipped words each text has, the sums of their scores, and the cells of the other
    words: their texts, words and counts."""
    lists = pc.split_pattern(texts, " ")
    tokens = lists.flatten().dictionary_encode()
    size = max(len(tokens.dictionary), 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    at, scores = np.full(size, -1), np.zeros((1, 0))
    if shipped is not None and len(tokens):
        words, scores = shipped
        at = pc.index_in(tokens.dictionary, value_set=words).fill_null(-1).to_numpy()
    said = tokens.indices.to_numpy()
    found = at[said] if len(tokens) else np.zeros(0, np.int64)
    near = found >= 0
    known = np.bincount(owner[near], minlength=len(texts))
    sums = np.zeros((len(texts), width))
    for k in range(scores.shape[1]):
        sums[:, k] = np.bincount(owner[near], scores[found[near], k], minlength=len(texts))
    cells, counts = np.unique(owner[~near] * size + said[~near], return_counts=True)
    return known, sums, cells // size, tokens.dictionary.take(pa.array(cells % size)), counts


def _by_name(names: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    """Each name but null, and its rows."""
    coded = names.dictionary_encode()
    at = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    for i, name in enumerate(coded.dictionary.to_pylist()):
        yield name, np.flatnonzero(at == i)


def _terms(name: str, words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(name), words, "\x01")


def _runs(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of equal values of ``column`` in a row."""
    values = batch.column(column).to_numpy()
    bounds = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for at, stop in zip(bounds, bounds[1:]):
        if stop > at:
            yield batch.slice(at, stop - at)


def _runs_up_to(batches: Iterator[pa.RecordBatch], column: str, rows: int) -> Iterator[pa.RecordBatch]:
    """Equal values of ``column`` in a row, across batches; one that is longer comes in several of
    about so many rows."""
    held, n = [], 0
    for batch in batches:
        for run in _runs(batch, column):
            if held and (n >= rows or held[0].column(column)[0] != run.column(column)[0]):
                yield pa.concat_batches(held)
                held, n = [], 0
            held.append(run)
            n += len(run)
    if held:
        yield pa.concat_batches(held)


def _block_sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial sums (row, model, known, sums) from the cells of blocks, each block's weights before its
    documents' words. Only one block's weights are held. A look-up reads them all, so
    ``LOOKUP_CELLS`` words are looked up at a time, whatever batches they come in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, terms, scores = None, [], []
        for cells in _runs_up_to(batches, "place", LOOKUP_CELLS):
            place = cells.column("place")[0].as_py()
            if place >> 1 != block:
                block, terms, scores = place >> 1, [], []
            if not place & 1:
                lists = cells.column("scores")
                sizes = np.diff(lists.offsets.to_numpy())
                matrix = np.zeros((len(sizes), width))
                matrix[np.repeat(np.arange(len(sizes)), sizes), _positions(sizes)] = lists.flatten().to_numpy()
                terms.append(cells.column("term"))
                scores.append(matrix)
            elif terms:
                if len(terms) > 1:
                    terms, scores = [pa.concat_arrays(terms)], [np.concatenate(scores)]
                found = pc.index_in(cells.column("term"), value_set=terms[0])
                known = found.is_valid().to_numpy(zero_copy_only=False)
                if not known.any():
                    continue
                at = found.drop_null().to_numpy()
                n = cells.column("n").to_numpy()[known]
                rows, first, row = np.unique(cells.column("row").to_numpy()[known], return_index=True, return_inverse=True)
                sums = np.stack([np.bincount(row, scores[0][at, k] * n, len(rows)) for k in range(width)], axis=1)
                model = cells.column("model").take(pa.array(np.flatnonzero(known)[first]))
                ends = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        model,
                        pa.array(np.bincount(row, n, len(rows)).astype(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(sums.ravel())),
                    ],
                    ["row", "own", "known", "sums"],
                )

    return run


def _positions(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each list of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _block_words(shipped: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, term) of the words of (block, model, words) that are not shipped, each once a block."""

    def distinct(block: int, held: list[pa.Array]) -> pa.RecordBatch:
        terms = pa.concat_arrays([pa.array([], pa.string()), *held]).unique()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), block)), terms], ["block", "term"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for part in (part for batch in batches for part in _runs(batch, "block")):
            own = part.column("block")[0].as_py()
            if own != block and held:
                yield distinct(block, held)
                held = []
            block = own
            for name, rows in _by_name(part.column("model")):
                texts = part.column("words").take(pa.array(rows))
                words = pc.split_pattern(texts, " ").flatten().unique()
                words = words.filter(pc.not_equal(words, ""))
                if name in shipped.value:
                    words = words.filter(pc.invert(pc.is_in(words, value_set=shipped.value[name][0])))
                held.append(_terms(name, words))
        if held:
            yield distinct(block, held)

    return run


def _slices(docs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Documents of ``BLOCK_CELLS`` words together at most, or a single one."""
    most = pc.binary_length(docs.column("words")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 2 + 1
    part = (np.cumsum(most) - most) // BLOCK_CELLS
    for rows in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(part)) + 1):
        yield docs.slice(rows[0], len(rows))


def _add_up(shipped: Broadcast, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with (known, sums) from rows of blocks, each block's weights before its documents.
    Only one block's weights are held."""
    block_sums = _block_sums(width)
    names = ["place", "term", "scores", "row", "model", "n"]

    def cells(place: int, rows: list[np.ndarray], terms: list[pa.Array], models: list[pa.Array], n: list[np.ndarray]) -> pa.RecordBatch:
        size = sum(map(len, rows))
        # No null lists: at every row Arrow's writer fills in the null lists before it once more.
        empty = pa.ListArray.from_arrays(pa.array(np.zeros(size + 1, np.int32)), pa.array([], pa.float64()))
        columns = [pa.array(np.full(size, place)), pa.concat_arrays(terms), empty]
        columns += [pa.array(np.concatenate(rows)), pa.concat_arrays(models), pa.array(np.concatenate(n))]
        return pa.RecordBatch.from_arrays(columns, names)

    def weights_of(part: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.array(np.zeros(len(part), np.int64))
        columns = [part.column(c) for c in ("_place", "_term", "_scores")]
        return pa.RecordBatch.from_arrays([*columns, none, pa.nulls(len(part), pa.string()), none], names)

    def summed(docs: pa.RecordBatch, weights: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        known, sums = np.zeros(len(docs), np.int64), np.zeros((len(docs), width))
        texts = docs.column("words").fill_null("")
        owners, terms, models, counts = [], [], [], []
        for name, rows in _by_name(docs.column("model")):
            known[rows], sums[rows], owner, words, n = _sum_frequent(
                texts.take(pa.array(rows)), shipped.value.get(name), width
            )
            said = pc.not_equal(words, "")
            kept = said.to_numpy(zero_copy_only=False)
            owners.append(rows[owner[kept]])
            terms.append(_terms(name, words.filter(said)))
            models.append(pa.repeat(name, len(owners[-1])))
            counts.append(n[kept].astype(np.int64))
        if weights and sum(map(len, owners)):
            place = docs.column("_place")[0].as_py()
            both = pa.concat_batches([*weights, cells(place, owners, terms, models, counts)])
            for part in block_sums(both.slice(i, LOOKUP_CELLS) for i in range(0, len(both), LOOKUP_CELLS)):
                rows = part.column("row").to_numpy()
                known[rows] += part.column("known").to_numpy()
                sums[rows] += part.column("sums").flatten().to_numpy().reshape(-1, width)
        return known, sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = None, []
        for part in (part for batch in batches for part in _runs(batch, "_place")):
            place = part.column("_place")[0].as_py()
            if place >> 1 != block:
                block, weights = place >> 1, []
            if not place & 1:
                weights.append(weights_of(part))
                continue
            for docs in _slices(part):
                known, sums = summed(docs, weights)
                ends = pa.array(np.arange(len(docs) + 1) * width, pa.int32())
                kept = docs.drop_columns(["_place", "_term", "_scores"])
                columns = [*kept.columns, pa.array(known), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, "_known", "_sums"])

    return run


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with numbers, stored: a retry numbers alike. Scoring by large models needs them and makes
    them itself, for each call; documents to be scored more than once are stored once if they come with them."""
    return docs if ROW in docs.columns else materialize(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _score_joined(docs: DataFrame, models: TopicModels) -> DataFrame:
    """As ``_score_in_row``, for models too large to ship. The weights of the most frequent words,
    as many as may be shipped, are added up from what every task has; those of all other words
    are brought to the documents, block by block.

    Rows are numbered in storage, and a block is a run of them, so that copies of a text or an id do
    not pile up in one. A block sends each of its distinct other words once; they are joined with the
    weights, and the weights found meet the block's documents in a task. No row is shuffled for
    each word of a document, and texts are shuffled once.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(_frequent_arrays(models))
    placed, own = numbered(docs), docs.drop(ROW)
    others = models.weights
    if models.least_strength is not None:
        others = others.where(_strength() < models.least_strength)
    # Several blocks a core, so that none is idle where blocks meet in a partition.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    rows, held = placed.agg(F.count(F.lit(1)), F.sum(F.octet_length("words"))).first()
    wanted = min(BLOCK_BYTES, (held or 0) // (BLOCKS_A_CORE * cores) + 1)
    # A block has a power of two of rows, which leave the number of the stored partition whole.
    bits = min(max(1, wanted * rows // max(held or 0, 1)).bit_length() - 1, 33)
    block = F.shiftright(ROW, bits)
    said = placed.select(block.alias("block"), "model", "words")
    words = materialize(said.mapInArrow(_block_words(shipped), "block bigint, term string"))
    weights = others.select(F.concat_ws("\x01", "model", "word").alias("term"), "scores")
    found = words.join(weights, "term").select(
        (F.col("block") * 2).alias("_place"), F.col("term").alias("_term"), F.col("scores").alias("_scores")
    )
    texts = placed.select(
        *own.columns,
        (block * 2 + 1).alias("_place"),
        F.lit(None).cast("string").alias("_term"),
        # No null lists: at every row Arrow's writer fills in the null lists before it once more.
        F.array().cast("array<double>").alias("_scores"),
    )
    both = texts.unionByName(found, allowMissingColumns=True)
    # A block's rows meet in one task, the weights first.
    dealt = both.repartition(F.expr("_place div 2")).sortWithinPartitions("_place")
    fields = [StructField("_known", LongType()), StructField("_sums", ArrayType(DoubleType()))]
    summed = dealt.mapInArrow(_add_up(shipped, models.width), StructType([*own.schema, *fields]))
    named = summed.join(_few(models.labels), "model", "left")
    best = F.when(F.col("_known") > 0, _posterior(F.col("_known"), F.col("_sums"), F.col("labels")))
    return named.select(*own.columns, F.inline(F.array(best)))


def classify_by(docs: DataFrame, models: "Classifier") -> DataFrame:
    """Score (fid, words, model) rows, each with the model it names, and add cat, prob.
    Null and repeated ids are rows like any other."""
    kept = ["fid", "words", "model", *(c for c in docs.columns if c == ROW)]
    return _with_fallbacks(models.score(docs.select(*kept)).drop(ROW))


def classify_parent(docs: DataFrame, models: "Classifier") -> DataFrame:
    """Parent topic of (fid, words) rows."""
    return conform(classify_by(docs.withColumn("model", F.lit(ALL_MODEL)), models), PREDICTION)


def children_by_parent(parents: DataFrame, models: "Classifier") -> DataFrame:
    """Child topics, with column ``model`` naming the parent, of all documents whose
    parent topic has a model of its own: one keyed pass, not one pass per parent."""
    own = models.named().where(F.col("model") != ALL_MODEL)
    docs = parents.select("fid", "words", F.col("cat").alias("model"))
    return classify_by(keep_listed(docs, own, "model"), models)


def classify_children(parents: DataFrame, models: "Classifier") -> DataFrame:
    """Child topics of the documents of all parents."""
    return conform(children_by_parent(parents, models), PREDICTION)


def classify_child(parents: DataFrame, models: "Classifier", parent: str) -> DataFrame:
    """Child topics of the documents of one parent."""
    return classify_children(parents.where(F.col("cat") == parent), models)


def label_only(predictions: DataFrame) -> DataFrame:
    return predictions.select("fid", "cat")


# Texts to a (label, log probability) each, or None for no answer.
Scorer = Callable[[pd.Series], Sequence[tuple[str, float] | None]]


@dataclass(frozen=True)
class ExternalModels:
    """External classifiers by name, to be used wherever ``TopicModels`` are.

    ``make_scorer`` gets a name and returns a scorer; it runs once per task and name,
    where it can open files sent with ``SparkContext.addFile``. A batch that a scorer
    fails on is given to it text by text, and the texts it fails on are marked unknown.
    """

    make_scorer: Callable[[str], Scorer]
    names: DataFrame

    def named(self) -> DataFrame:
        return self.names.toDF("model")

    def score(self, docs: DataFrame) -> DataFrame:
        make_scorer = self.make_scorer

        def answers(scorer: Scorer, texts: pd.Series) -> list[tuple[str, float] | None]:
            try:
                return [a and (a[0], exp(a[1])) for a in scorer(texts)]
            except Exception:
                if len(texts) == 1:
                    return [(UNKNOWN, PROB_BLANK_OR_ERROR)]
                return [answers(scorer, texts.iloc[i : i + 1])[0] for i in range(len(texts))]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorers: dict[str, Scorer] = {}
            for batch in batches:
                batch = batch.assign(cat=None, prob=None)
                for name, rows in batch[batch["words"].notna()].groupby("model"):
                    if name not in scorers:
                        scorers[name] = make_scorer(name)
                    found = answers(scorers[name], rows["words"])
                    batch.loc[rows.index, "cat"] = [a[0] if a else None for a in found]
                    batch.loc[rows.index, "prob"] = [a[1] if a else None for a in found]
                yield batch.astype({"prob": "float64"})

        named = docs.select("fid", "words", "model")
        return named.mapInPandas(run, "fid bigint, words string, model string, cat string, prob double")


Classifier = TopicModels | ExternalModels


def score_with(docs: DataFrame, make_scorer: Callable[[str], Scorer], model: str = ALL_MODEL) -> DataFrame:
    """Score (fid, words) with an external classifier."""
    spark = docs.sparkSession
    external = ExternalModels(make_scorer, spark.createDataFrame([(model,)], "model string"))
    return conform(classify_by(docs.withColumn("model", F.lit(model)), external), PREDICTION)


def union_predictions(*predictions: DataFrame) -> DataFrame:
    """All (fid, cat, prob) rows of several prediction sets."""
    first, *rest = (p.select("fid", "cat", "prob") for p in predictions)
    for p in rest:
        first = first.unionByName(p)
    return first


def pick_topic(predictions: DataFrame) -> DataFrame:
    """One topic per fid: from short labels to long ones, move on to the next if it
    contains the current label or is at least as probable.

    Only the best probability of each label matters, because equal labels contain
    each other. That leaves at most one row per label to collect. Probabilities are compared
    at six decimals, so that the order in which they were summed up decides nothing.
    """
    best = (
        predictions.where(F.col("cat") != UNKNOWN)
        .groupBy("fid", "cat")
        .agg(F.round(F.max("prob"), 6).alias("prob"))
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.length("cat").alias("len"), "prob", "cat")))

    def choose(current: Column, after: Column) -> Column:
        move = F.contains(after["cat"], current["cat"]) | (after["prob"] >= current["prob"])
        return F.when(move, after).otherwise(current)

    picked = best.groupBy("fid").agg(ordered.alias("topics")).select(
        "fid", F.aggregate("topics", F.get("topics", F.lit(0)), choose)["cat"].alias("cat")
    )
    return conform(picked, FID_CAT)


def editor_topics(articles: DataFrame, reads: DataFrame) -> DataFrame:
    """Topics set by editors, for the articles read."""
    named = articles.where(nonblank_sql(F.col("fcategory")))
    read = reads.select("fid").distinct()
    return conform(keep_listed(named, read, "fid"), EDITOR_TOPICS)


def article_topics(editor: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """(fid, cat) of articles: editor topics, and with predictions the picked ones too."""
    edited = conform(editor.withColumnRenamed("fcategory", "cat"), FID_CAT)
    return edited if predictions is None else edited.unionByName(pick_topic(predictions))
