"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, learned by follow-the-regularised-leader with elastic-net
penalties, its probabilities calibrated by a temperature.

Document frequencies come from all documents learned from. The regression itself is
fitted on a bounded sample of them, at most ``PER_LANGUAGE`` per language and
``SAMPLE`` in all, the first in a seeded order; every document is then predicted.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pagemill.llm import chars
from pagemill.llm.names import unused
from pagemill.llm.shingles import mix64

BUCKETS = 1 << 14
PER_LANGUAGE = 400
SAMPLE = 20_000
SALTS = 64
EPOCHS = 4
# Step size and its offset, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
# Every such document of the sample calibrates instead of training.
CALIBRATE_EVERY = 5
UNDETERMINED = "und"
HELD_OUT = 2
SEED = 7


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning. A null id is neither."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def gram_buckets(texts: pa.Array, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Buckets of the n-grams of one to three characters of each text, in order, and
    how often each occurs; None for a text without letters. All but letters are one
    mark, and n-grams that start with two marks are left out."""
    data, bounds = chars.raw(pc.utf8_lower(texts))
    points, byte_at = chars.code_points(data)
    begin = np.searchsorted(byte_at, bounds)
    letter = classes[points] == chars.LETTER
    letters = np.append(0, np.cumsum(letter))
    c = np.where(letter, points, 32).astype(np.uint64)
    one, two, three = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    uni = c * one
    bi = uni[:-1] + c[1:] * two
    tri = bi[:-1] + c[2:] * three
    starts_inside = letter[:-1] | letter[1:]
    grams = [(mix64(g + np.uint64(n)) >> shift).astype(np.int32) for n, g in enumerate((uni, bi, tri))]
    for start, end in zip(begin, begin[1:]):
        if letters[start] == letters[end]:
            yield None
            continue
        inner = starts_inside[start : max(start, end - 1)]
        own = np.concatenate([
            grams[0][start:end][letter[start:end]],
            grams[1][start : max(start, end - 1)][inner],
            grams[2][start : max(start, end - 2)][inner[: max(0, end - start - 2)]],
        ])
        counts = np.bincount(own, minlength=BUCKETS)
        found = np.flatnonzero(counts)
        yield found, counts[found]


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of a text's buckets, of length one."""
    x = np.log1p(counts) * idf[found]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def parts(self) -> dict:
        """As plain values, to be broadcast."""
        return self.__dict__ | {"classes": chars.classes()}


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that follow the regularised leader, from its sums."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias for ``k`` languages from (buckets, values, language) rows."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    for _ in range(EPOCHS):
        for buckets, values, language in rows:
            at = np.append(buckets, BUCKETS)
            x = np.append(values, 1.0)
            w = _leader(z[at], n[at])
            error = softmax(x @ w)
            error[language] -= 1
            g = np.outer(x, error)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = _leader(z, n)
    return w[:-1], w[-1]


def fit_temperature(scores: list[np.ndarray], wanted: list[int]) -> float:
    """The temperature that makes the wanted languages most likely, by golden section.

    One document in n + 2 is taken to be wrong, so that n right answers do not call
    for a temperature of zero.
    """
    if not scores or len(scores[0]) < 2:
        return 1.0
    matrix, wrong = np.array(scores), 1 / (len(scores) + 2)
    targets = np.full(matrix.shape, wrong / (matrix.shape[1] - 1))
    targets[np.arange(len(wanted)), wanted] = 1 - wrong

    def loss(log_t: float) -> float:
        s = matrix / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return -float((targets * (s - np.log(np.exp(s).sum(axis=1, keepdims=True)))).sum())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def inverse_frequencies(docs: DataFrame, classes) -> np.ndarray:
    """Smoothed inverse document frequency of every bucket over all ``docs``. Each
    task counts its documents; no more than one row per bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in chars.chunks(batch.column(0)):
                for row in gram_buckets(part, classes.value):
                    if row is not None:
                        total += 1
                        df[row[0]] += 1
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(df[found], total))], ["bucket", "n"]
        )

    rows = docs.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    df = np.zeros(BUCKETS)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.log((1 + n[bucket < 0].sum()) / (1 + df)) + 1


def in_order(features: pa.Table) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, counts) of the rows that have buckets, by order, language and values.
    The lists stay arrays: as Python integers they would take ten times the memory."""
    orders, names = features["_order"].to_numpy(), features["lang"].to_pylist()
    lists = [features[c].combine_chunks() for c in ("buckets", "counts")]
    flat = [x.flatten().to_numpy() for x in lists]
    ends = np.append(0, np.cumsum(lists[0].value_lengths().to_numpy()))
    own = [[x[i:j] for x in flat] for i, j in zip(ends, ends[1:])]

    def key(i: int) -> tuple:
        # Big-endian bytes are in the order of the values, which are not negative.
        return orders[i], names[i], *(x.astype(f">i{x.itemsize}").tobytes() for x in own[i])

    return [(names[i], *own[i]) for i in sorted((i for i in range(len(own)) if len(own[i][0])), key=key)]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, seed: int = SEED) -> Model:
    """Learn from the (doc_id, text, lang) rows that are not held out and have a
    language, text and id. Without any, no language is learned."""
    classes = docs.sparkSession.sparkContext.broadcast(chars.classes())
    usable = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    known = docs.where(usable).select("lang", "doc_id", chars.text_or_empty(F.col("text")).alias("text"))
    idf = inverse_frequencies(known.select("text"), classes)

    order = F.xxhash64(F.lit(seed), "doc_id")
    # A common language is cut to the first of each salt before it comes together.
    by_salt = Window.partitionBy("lang", "_salt").orderBy("_order", "doc_id")
    by_language = Window.partitionBy("lang").orderBy("_order", "doc_id")
    chosen = (
        known.select("lang", "doc_id")
        .distinct()
        .withColumn("_order", order)
        .withColumn("_salt", F.pmod("_order", F.lit(SALTS)))
        .withColumn("_place", F.row_number().over(by_salt))
        .where(F.col("_place") <= per_language)
        .withColumn("_place", F.row_number().over(by_language))
        .where(F.col("_place") <= per_language)
        .orderBy("_place", "lang")
        .limit(sample)
        .select("lang", "doc_id", "_order")
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for part in chars.chunks(batch.column("text")) for r in gram_buckets(part, classes.value)]
            empty = np.zeros(0, np.int32)
            buckets = [empty if r is None else r[0] for r in rows]
            counts = [empty if r is None else r[1] for r in rows]
            lists = [pa.array([a.astype(np.int32) for a in x], pa.list_(pa.int32())) for x in (buckets, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("_order"), *lists], ["lang", "_order", "buckets", "counts"])

    # ``sample`` bounds the rows that are broadcast.
    texts = known.join(F.broadcast(chosen), ["lang", "doc_id"]).dropDuplicates(["lang", "doc_id"])
    rows = texts.select("lang", "_order", "text").mapInArrow(
        features, "lang string, _order long, buckets array<int>, counts array<int>"
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            m = learned(in_order(pa.Table.from_batches(held)), idf)
            numbers = [pa.array([x], pa.list_(pa.float64())) for x in (m.weights.ravel(), m.bias)]
            columns = [pa.array([m.languages], pa.list_(pa.string())), *numbers, pa.array([float(m.temperature)])]
            yield pa.RecordBatch.from_arrays(columns, ["languages", "weights", "bias", "temperature"])

    # The sample meets in a task; the driver gets the weights only.
    parts = rows.repartition(1).mapInArrow(
        learn, "languages array<string>, weights array<double>, bias array<double>, temperature double"
    ).toArrow()
    if not len(parts):
        return learned([], idf)
    languages = parts["languages"][0].as_py()
    weights, bias = (parts[c].combine_chunks().flatten().to_numpy() for c in ("weights", "bias"))
    return Model(languages, weights.reshape(BUCKETS, len(languages)), bias, idf, parts["temperature"][0].as_py())


def learned(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """The model of (language, buckets, counts) rows, in their order."""
    languages = sorted({lang for lang, _, _ in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), idf)
    data = [(b, weighted(b, c, idf), languages.index(lang)) for lang, b, c in rows]
    calibration = data[::CALIBRATE_EVERY] if len(data) >= 2 * CALIBRATE_EVERY else []
    training = [r for i, r in enumerate(data) if not calibration or i % CALIBRATE_EVERY]
    weights, bias = fit_weights(training, len(languages))
    scores = [x @ weights[b] + bias for b, x, _ in calibration]
    return Model(languages, weights, bias, idf, fit_temperature(scores, [y for *_, y in calibration]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, its calibrated probability; no shuffle.
    Columns of these names are replaced, all others stay.

    A null text and a text without a letter are ``und`` with score 0, as is every text
    if no language was learned. Of equal scores the first language by name wins.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    @arrow_udf("struct<lang:string,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        m = shipped.value
        names, probabilities = [], []
        for part in chars.chunks(texts):
            for row in gram_buckets(part, m["classes"]):
                if row is None or not m["languages"]:
                    names.append(UNDETERMINED)
                    probabilities.append(0.0)
                    continue
                x = weighted(*row, m["idf"])
                p = softmax((x @ m["weights"][row[0]] + m["bias"]) / m["temperature"])
                best = int(p.argmax())
                names.append(m["languages"][best])
                probabilities.append(float(p[best]))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(probabilities, pa.float64())], ["lang", "score"])

    (said,) = unused(docs, "_said")
    predicted = docs.withColumn(said, run(chars.text_or_empty(F.col("text"))))
    return predicted.withColumns({"lang_pred": F.col(f"{said}.lang"), "score": F.col(f"{said}.score")}).drop(said)
