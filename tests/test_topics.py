import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.operators import joins, topics

LINES = [
    ("all", "sport", "ball goal ball"),
    ("all", "sport", "goal team"),
    ("all", "news", "vote law vote"),
    ("all", "empty", ""),
    ("sport", "sport_foot", "goal ball"),
    ("sport", "sport_golf", "hole club"),
]


@pytest.fixture(scope="module")
def models(spark):
    return topics.fit_topics(spark.createDataFrame(LINES, "model string, label string, text string"))


def plain_bayes(model, text):
    lines = [(label, words.split()) for m, label, words in LINES if m == model]
    vocabulary = {w for _, ws in lines for w in ws}
    words = [w for w in text.split() if w in vocabulary]
    if not words:
        return None
    scores = {}
    for label in sorted({lb for lb, _ in lines}):
        own = [ws for lb, ws in lines if lb == label]
        flat = [w for ws in own for w in ws]
        scores[label] = math.log(len(own) / len(lines)) + sum(
            math.log((flat.count(w) + 1) / (len(flat) + len(vocabulary))) for w in words
        )
    best = max(scores.values())
    cat = min(lb for lb, s in scores.items() if s == best)
    return cat, 1 / sum(math.exp(s - best) for s in scores.values())


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "fid bigint, words string")


TEXTS = ["goal", "vote vote team", "ball unseen law law law", "hole", "unseen", " ", None, ""]


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_rows_of_null_and_repeated_ids_are_scored_alone(spark, models, max_bytes):
    models = topics.topic_models(models.weights, models.labels, max_bytes)
    rows = [(None, "goal goal"), (None, "law"), (0, "law law law"), (5, "goal"), (5, "law law"), (5, None)]
    docs = spark.createDataFrame(rows, "fid bigint, words string")
    got = {(r.fid, r.words): (r.cat, r.prob) for r in topics.classify_parent(docs, models).collect()}
    assert set(got) == set(rows)
    for (_, words), (cat, prob) in got.items():
        wanted = plain_bayes("all", words) if words else ("unknow", -1.0)
        assert (cat, prob) == (wanted[0], pytest.approx(wanted[1]))


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_parent_topics_equal_plain_bayes(spark, models, max_bytes):
    models = topics.topic_models(models.weights, models.labels, max_bytes)
    got = {r.fid: (r.words, r.cat, r.prob) for r in topics.classify_parent(docs(spark, TEXTS), models).collect()}
    assert len(got) == len(TEXTS)
    for fid, text in enumerate(TEXTS):
        wanted = plain_bayes("all", text or "")
        if wanted is None:
            wanted = ("unknow", -1.0 if not (text or "").strip() else -3.0)
        assert got[fid] == (text, wanted[0], pytest.approx(wanted[1], abs=1e-9))


@pytest.mark.parametrize("block_bytes,block_cells", [(1, 10), (200, 1 << 20), (1 << 20, 3)])
def test_blocks_of_weights_and_words_change_nothing(spark, models, monkeypatch, block_bytes, block_cells):
    monkeypatch.setattr(topics, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(topics, "BLOCK_CELLS", block_cells)
    large = topics.topic_models(models.weights, models.labels, 0)
    vocabulary = [r.word for r in models.weights.select("word").distinct().collect()]
    names = [r.model for r in models.labels.collect()]
    texts = [" ".join(vocabulary[(i * k) % len(vocabulary)] for k in range(i % 9)) + "  odd " for i in range(60)]
    rows = [(i, t, names[i % len(names)]) for i, t in enumerate([*texts, None, "", "x x x"])] + [(0, texts[3], "no such")]
    docs = spark.createDataFrame(rows, "fid long, words string, model string").repartition(3)

    def scored(used):
        return sorted((r.fid, r.model, r.cat, round(r.prob, 9)) for r in topics.classify_by(docs, used).collect())

    assert scored(large) == scored(models)


def test_words_of_many_batches_are_looked_up_at_once(monkeypatch):
    rows = pa.schema([("place", "int64"), ("term", "string"), ("scores", pa.list_(pa.float64())), ("row", "int64"), ("model", "string"), ("n", "int64")])

    def batch(place, scores):
        return pa.RecordBatch.from_pylist(
            [{"place": place, "term": t, "scores": scores, "row": 7, "model": "m", "n": 2} for t in "ab"], rows
        )

    looked_up = []
    index_in = topics.pc.index_in
    monkeypatch.setattr(topics.pc, "index_in", lambda x, value_set: looked_up.append(len(x)) or index_in(x, value_set=value_set))
    batches = [batch(2, [0.5]), *[batch(3, [])] * 50, batch(4, [0.25]), *[batch(5, [])] * 50]
    found = [r for b in topics._block_sums(1)(iter(batches)) for r in b.to_pylist()]
    assert looked_up == [100, 100]
    assert found == [{"row": 7, "own": "m", "known": 200, "sums": [s]} for s in (100.0, 50.0)]
    monkeypatch.setattr(topics, "LOOKUP_CELLS", 4)
    parts = [r for b in topics._block_sums(1)(iter(batches)) for r in b.to_pylist()]
    assert len(parts) == 50 and sum(r["sums"][0] for r in parts) == 150.0


def test_cells_hold_no_null_lists(spark, models, monkeypatch):
    """A writer of Arrow batches goes over all null lists of a batch again at each of its rows."""
    block_sums = topics._block_sums

    def strict(width):
        run = block_sums(width)

        def checked(batches):
            for batch in batches:
                assert not batch.column("scores").null_count
                yield from run(iter([batch]))

        return checked

    monkeypatch.setattr(topics, "_block_sums", strict)
    large = topics.topic_models(models.weights, models.labels, 0)
    assert topics.classify_parent(docs(spark, TEXTS), large).count() == len(TEXTS)


@pytest.mark.parametrize("share", [0.5, 0.7, 0.99])
def test_frequent_words_stay_where_the_documents_are(spark, models, monkeypatch, share):
    part = topics.topic_models(models.weights, models.labels, int(share * joins.estimated_bytes(models.weights)))
    assert not part.small and part.least_strength is not None and part.rest_bytes > 0
    strong = models.weights.where(topics._strength() >= part.least_strength).select("model", "word").collect()
    shipped = {f"{r.model}\x01{r.word}" for r in strong}
    assert "all\x01ball" in shipped and len(shipped) < models.weights.count()
    block_sums = topics._block_sums

    def strict(width):
        run = block_sums(width)

        def checked(batches):
            for batch in batches:
                assert not shipped & set(batch.column("term").to_pylist())
                yield from run(iter([batch]))

        return checked

    names = [r.model for r in models.labels.collect()]
    texts = [*TEXTS, "goal goal ball hole  club zzz", "law vote ball ball goal team", "club law"]
    rows = [(i, t, name) for i, t in enumerate(texts) for name in [*names, "no such"]]
    docs = spark.createDataFrame(rows, "fid long, words string, model string").repartition(3)

    def scored(used):
        return sorted((r.fid, r.model, r.cat, round(r.prob, 9)) for r in topics.classify_by(docs, used).collect())

    wanted = scored(models)
    monkeypatch.setattr(topics, "_block_sums", strict)
    assert scored(part) == wanted


def test_rows_of_one_model_do_not_meet_in_one_task(spark, models):
    large = topics.topic_models(models.weights, models.labels, 0)
    for found in (topics.classify_parent(docs(spark, TEXTS), large), topics.weight_rows(models)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert "hashpartitioning(own" not in plan and "hashpartitioning(model" not in plan


def test_words_are_counted_once_a_batch():
    rows = [("m", "a", "x y x"), ("m", "a", "x  "), ("m", None, "y"), ("n", "a", ""), ("m", "a", "z")]
    batch = pa.RecordBatch.from_pylist([dict(zip(("model", "label", "text"), r)) for r in rows])
    counts = [c for b in topics._batch_counts(iter([batch, batch.slice(1, 1), batch.slice(0, 0)])) for c in b.to_pylist()]
    first = [("m", "a", "x", 3), ("m", "a", "y", 1), ("m", "a", "z", 1), ("m", "a", None, 3)]
    first += [("m", None, "y", 1), ("m", None, None, 1), ("n", "a", None, 1)]
    assert sorted(map(str, (tuple(c.values()) for c in counts))) == sorted(
        map(str, [*first, ("m", "a", "x", 1), ("m", "a", None, 1)])
    )


def test_lines_without_text_are_not_counted(spark):
    lines = spark.createDataFrame([("m", "a", None), ("m", "a", ""), ("m", None, "x x")], "model string, label string, text string")
    got = {tuple(r) for r in topics.word_counts(lines).collect()}
    assert got == {("m", "a", None, 1), ("m", None, None, 1), ("m", None, "x", 2)}


def test_children_are_scored_by_their_parents_model(spark, models):
    parents = spark.createDataFrame(
        [(1, "goal", "sport"), (2, "club hole", "sport"), (3, "vote", "news"), (4, "vote", "sport"), (5, "", "sport")],
        "fid bigint, words string, cat string",
    )
    got = {r.fid: (r.cat, r.prob) for r in topics.classify_children(parents, models).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1] == ("sport_foot", pytest.approx(plain_bayes("sport", "goal")[1]))
    assert got[2][0] == "sport_golf"
    assert got[4] == ("sport_other", -4.0) and got[5] == ("unknow", -1.0)
    assert topics.classify_child(parents, models, "news").count() == 0


@pytest.fixture
def make_scorer():
    def make(name):
        def score(texts):
            if any("boom" in text for text in texts):
                raise RuntimeError(name)
            return [None if "none" in t else ("__label__" + (t.split() or ["x"])[0], math.log(0.25)) for t in texts]

        return score

    return make


def test_external_scorer_and_its_fallbacks(spark, make_scorer):
    texts = ["a b", "none", "boom", " ", None]
    parent = {r.fid: (r.cat, r.prob) for r in topics.score_with(docs(spark, texts), make_scorer).collect()}
    assert parent == {
        0: ("a", 0.25), 1: ("unknow", -3.0), 2: ("unknow", -1.0), 3: ("unknow", -1.0), 4: ("unknow", -1.0),
    }
    child = {r.fid: r.cat for r in topics.score_with(docs(spark, texts), make_scorer, "p").collect()}
    assert child[1] == "p_other" and child[2] == "unknow"


def plain_pick(rows):
    rows = sorted((len(c), p, c) for c, p in rows if c != "unknow")
    if not rows:
        return None
    current = rows[0]
    for row in rows[1:]:
        if current[2] in row[2] or row[1] >= current[1]:
            current = row
    return current[2]


def test_pick_topic_equals_the_fold(spark):
    rng = random.Random(4)
    labels = ["a", "b", "ab", "a_c", "b_cd", "unknow", "zzzz"]
    rows = [(rng.randrange(120), rng.choice(labels), rng.choice([0.1, 0.5, 0.9, -4.0])) for _ in range(600)]
    df = spark.createDataFrame(rows, "fid bigint, cat string, prob double").repartition(5)
    got = {r.fid: r.cat for r in topics.pick_topic(df).collect()}
    wanted = {f: plain_pick([(c, p) for g, c, p in rows if g == f]) for f in {r[0] for r in rows}}
    assert got == {f: c for f, c in wanted.items() if c}


def test_pick_topic_examples(spark):
    rows = [
        (1, "sport", 0.9), (1, "sport_golf", 0.2),  # contains the shorter one
        (2, "sport", 0.9), (2, "politics", 0.2),
        (3, "unknow", -1.0),
        (4, "aa", 0.3), (4, "bb", 0.3),
    ]
    df = spark.createDataFrame(rows, "fid bigint, cat string, prob double")
    assert {r.fid: r.cat for r in topics.pick_topic(df).collect()} == {1: "sport_golf", 2: "sport", 4: "bb"}


def test_editor_and_article_topics(spark):
    articles = spark.createDataFrame(
        [(1, "a"), (2, "ab"), (3, None), (4, "cd"), (5, " x ")], "fid bigint, fcategory string"
    )
    reads = spark.createDataFrame([("u", 1), ("u", 2), ("v", 2), ("v", 3), ("v", 5)], "imei string, fid bigint")
    editor = topics.editor_topics(articles, reads)
    assert [tuple(r) for r in editor.collect()] == [(2, "ab")]
    preds = spark.createDataFrame([(9, "x", 0.5), (2, "y", 0.4)], "fid bigint, cat string, prob double")
    both = topics.article_topics(editor, preds)
    assert sorted(map(tuple, both.collect())) == [(2, "ab"), (2, "y"), (9, "x")]
    assert topics.article_topics(editor).count() == 1
    assert topics.label_only(preds).columns == ["fid", "cat"]
    assert topics.union_predictions(preds, preds).select(F.count("fid")).first()[0] == 4
