"""Tokenizer, fingerprints and language model against plain versions of them."""

import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from pagemill.llm import bpe, chars, fingerprints, langid
from pagemill.llm.queries import TOKENIZER, vocabulary

ODD = [None, "", " ", "'s", "x's 'll've", "  x", "a  \n b ", "aaaa" * 2000, "1" * 3000, "' " * 300, "a\u0085b\u001cc", "日本é " * 50]


def brute_encoding():
    lines = open(public_tokenizers.path(TOKENIZER), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    return vocabulary()


def test_bpe_equals_the_library(words):
    encoding, rng = brute_encoding(), random.Random(0)
    alphabet = "ab'sdmtlrve 12.,!\n\t  é日'\u001c\u0085x"
    texts = ODD[1:] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)]
    got = bpe.encode_texts(pa.array(texts), words)
    assert got.field("ids").to_pylist() == [encoding.encode_ordinary(t) for t in texts]
    for text, row in zip(texts, got.to_pylist()):
        lengths = [len(encoding.decode_single_token_bytes(i)) for i in row["ids"]]
        assert row["starts"] == list(np.cumsum([0, *lengths])[:-1]) and sum(lengths) == len(text.encode())


def test_every_code_point_has_the_class_of_the_library(words):
    encoding = brute_encoding()
    texts = [f"a{chr(c)}a 1{chr(c)}1 {chr(c)} " for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert bpe.encode_texts(pa.array(texts), words).field("ids").to_pylist() == [encoding.encode_ordinary(t) for t in texts]


def test_bpe_frame_round_trip(spark, words):
    rows = [(i, t, "kept") for i, t in enumerate(ODD)] + [(0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    coded = bpe.encode(docs, words, parts=("ids", "starts", "packed", "decoded"))
    for row in coded.collect():
        text = (row.text or "").encode()
        assert row.decoded == text and row.packed == np.array(row.ids, "<u4").tobytes()
    again = bpe.decode(coded.select("text", "ids"), words)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again.collect())
    assert bpe.encode(docs.limit(0), words).count() == 0


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_likeness_is_the_plain_edit_distance():
    rng = random.Random(1)
    a = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 65))) for _ in range(80)] + ["a" * 64]
    b = a[::-1]
    got = fingerprints._common_lengths(a, b)
    assert got.tolist() == [plain_common(x, y) for x, y in zip(a, b)]
    assert fingerprints.likeness(["3::", "3:ab:c", "3:ab:c"], ["3::", "3:ab:c", "96:ab:c"]).tolist() == [1.0, 1.0, 0.0]


def test_fingerprint_by_a_plain_roll():
    data = np.random.default_rng(0).integers(0, 255, 5000).astype(np.uint8)
    rolled = fingerprints._rolling(data)
    for i in (0, 3, 100, 4999):
        window = data[max(0, i - fingerprints.WINDOW + 1) : i + 1]
        padded = np.concatenate([np.zeros(5000 - len(window), np.uint8), window])
        assert fingerprints._rolling(window)[-1] == rolled[i], padded[-1]
    size, one, two = fingerprints.fingerprint(data).split(":")
    ends = np.flatnonzero(rolled % np.uint64(int(size)) == np.uint64(int(size) - 1))
    assert len(one) == min(64, len(ends) + (ends[-1] < 4999)) and len(two) <= 64


def test_edit_probe_against_plain_python(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ab cé日") for _ in range(rng.randrange(300)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "x" * 50_000)]
    got = {r.doc_id: r for r in fingerprints.edit_probe(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        new = fingerprints.edited(text or "", following or "")
        row = got[doc_id]
        assert row.n_chars == len(text or "") and row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        prints = [fingerprints._of([t])[0] for t in (text or "", new, following or "")]
        assert [row.fingerprint, row.edited_fingerprint] == prints[:2]
        assert [row.near_edited, row.near_next] == [fingerprints.likeness(prints[:1], [p])[0] for p in prints[1:]]


def test_edit_probe_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "k"), (None, "x y", "k"), (2, "x y", "k"), (2, "x y", "k")], "doc_id long, text string, part string")
    assert fingerprints.edit_probe(docs).count() == 4
    assert fingerprints.edit_probe(docs.limit(0)).count() == 0
    only = fingerprints.edit_probe(docs.where("doc_id = 1")).first()
    assert (only.near_edited, only.near_next) == (1.0, 1.0)


def test_language_model_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    said = langid.predict(docs, model).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in said)
    out = [r for r in said if r.out]
    assert sum(r.lang == r.lang_pred for r in out) > 0.98 * len(out)
    assert all(0 < r.score <= 1 and r.lang_pred in model.languages for r in said)


def test_language_model_of_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", 1), (None, "abc abc", "en", 1), (3, "...", "fr", 1), (4, "hello", None, 1)],
        "doc_id long, text string, lang string, score int",
    )
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs.drop("score"), none).collect()} == {"und"}
    one = langid.fit(spark.createDataFrame([(1, "hello there", "en")], "doc_id long, text string, lang string"))
    said = {r.doc_id: r.lang_pred for r in langid.predict(docs.drop("score"), one).collect()}
    assert said == {1: "und", None: "en", 3: "und", 4: "en"}
    assert langid.predict(docs.limit(0), one).count() == 0


def test_training_rows_stay_arrays_in_order():
    lists = [[3, 70_000], [], [2, 9], [3], [2, 300]]
    table = pa.table(
        {
            "lang": ["b", "a", "a", "b", "a"],
            "_order": [5, -9, -1, 5, -1],
            "buckets": pa.chunked_array([pa.array(lists[:2], pa.list_(pa.int32())), pa.array(lists[2:], pa.list_(pa.int32()))]),
            "counts": pa.array(lists, pa.list_(pa.int32())),
        }
    )
    got = [(lang, b.tolist(), c.tolist()) for lang, b, c in langid.in_order(table)]
    assert got == [("a", [2, 9], [2, 9]), ("a", [2, 300], [2, 300]), ("b", [3], [3]), ("b", [3, 70_000], [3, 70_000])]
    assert langid.in_order(table.slice(0, 0)) == []
    values = pa.array(np.arange(1000, 1_001_000, dtype=np.int32))
    large = pa.ListArray.from_arrays(pa.array(range(0, 1_000_001, 1000), pa.int32()), values)
    table = pa.table({"lang": ["a"] * 1000, "_order": range(1000), "buckets": large, "counts": large})
    tracemalloc.start()
    assert len(langid.in_order(table)) == 1000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * table.nbytes


def test_training_rows_do_not_reach_the_driver(spark, monkeypatch):
    rows = [(i, f"{'the cat sat' if i % 2 else 'der hund lief'} {i}", "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, None, "en"), (61, "12 34", "de")], "doc_id long, text string, lang string")
    fetched, fetch = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: fetched.append(df.columns) or fetch(df))
    model = langid.fit(docs)
    assert fetched and not any("buckets" in columns for columns in fetched)
    assert model.languages == ["de", "en"] and model.weights.shape == (langid.BUCKETS, 2)
    assert {(r.doc_id % 2, r.lang_pred) for r in langid.predict(docs.where("doc_id < 60"), model).collect()} == {(0, "de"), (1, "en")}
    silent = langid.fit(docs.where("doc_id = 61"))
    assert silent.languages == [] and silent.weights.shape == (langid.BUCKETS, 0)


def test_classes_take_little_memory():
    tracemalloc.start()
    table = chars.classes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(table)
    for c in ["a", "é", "本", "٣", " ", "\t", "\u2028", "-", "\ud7ff", "\ue000", "\U0001d400", "\U0010ffff"]:
        letter, number = regex.match(r"\p{L}", c), regex.match(r"\p{N}", c)
        blank = chars.SPACE if c == " " else chars.BLANK if ord(c) in chars.BLANKS else chars.OTHER
        assert table[ord(c)] == (chars.LETTER if letter else chars.NUMBER if number else blank)
    assert not table[0xD800:0xE000].any()
