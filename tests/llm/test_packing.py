"""Packing against the tokenizer itself, and what sequences must hold."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagemill.llm import packing
from pagemill.llm.queries import PACKED_TOKENIZER, queries

MODEL = packing.read_model(public_tokenizers.path(PACKED_TOKENIZER))
ODD = [
    "", "don't I'LL it's 'S ,'s '' a'b", "T̈x ẗ École é,", "≠ a≠b", "İstanbul Σσς Σ. İ",
    "x y z​w\x1cq\x0b\x0cr\x85s", "a\x00b\x7f c", "12,345.67 1a2 <|endoftext|>", "日本語 テスト",
    "A" * 50 + "́", "word,word;(x)'t' rock'n'roll", "각 각", "😀😀 a😀b,😀", "x" * 30_000,
]


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_str(MODEL)
    plain.encode_special_tokens = True
    return plain


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(1)
    letters = "aAtTsS'.,=<| \n\t1̸̈́éİ\x1c　日😀"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    ids, starts = packing.Encoder(MODEL).encode(pa.array(texts), 2)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def check(rows, wanted, capacity):
    """``wanted`` are the ids of every document, by its place in doc_id order."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(wanted)
    for doc, ids in wanted.items():
        mine = sorted(pieces[doc], key=lambda r: r.start)
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine]).tolist()[:-1]]
        assert [i for r in mine for i in np.frombuffer(r.packed, "<u4").tolist()] == ids
        assert {r.doc_tokens for r in mine} == {len(ids)}
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own]).tolist()[:-1]]
        used = sum(r.length for r in own)
        assert used == capacity or used < capacity and used & (used - 1) == 0
        assert all(r.length == len(r.packed) // 4 > 0 for r in own)


def test_pieces_cover_documents_without_padding(spark, tokenizer):
    rng = random.Random(2)
    texts = [*ODD, None, None, "word " * 9000, *(" ".join(["a b"] * rng.randint(0, 300)) for _ in range(300))]
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string"
    ).repartition(3)
    wanted = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    check(packing.pack(docs, MODEL).collect(), wanted, 4096)
    check(packing.pack(docs, MODEL, capacity=64, pool_tokens=5000).collect(), wanted, 64)


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs.coalesce(1), MODEL).collect()
    assert sorted(((r.doc_id, r.doc_tokens) for r in rows), key=repr) == [(1, 3), (1, 3), (None, 1), (None, 2)]
    assert packing.pack(docs.where("false"), MODEL).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, MODEL, capacity=100)


def plain_assignment(lengths, capacity):
    """The same rule, one document and sequence at a time."""
    full = sum(n // capacity for n in lengths)
    rest = sum(n % capacity for n in lengths)
    sizes = [capacity] * (rest // capacity)
    sizes += [p for p in (1 << i for i in reversed(range(12))) if (rest % capacity) & p]
    members = [[] for _ in sizes]
    for doc in sorted(range(len(lengths)), key=lambda d: (-(lengths[d] % capacity), d)):
        left = lengths[doc] % capacity
        while left:
            room = [s - sum(m for _, m in own) for s, own in zip(sizes, members)]
            spent = [sum(packing.LINEAR * m + m * m for _, m in own) for own in members]
            fitting = [i for i in range(len(sizes)) if room[i] >= left]
            at = min(fitting, key=lambda i: (spent[i], i)) if fitting else max(range(len(sizes)), key=lambda i: (room[i], -i))
            part = min(left, room[at])
            members[at].append((doc, part))
            left -= part
    return full, members


def test_assignment_equals_plain_one():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 200):
        lengths = np.concatenate([rng.integers(1, 300, n), rng.integers(1, 40, n)])
        full, members = plain_assignment(lengths.tolist(), 128)
        rows = packing.assign(lengths, 128)
        got = [[(d, m) for d, _, m, s, _ in rows.tolist() if s == full + i] for i in range(len(members))]
        assert got == members and (rows[:, 3] < full).sum() == full


def test_costs_are_balanced():
    rng = np.random.default_rng(4)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 4000).astype(int) + 1, 4000)
    rows = packing.assign(lengths, 4096)
    size = np.bincount(rows[:, 3], rows[:, 2])
    spent = np.bincount(rows[:, 3], packing.cost(rows[:, 2]))[size == 4096]
    assert spent.max() <= 1.1 * spent.mean()
    assert len(rows) < 1.1 * len(lengths)


def test_query_digests(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in texts.items()}
    rows = queries()["op12_cost_packing"](spark, sf).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
