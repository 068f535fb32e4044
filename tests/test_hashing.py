import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import hashing

MASK = (1 << 64) - 1


def plain_fnv(word):
    h = hashing.FNV_OFFSET
    for byte in word.encode():
        h = ((h ^ byte) * hashing.FNV_PRIME) & MASK
    return h


def plain_simhash(words):
    hashes = [plain_fnv(w) for w in words]
    value = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
    return hashing.signed64(value)


def test_known_fnv_values():
    got = hashing.fnv1a(pa.array(["", "a", "foobar"])).tolist()
    assert got == [0xCBF29CE484222325, 0xAF63DC4C8601EC8C, 0x85944171F73967E8]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(max_size=6), max_size=12), max_size=8))
def test_simhash_lists_equal_the_definition(lists):
    got = hashing.simhash_lists(pa.array(lists, pa.list_(pa.string()))).tolist()
    assert got == [plain_simhash(ws) for ws in lists]


def test_simhash_chunks(monkeypatch):
    lists = [[f"w{i}{j}" for j in range(i)] for i in range(9)]
    monkeypatch.setattr(hashing, "_CHUNK_TOKENS", 7)
    got = hashing.simhash_lists(pa.array(lists, pa.list_(pa.string()))).tolist()
    assert got == [plain_simhash(ws) for ws in lists]


def test_simhash_of_a_slice():
    lists = pa.array([["a"], ["b", "c"], ["汉"]], pa.list_(pa.string()))[1:]
    assert hashing.simhash_lists(lists).tolist() == [plain_simhash(["b", "c"]), plain_simhash(["汉"])]


def test_simhash_column_marks_short_documents(column):
    ws = [None, [], list("abcde"), list("abcdef"), ["好"] * 6]
    assert column(hashing.simhash, ws, "array<string>") == [
        -1, -1, -1, plain_simhash(list("abcdef")), plain_simhash(["好"] * 6),
    ]


def test_block_keys(column):
    h = hashing.signed64(0x1111222233334444)
    assert column(lambda c: F.array(*(hashing.block_key(c, b) for b in range(4))), [h], "bigint") == [
        [0x0000222233334444, 0x1111000033334444, 0x1111222200004444, 0x1111222233330000]
    ]
    with pytest.raises(ValueError):
        hashing.block_shift(4)


def test_within_counts_the_sign_bit(column):
    values = [0, 1, 3, -(1 << 63), -(1 << 63) + 1, None]
    assert column(lambda c: hashing.within(c, F.lit(0).cast("bigint"), 1), values, "bigint") == [
        True, True, False, True, False, None,
    ]


def test_ball(column):
    (ball,) = column(hashing.ball, [5], "bigint")
    assert len(set(ball)) == 65 and all(((b ^ 5) & MASK).bit_count() <= 1 for b in ball)


def test_one_huge_word_does_not_slow_the_others():
    import time

    words = pa.array([f"word{i}" for i in range(200_000)] + ["x" * 1_000_000, "", "y" * 300])
    begin = time.perf_counter()
    got = hashing.fnv1a(words)
    assert time.perf_counter() - begin < 5
    for i in (0, 199_999, 200_000, 200_001, 200_002):
        value = hashing.FNV_OFFSET
        for byte in words[i].as_py().encode():
            value = ((value ^ byte) * hashing.FNV_PRIME) % (1 << 64)
        assert int(got[i]) == value
