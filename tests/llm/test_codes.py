"""Vector codes against plain integers of any size."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import codes


def test_limbs_give_their_values_back():
    rng = np.random.default_rng(1)
    for top in (1, 1 << 10, 1 << 25, 1 << 40, 1 << 62):
        values = rng.integers(-top, top, (50, 3), endpoint=True)
        for bits in (5, 13, 25):
            parts = codes.limbs(values, bits)
            assert sum(int(1) * p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)).tolist() == values.tolist()
            assert max(np.abs(p).max() for p in parts) <= 1 << bits


@pytest.mark.parametrize("width", [1, 2, 8, 100, 1000])
def test_products_are_exact(width):
    rng = np.random.default_rng(width)
    assert width * (1 << 2 * codes.limb_bits(width)) <= 1 << 53
    for top in (50, 1 << 20, codes.largest_component(width, 8)):
        a, b = rng.integers(-top, top, (2, 20, width), endpoint=True), rng.integers(-top, top, (2, 5, width), endpoint=True)
        a[0, 0], b[0, 0] = top, -top
        wanted = [[[sum(x * y for x, y in zip(u, v)) for v in q] for u in p] for p, q in zip(a.tolist(), b.tolist())]
        assert codes.dots(a, b).tolist() == wanted


def plain(rows, scale=4096, parts=8, entries=16, rounds=6):
    """(id, label, codes, error) of each row and the codebooks, with Python's integers."""
    kept = []
    for id_, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            ints = [math.floor(x * scale) for x in vector]
            w = len(ints) // parts
            kept.append((id_, label, [ints[i * w : (i + 1) * w] for i in range(parts)]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    books = [[r[2][p] for r in kept[:entries]] for p in range(parts)]

    def assigned(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            near = [assigned(p, r[2][p])[1] for r in kept]
            book = []
            for e, old in enumerate(books[p]):
                mine = [r[2][p] for r, n in zip(kept, near) if n == e]
                book.append([sum(c) // len(mine) for c in zip(*mine)] if mine else old)
            new.append(book)
        books = new
    out = []
    for id_, label, x in kept:
        found = [assigned(p, x[p]) for p in range(parts)]
        out.append((id_, label, bytes(e for _, e in found), sum(d for d, _ in found)))
    return out, books


def compare(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    df = df.withColumn("id", F.lit("x")).withColumn("codes", F.lit(1))  # names of the result
    coded, books = codes.compress(df, **options)
    wanted, wanted_books = plain(rows, **{k: v for k, v in options.items()})
    got = [(r.id, r.label, bytes(r.codes), r.error) for r in coded.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert (books or [[]] * 8) == wanted_books
    return coded


def test_equals_plain_integers(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(0, 0.3, 16).tolist(), int(i) % 3) for i in rng.permutation(120)]
    compare(spark, rows)
    compare(spark, rows, entries=5, rounds=2)


def test_large_components_take_several_limbs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-46_000, 46_000, 64) + rng.random(64)).tolist(), None) for i in range(60)]
    compare(spark, rows)


def test_nulls_ties_repeats_and_what_is_left_out(spark):
    one, two = [0.5] * 8, [-0.25] * 8
    rows = [
        (3, one, 1), (3, one, 1), (3, two, None), (None, two, None), (1, None, 1), (2, [0.1] * 7 + [None], 1),
        (4, [0.1] * 7 + [float("nan")], 1), (5, [0.1] * 7 + [float("inf")], None), (6, [0.0] * 8, 2),
        (7, [-0.00001] * 8, 2), (8, [0.125] * 8, None),
    ]
    coded = compare(spark, rows)
    sums = {r.label: r.label_error for r in codes.with_label_errors(coded).collect()}
    wanted, _ = plain(rows)
    assert sums == {k: sum(e for _, label, _, e in wanted if label == k) for k in (1, 2, None)}


def test_empty_tables_and_lengths(spark):
    kind = "vec_id long, embedding array<double>, label int"
    for rows in ([], [(1, None, 2)]):
        coded, books = codes.compress(spark.createDataFrame(rows, kind))
        assert coded.collect() == [] and books == []
        assert codes.with_label_errors(coded).collect() == []
    coded, _ = codes.compress(spark.createDataFrame([(1, [], 2), (2, [], 2)], kind))
    assert [(r.id, bytes(r.codes), r.error) for r in coded.orderBy("id").collect()] == [(1, bytes(8), 0), (2, bytes(8), 0)]
    for vectors in ([[1.0] * 8, [1.0] * 16], [[1.0] * 9], [[1e300] * 8], [[-1e30] * 8]):
        with pytest.raises(ValueError):
            codes.compress(spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], kind))
