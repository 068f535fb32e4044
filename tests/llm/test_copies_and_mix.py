"""Near copies, lattice hashing, components, lines and the mix on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import blocks, jaccard, lines, mixing, vectors
from pagemill.llm.components import components


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    edges = spark.createDataFrame([*path, *star, (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(60)}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("part_rows", [4, 512])
def test_blocks_compare_every_pair_once(spark, part_rows):
    members = spark.range(30).select(F.lit(5).alias("key"), F.col("id").alias("node"), F.lit(30).alias("size"))
    rows = blocks.blocked(members, "key", "node", F.col("size"), part_rows).orderBy("block", "node").collect()
    seen = []
    bounds = blocks.group_bounds(np.array([r.block for r in rows]))
    mixed, part = (np.array([r[c] for r in rows]) for c in ("mixed", "part"))

    def linked(i, j):
        seen.extend(tuple(sorted((rows[a].node, rows[b].node))) for a, b in zip(i, j))
        return np.zeros(len(i), bool)

    blocks.count(bounds, part, mixed, np.ones(len(rows), np.int64), linked)
    assert len(seen) == len(set(seen)) == 30 * 29 // 2


def test_lattice_points_are_nearest():
    x = np.random.default_rng(1).normal(size=(200, 8)) * 2
    near = vectors.nearest_e8(x)
    sums = near.sum(axis=1)
    assert np.array_equal(sums, np.rint(sums)) and not (sums % 2).any()
    steps = vectors.shortest_e8()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    own = ((x - near) ** 2).sum(axis=1)
    around = ((x[:, None] - near[:, None] - steps[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= around + 1e-9).all()


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 64))
    rows = [(i, (base[i % 20] + rng.normal(size=64) * 0.1 * (i % 3)).tolist(), int(i % 2)) for i in range(200)]
    rows += [(200, None, 1), (201, [0.0] * 64, 1), (202, [float("nan")] * 64, 1), (203, rows[0][1], None), (204, rows[0][1], 0)]
    rows += [(205, [None] * 64, 0), (206, [], 0), (None, rows[0][1], 0), (204, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(frame).collect() if r.vec_id is not None)
    units = {}
    fit = [(k, r) for k, r in enumerate(rows) if r[0] is not None and r[2] is not None and r[1] and all(v is not None and v == v for v in r[1]) and any(r[1])]
    for k, r in fit:
        v = np.array(r[1], np.float32).astype(float)
        units[k] = v / np.linalg.norm(v)
    links = {k: {j for j, s in fit if j != k and s[2] == r[2] and units[k] @ units[j] >= 0.98} for k, r in fit}
    wanted = []
    for k, r in enumerate(rows):
        if r[0] is None:
            continue
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min(rows[j][0] for j in seen)
        wanted.append((r[0], len(links.get(k, ())), low, low == r[0]))
    assert got == sorted(wanted)
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_vectors_of_one_id_link_by_themselves(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 0), (3, [0.01, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_equal_texts_without_a_word_are_copies(spark):
    rows = [(1, "!!! ***"), (2, "!!! ***"), (3, "***"), (4, ""), (5, ""), (6, None), (7, "!!! ***"), (None, "***")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in jaccard.near_documents(frame).collect()}
    alone = {i: (i, 0, True) for i in (3, 4, 5, 6, None)}
    assert got == alone | {1: (1, 2, True), 2: (1, 2, False), 7: (1, 2, False)}
    assert sorted(r.doc_id for r in jaccard.one_of_each(frame).where("doc_id IS NOT NULL").collect()) == [1, 3, 4, 5, 6]


def test_a_line_on_very_many_sites(spark):
    """Its sketches are made in parts and merged; nothing of it is gathered before."""
    rows = spark.range(0, 200_000, numPartitions=8).selectExpr("5L AS hash", "concat('s', id) AS site", "3 AS least")
    few = spark.createDataFrame([(6, "a", 3), (6, "b", 3), (6, "a", 3), (7, None, 3)], "hash long, site string, least int")
    spread = lines.spread_lines(rows.unionByName(few))
    assert [r.hash for r in spread.collect()] == [5]


def grams(text):
    import regex

    w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    if not w:
        return frozenset([text] if text else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def test_near_documents_against_brute_force(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 120))] for _ in range(25)]
    rows = []
    for i in range(250):
        w = list(base[i % 25])
        for _ in range(i // 25 % 4):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    rows += [(300, "a b c"), (301, "A, b... c!"), (302, None), (303, ""), (304, "!!"), (307, "!!"), (305, "a b c"), (305, "a b c"), (None, "a b c"), (306, "long " * 20_000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_documents(frame).collect() if r.doc_id is not None)
    sets = [grams(t) if i is not None else frozenset() for i, t in rows]

    def near(a, b):
        return bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b)

    links = [{j for j in range(len(rows)) if j != k and near(sets[k], sets[j])} for k in range(len(rows))]
    wanted = []
    for k, (doc_id, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        if doc_id is not None:
            wanted.append((doc_id, min(rows[j][0] for j in seen), len(links[k])))
    assert got == sorted(wanted)
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    assert kept.where("doc_id IS NOT NULL").count() == len({c for _, c, _ in wanted})
    assert jaccard.near_documents(frame.limit(0)).count() == jaccard.one_of_each(frame.limit(0)).count() == 0


def test_pruning_never_drops_a_likely_pair():
    steps = jaccard.least_matches(0.8, 1e-6, 96)
    assert steps[-1][0] == 96 and all(m < 0.8 * n for n, m in steps)
    sig = np.zeros((2, 96), np.uint8)
    assert jaccard.probable(sig, steps)(np.array([0]), np.array([1])).all()


def test_spread_lines_with_near_threshold_counts(spark):
    rows = [(i, "shared line\nown line %d" % i, f"s{i % 12}") for i in range(40)]
    rows += [(100 + i, "almost\n\n  ALMOST ", f"s{i}") for i in range(9)]
    rows += [(200, None, "s1"), (201, "shared line", None), (None, "shared   LINE\nx", "s1"), (202, "", "s2")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, hash int")
    got = {r.doc_id: r for r in lines.drop_spread_lines(frame, 10).collect()}
    assert got[0].text == rows[0][1] and got[1].text == "own line 1" and got[1].n_dropped == 1
    assert got[105].text == "almost\n\n  ALMOST " and got[200].text is None and got[201].text == ""
    assert got[None].text == "x" and got[202].n_lines == 1 and set(frame.columns) <= set(got[0].asDict())
    assert lines.drop_spread_lines(frame.limit(0)).count() == 0


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = sum(w[s] for s in names if s not in full)
        level = (total - sum(3 * sizes[s] for s in full)) / rest if rest else 0
        above = {s for s in names if s not in full and w[s] * level > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in full else w[s] * level for s in names}
        full |= above


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(200))), f"s{min(i % 9, 4)}") for i in range(400)]
    rows += [(500 + i, "a b c d e", "tiny") for i in range(3)] + [(600, None, "none"), (601, "x " * 3000, None), (None, "p q", "s1")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, source string, quota string")
    got = mixing.mix(frame).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r["size"]
    targets = plain_targets(sizes)
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    n_shards = 6
    assert all(abs(taken[s] - t) <= mixing.BLOCK_WORDS * n_shards for s, t in targets.items())
    again = mixing.take(frame)
    words = {r.source: r.n for r in again.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert again.columns == frame.columns
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(frame.limit(0)).count() == mixing.take(frame.limit(0)).count() == 0


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(6)
    claims = [("g", i, float(rng.randrange(1, 1000)), 97) for i in range(20)] + [("h", i, 1.0, 2) for i in range(3)]
    rows = mixing.apportion(spark.createDataFrame(claims, "g string, k int, claim double, seats long"), ["g"], "k", "claim", "seats").collect()
    for g, seats in (("g", 97), ("h", 2)):
        own = {k: c for x, k, c, _ in claims if x == g}
        quota = dict.fromkeys(own, 0)
        for _ in range(seats):
            best = max(own, key=lambda k: (own[k] / (2 * quota[k] + 1), -k))
            quota[best] += 1
        assert {r.k: r.quota for r in rows if r.g == g} == quota
