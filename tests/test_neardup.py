import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.functions import nearby
from pagemill.functions.hashing import signed64
from pagemill.operators import neardup

MASK = (1 << 64) - 1


def key_of(h, block):
    return (h & MASK) & ~(0xFFFF << (48 - 16 * block)) & MASK


def bits(a, b):
    return ((a ^ b) & MASK).bit_count()


def plain_round(rows, k, block):
    """Greedy merge by the definition: take the head, absorb, repeat."""
    groups = {}
    for row in rows:
        groups.setdefault(key_of(row[1], block), []).append(row)
    out = []
    for group in groups.values():
        rest = sorted(group, key=lambda r: (-r[2], r[0]))
        while rest:
            head = rest[0]
            near = [r for r in rest if bits(head[1], r[1]) <= k]
            out.append((head[0], head[1], sum(r[2] for r in near), sorted(r[0] for r in near)))
            rest = [r for r in rest if r not in near]
    return sorted(out)


def clustered_hashes(seed, n):
    """Unique hashes, many a few bits apart, some equal in size."""
    rng = random.Random(seed)
    hashes = {rng.getrandbits(64) for _ in range(n // 8)}
    while len(hashes) < n:
        base = rng.choice(sorted(hashes)[: n // 4])
        low = 16 * rng.randrange(4)
        for _ in range(rng.randrange(1, 4)):
            base ^= 1 << (low + rng.randrange(16))
        hashes.add(base)
    return [(i, signed64(h), rng.choice([1, 1, 1, 2, 5])) for i, h in enumerate(sorted(hashes))]


def collected(df):
    return sorted((r.fid, r.hash, r.samelen, sorted(r.members)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("fold_rows", [64, 0])
def test_merge_round_equals_the_greedy_definition(spark, monkeypatch, k, fold_rows):
    monkeypatch.setattr(neardup, "FOLD_ROWS", fold_rows)
    rows = clustered_hashes(k, 400)
    for partitions in (1, 7):
        df = spark.createDataFrame(rows, "fid bigint, hash bigint, samelen bigint").repartition(partitions)
        assert collected(neardup.merge_round(df, k, 2)) == plain_round(rows, k, 2)


@settings(max_examples=80, deadline=None)
@given(
    st.dictionaries(st.integers(0, 300), st.integers(1, 3), min_size=1, max_size=60),
    st.integers(1, 4),
)
def test_large_group_merge_equals_the_greedy_definition(group, k):
    rows = sorted(((fid, v, n) for fid, (v, n) in enumerate(group.items())), key=lambda r: (-r[2], r[0]))
    fids, values, lens = (np.array(c, dtype=np.int64) for c in zip(*rows))
    masks = np.array([0, *neardup._flip_masks(k)], dtype=np.int64)
    merged = neardup.merge_block_group(fids, values, lens, masks)
    got = sorted((int(fids[h]), int(values[h]), n, sorted(m.tolist())) for h, n, m in merged)
    assert got == plain_round(rows, k, 3)


def test_merge_of_a_full_block_group(spark):
    """The largest group there can be: all 65,536 values of one block."""
    rows = spark.range(1 << 16).selectExpr("id AS fid", "id AS hash", "1L AS samelen")
    merged = neardup.merge_round(rows, 1, 3).selectExpr("sum(samelen)", "sum(size(members))", "count(*)")
    total, members, leaders = merged.first()
    # Leaders at least two bits apart, in number order: the even-weight values.
    assert total == members == 1 << 16 and leaders == 1 << 15


@pytest.mark.parametrize("k", [1, 3])
def test_clusters_chain_the_rounds(spark, k):
    rng = random.Random(9)
    hashes = [h for _, h, _ in clustered_hashes(5, 300)]
    docs = [(i, rng.choice(hashes)) for i in range(900)] + [(1000 + i, h) for i, h in enumerate(hashes)]
    df = spark.createDataFrame(docs, "fid bigint, hash bigint")
    clusters, members = neardup.near_dup_clusters(df, k)

    groups = {}
    for fid, h in docs:
        groups.setdefault(h, []).append(fid)
    level = [(min(f), h, len(f)) for h, f in groups.items()]
    rep = {min(f): min(f) for f in groups.values()}
    for block in range(4):
        merged = plain_round(level, k, block)
        moved = {m: leader for leader, _, _, ms in merged for m in ms}
        rep = {fid: moved[r] for fid, r in rep.items()}
        level = [(fid, h, n) for fid, h, n, _ in merged]
    assert sorted(level) == sorted((r.fid, r.hash, r.samelen) for r in clusters.collect())
    wanted = sorted((rep[min(groups[h])], fid) for fid, h in docs)
    assert wanted == sorted((r.rep_fid, r.fid) for r in members.collect())


@pytest.mark.parametrize("k", [1, 2, 3])
def test_near_pairs_equal_all_pairs(spark, k):
    rows = clustered_hashes(11, 300)
    df = spark.createDataFrame(rows, "fid bigint, hash bigint, samelen bigint")
    wanted = sorted(
        (a[0], b[0], bits(a[1], b[1]))
        for i, a in enumerate(rows)
        for b in rows[i + 1 :]
        if bits(a[1], b[1]) <= k
    )
    assert wanted == sorted(tuple(r) for r in neardup.near_pairs(df, k).collect())


@pytest.mark.parametrize("k", [0, 1, 2])
@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_listed_hashes_equal_a_loop_over_the_list(spark, monkeypatch, k, broadcast_bytes):
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", broadcast_bytes)
    rows = clustered_hashes(3, 200)
    listed = [h for _, h, _ in rows[::17]] + [rows[0][1]]
    df = spark.createDataFrame(rows, "fid bigint, hash bigint, samelen bigint")
    junk = spark.createDataFrame([(h,) for h in listed], "value bigint")
    near = {r[0] for r in rows if any(bits(r[1], h) <= k for h in listed)}
    assert {r.fid for r in neardup.match_hashes(df, junk, k).collect()} == near
    kept = neardup.drop_hashes(df, junk, k)
    assert {r.fid for r in kept.collect()} == {r[0] for r in rows} - near and kept.columns == df.columns


@pytest.mark.parametrize("max_bytes", [1 << 20, 40])
def test_drop_urls(spark, max_bytes):
    urls = [None, "", "http://a.example.net", "http://b.org", "net", "http://annex"]
    df = spark.createDataFrame(list(enumerate(urls)), "fid bigint, furl string")
    junk = spark.createDataFrame([("example.net",), ("nne",), ("",)], "value string")
    kept = neardup.drop_urls(df, junk, max_bytes)
    assert sorted(r.fid for r in kept.collect()) == [0, 1, 3, 4]


def test_drop_titles_and_short(spark):
    df = spark.createDataFrame([(1, "t", -1), (2, None, 5), (3, "u", None)], "fid bigint, ftitle string, hash bigint")
    junk = spark.createDataFrame([("t",), ("t",)], "value string")
    assert sorted(r.fid for r in neardup.drop_titles(df, junk).collect()) == [2, 3]
    assert sorted(r.fid for r in neardup.drop_short(df).collect()) == [2, 3]


def test_member_string_keeps_every_id(spark):
    members = spark.range(3000).selectExpr("IF(id < 2990, 0L, id) AS rep_fid", "id AS fid")
    got = {(r.rep_fid, r.part): r.samefid for r in neardup.member_string(members, part_ids=100).collect()}
    joined = ",".join(got[0, part] for part in range(30))
    assert joined == ",".join(map(str, range(2990))) and got[2995, 0] == "2995" and len(got) == 40


def test_short_texts_are_no_copies_of_one_another(spark):
    rows = [(1, -1), (2, -1), (3, 7), (4, 7)]
    hashes = spark.createDataFrame(rows, "fid bigint, hash bigint")
    clusters, members = neardup.near_dup_clusters(hashes)
    assert [(r.fid, r.samelen) for r in clusters.collect()] == [(3, 2)]
    assert sorted(map(tuple, members.collect())) == [(1, 1), (2, 2), (3, 3), (3, 4)]
    same = neardup.same_hash(hashes)
    assert sorted(map(tuple, neardup.same_members(hashes, same).collect())) == [(1, 1), (2, 2), (3, 3), (3, 4)]


def test_near_pairs_refuse_more_bits(spark):
    with pytest.raises(ValueError):
        neardup.near_pairs(spark.createDataFrame([(1, 2, 1)], "fid bigint, hash bigint, samelen bigint"), 4)


@pytest.mark.parametrize("k", [3, 5, 7])
@pytest.mark.parametrize("most", [1 << 21, 5])
def test_hashes_near_a_listed_one_by_index(spark, k, most):
    """One index, and a list dealt out to several; repeated, null and unlisted hashes."""
    rng = random.Random(k)
    rows = clustered_hashes(3, 200)
    listed = [h for _, h, _ in rows[::17]] + [rows[0][1], None, -1]

    def moved(h):
        for bit in rng.sample(range(64), rng.randrange(k + 3)):
            h ^= 1 << bit if bit < 63 else -(1 << 63)
        return h

    hashes = [r[1] for r in rows] + [moved(rng.choice(listed[:-2])) for _ in range(300)] + [None, -1, rows[0][1]]
    df = spark.createDataFrame([(i, h, f"x{i}") for i, h in enumerate(hashes)], "fid bigint, hash bigint, listed string")
    junk = spark.createDataFrame([(h,) for h in listed], "value bigint")
    near = {i for i, h in enumerate(hashes) if h is not None and any(x is not None and bits(h, x) <= k for x in listed)}
    kept = neardup.match_hashes(df, junk, k, most)
    assert {r.fid for r in kept.collect()} == near and kept.columns == df.columns
    left = neardup.drop_hashes(df, junk, k, most)
    assert sorted(r.fid for r in left.collect()) == [i for i in range(len(hashes)) if i not in near]
    assert neardup.match_hashes(df, junk.limit(0), k).count() == 0 and neardup.drop_hashes(df, junk.limit(0), k).count() == len(hashes)


def test_hashes_within_2_bits_need_no_list_of_neighbours(spark, monkeypatch):
    """A listed hash has 2,081 neighbours within 2 bits, and twice 65 flips name them 4,225 times."""
    listed = []
    hash_ball = neardup.hash_ball
    monkeypatch.setattr(neardup, "hash_ball", lambda df, k: listed.append(hash_ball(df, k).count()) or hash_ball(df, k))
    df = spark.createDataFrame([(1, 0b11), (2, 0b111), (3, None), (4, -1)], "fid bigint, hash bigint")
    junk = spark.createDataFrame([(0,), (None,)], "value bigint")
    assert [r.fid for r in neardup.match_hashes(df, junk, 2).collect()] == [1]
    assert sorted(r.fid for r in neardup.drop_hashes(df, junk, 2).collect()) == [2, 3, 4]
    assert sum(listed) <= 65 * junk.count()


def test_index_of_hashes_that_share_blocks():
    """All listed hashes agree in all blocks but one, and steps are smaller than a group."""
    listed = np.arange(5_000, dtype=np.int64)
    index = nearby.NearIndex(listed, 3)
    asked = np.array([0, 4_999, 8_191, 1 << 40, (1 << 40) + (7 << 50), -1, 65_535], dtype=np.int64)
    wanted = [any(bits(int(a), int(h)) <= 3 for h in listed) for a in asked]
    assert index.near(asked).tolist() == wanted


def test_too_many_bits_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "fid bigint, hash bigint")
    with pytest.raises(ValueError):
        neardup.match_hashes(df, df.select("hash"), 8)
