"""Comparing the members of groups of any size in bounded blocks.

A group is cut into parts of about ``PART_ROWS`` members, and every pair of parts is
a block of its own: no task holds more than two parts, however large a group is.
Inside a block numpy compares rows; what leaves it is one row per member, never the
pairs.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_ROWS = 512
# Pairs looked at in one numpy call, and the size from which a group is scanned from
# one member to the next instead of listing its pairs.
STEP_PAIRS = 1 << 17
SCAN_ROWS = 48

Linked = Callable[[np.ndarray, np.ndarray], np.ndarray]


def blocked(members: DataFrame, key: str, node: str, size: Column, part_rows: int = PART_ROWS) -> DataFrame:
    """Members (key, node, ...) once per block they take part in, dealt out and sorted by
    ``block``, with their ``part`` and whether the block is ``mixed``, of two parts.
    ``size`` is the size of the group."""
    parts = F.greatest(F.ceil(size / part_rows), F.lit(1)).cast("int")
    part = F.pmod(F.xxhash64(F.lit(7), node), F.col("_parts")).cast("int")
    other = F.col("_other")
    return (
        members.withColumn("_parts", parts)
        .withColumn("part", part)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("block", F.xxhash64(key, F.least("part", other), F.greatest("part", other)))
        .withColumn("mixed", F.col("part") != other)
        .drop("_parts", "_other", key)
        .repartition("block")
        .sortWithinPartitions("block", node)
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by ``key``, cut again so that no group spans two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))


def listed_pairs(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows within the same group, some at a time."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    after = ends - np.arange(len(ends)) - 1
    total = np.cumsum(after)
    at = 0
    while at < len(after):
        before = int(total[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + STEP_PAIRS, side="right")))
        rows = np.arange(at, stop)
        i = np.repeat(rows, after[at:stop])
        j = np.arange(len(i)) - np.repeat(total[at:stop] - after[at:stop] - before, after[at:stop]) + i + 1
        if len(i):
            yield i, j
        at = stop


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after tying rows i to rows j: the smallest of each connected set."""
    while True:
        low = np.minimum(labels[i], labels[j])
        before = labels.copy()
        np.minimum.at(labels, i, low)
        np.minimum.at(labels, j, low)
        np.minimum.at(labels, before[i], low)
        np.minimum.at(labels, before[j], low)
        labels = labels[labels]
        if np.array_equal(before, labels):
            return labels


def tie(bounds: np.ndarray, sides: np.ndarray, mixed: np.ndarray, linked: Linked) -> np.ndarray:
    """For each row the first row of its group that links connect it with.

    Rows of a ``mixed`` block are compared across its two sides only. Rows already
    connected are not compared again in large groups.
    """
    labels = np.arange(len(sides))
    sizes = np.diff(bounds)
    small = np.repeat(sizes < SCAN_ROWS, sizes)
    rows = np.flatnonzero(small)
    for i, j in listed_pairs(np.append(0, np.cumsum(sizes[sizes < SCAN_ROWS]))):
        i, j = rows[i], rows[j]
        allowed = ~mixed[i] | (sides[i] != sides[j])
        i, j = i[allowed], j[allowed]
        hit = linked(i, j)
        labels = joined(labels, i[hit], j[hit])
    for g in np.flatnonzero(sizes >= SCAN_ROWS):
        start, end = int(bounds[g]), int(bounds[g + 1])
        own = labels[start:end]
        for i in range(start, end - 1):
            rest = np.flatnonzero(own[i + 1 - start :] != own[i - start]) + i + 1
            if mixed[i]:
                rest = rest[sides[rest] != sides[i]]
            if not len(rest):
                if (own == own[0]).all():
                    break
                continue
            hits = rest[linked(np.full(len(rest), i), rest)]
            if len(hits):
                own[np.isin(own, np.append(own[hits - start], own[i - start]))] = min(own[hits - start].min(), own[i - start])
    return labels


def count(bounds: np.ndarray, sides: np.ndarray, mixed: np.ndarray, weights: np.ndarray, linked: Linked) -> tuple[np.ndarray, np.ndarray]:
    """For each row the weights of the rows linked to it, and its label as in ``tie``."""
    labels, sums = np.arange(len(sides)), np.zeros(len(sides), np.int64)
    for i, j in listed_pairs(bounds):
        allowed = ~mixed[i] | (sides[i] != sides[j])
        i, j = i[allowed], j[allowed]
        hit = linked(i, j)
        i, j = i[hit], j[hit]
        np.add.at(sums, i, weights[j])
        np.add.at(sums, j, weights[i])
        labels = joined(labels, i, j)
    return sums, labels


def fixed_rows(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    """Binary values of one length as a matrix."""
    values = column.combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(values), width)


def flags(table: pa.Table, names: Sequence[str]) -> list[np.ndarray]:
    return [table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names]
