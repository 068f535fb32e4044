"""Vectors as short codes: integer product quantisation with exact arithmetic.

Components become integers, vectors are cut into parts, and every part position gets a
codebook by rounds of assignment and integer means. Distances come from one matrix
product of parts and codebook entries. Its integers are broken into limbs so narrow
that no float64 product of limbs reaches 2^53; the products are exact, and are put
together again in int64.
"""

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from pagemill.operators.joins import sized
from pagemill.sources.scratch import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Rows multiplied at once.
ROWS = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb, so that ``width`` products of limbs stay below 2^53 in sum."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays that give ``values`` as a sum of limb i times 2^(bits i). All are
    non-negative below 2^bits but for the last, which has the sign and no more than
    2^bits in size."""
    parts, rest = [], values
    while len(rest.ravel()) and np.abs(rest).max() > 1 << bits:
        parts.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*parts, rest.astype(np.float64)]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int64 matrices (..., n, d) and (..., m, d) over d."""
    bits = limb_bits(a.shape[-1])
    out = np.zeros((*a.shape[:-1], b.shape[-2]), np.int64)
    right = [np.swapaxes(y, -1, -2) for y in limbs(b, bits)]
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += np.matmul(x, y).astype(np.int64) << (bits * (i + j))
    return out


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (position, row, component) in its position's
    codebook, the first of equals, and the squared distance."""
    gaps = (books * books).sum(-1)[:, None, :] - 2 * dots(parts, books)
    first = gaps.argmin(-1)
    least = np.take_along_axis(gaps, first[..., None], -1)[..., 0]
    return first, least + (parts * parts).sum(-1)


def largest_component(width: int, parts: int) -> int:
    """Integers of this size have distances, and sums of them over parts, that int64 holds."""
    return isqrt(((1 << 63) - 1) // (4 * max(width, 1) * parts))


def usable(vector: Column) -> Column:
    """Not null, and all components finite numbers."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def quantised(vectors: DataFrame, scale: int, id_: str, vector: str, label: str) -> DataFrame:
    """(id, label, ints) of the usable vectors; what is beyond 32 bits keeps their bounds."""
    low, high = F.lit(-(1 << 31)), F.lit((1 << 31) - 1)
    whole = F.transform(
        F.col(vector).cast("array<double>"), lambda x: F.least(F.greatest(F.floor(x * scale), low), high).cast("int")
    )
    return vectors.where(usable(F.col(vector))).select(
        F.col(id_).alias("id"), F.col(label).alias("label"), whole.alias("ints")
    )


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """(position, row, component) of a column of lists of one length."""
    flat = column.flatten().to_numpy().astype(np.int64)
    width = len(flat) // max(len(column) * parts, 1)
    return np.ascontiguousarray(flat.reshape(len(column), parts, width).transpose(1, 0, 2))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _member_sums(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row (slot, n, sums) for each used entry, the sum of a task's parts nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        slots = parts * entries
        sums, counts = np.zeros((slots, width), np.int64), np.zeros(slots, np.int64)
        for batch in batches:
            for rows in _slices(batch):
                x = _matrix(rows.column(0), parts)
                slot = (nearest(x, books)[0] + np.arange(parts)[:, None] * entries).ravel()
                counts += np.bincount(slot, minlength=slots)
                for i, component in enumerate(x.reshape(len(slot), width).T):
                    # Exact: so few integers of 32 bits stay below 2^53 in sum.
                    sums[:, i] += np.bincount(slot, component, minlength=slots).astype(np.int64)
        used = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(sums[used].ravel())
        )
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), lists], ["slot", "n", "sums"])

    return run


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> list[list[list[int]]]:
    """Codebooks by position and entry, from stored (id, label, ints).

    They start as the parts of the smallest ids, null last, equal ids by their components.
    A task sums the parts nearest to each entry, Spark adds those sums up, and only one
    row an entry reaches the driver.
    """
    first = rows.orderBy(F.col("id").asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    if not first:
        return []
    books = _matrix(pa.array([r.ints for r in first], pa.list_(pa.int32())), parts)
    width = books.shape[-1]
    for _ in range(rounds):
        sums = rows.select("ints").mapInArrow(_member_sums(books), "slot bigint, n bigint, sums array<bigint>")
        total = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        books = books.copy()
        for row in sums.groupBy("slot").agg(F.sum("n").alias("n"), *total).collect():
            means = [int(row[f"s{i}"]) // row.n for i in range(width)]  # rounds down
            books[row.slot // len(first), row.slot % len(first)] = means
    return books.tolist()


def compress(
    vectors: DataFrame,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, list[list[list[int]]]]:
    """(id, label, codes, error) of every usable vector, stored, and the codebooks.

    ``codes`` has a byte for each part, ``error`` is the squared distance over all parts, in
    units of 1 / ``scale`` squared. Vectors that are null or hold a null or non-finite
    component have no row; a zero vector is one like any other. Null and repeated ids are
    rows like any other. With fewer vectors than ``entries``, codebooks have an entry for
    each. Ties go to the lower index. An empty table gives no rows and no codebooks.

    Vectors of different lengths, or of one that ``parts`` does not divide, and components
    whose distances would not fit 64 bits (of 64 components, beyond 46,340) raise a ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte, so a codebook has 1 to 256 entries")
    rows = materialize(quantised(vectors, scale, id_, vector, label))
    size = F.size("ints")
    peak = F.greatest(F.abs(F.array_max("ints").cast("bigint")), F.abs(F.array_min("ints").cast("bigint")))
    low, high, most = rows.agg(F.min(size), F.max(size), F.max(peak)).first()
    if low != high or (low or 0) % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; lengths are {low} to {high}")
    width = (low or 0) // parts
    if (most or 0) > largest_component(width, parts):
        raise ValueError(f"components must not exceed {largest_component(width, parts) / scale}")
    found = fit(rows, parts, entries, rounds)
    books = np.array(found, np.int64).reshape(parts, len(found[0]) if found else 0, width)
    shown = rows.schema
    schema = StructType(
        [shown["id"], shown["label"], StructField("codes", BinaryType()), StructField("error", LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                first, gaps = nearest(_matrix(part.column(2), parts), books)
                raw = np.ascontiguousarray(first.T.astype(np.uint8))
                codes = pa.Array.from_buffers(pa.binary(parts), len(raw), [None, pa.py_buffer(raw)])
                columns = [part.column(0), part.column(1), codes.cast(pa.binary()), pa.array(gaps.sum(0))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return materialize(rows.mapInArrow(run, schema)), found


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components as decimals, by position, entry and component."""
    flat = (str(x) for book in books for entry in book for x in entry)
    return hashlib.sha256(",".join(flat).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors of equal labels in sum, null equal to null.

    Sums of a label are added up task by task before they meet; the sums, one row a label,
    are joined back, so that a label of many vectors is not gathered anywhere.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")
    sums = sized(coded.groupBy(F.col("label").alias("_label")).agg(total))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
