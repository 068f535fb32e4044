"""Near copies among embeddings by lattice hashing.

Each table projects the unit vectors at random to eight dimensions and rounds them to
the nearest point of the E8 lattice. A vector is filed under its own point and looked
up under the neighbouring points it lies closest to. Vectors that meet are verified
by their cosine in double precision.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, LongType

from pagemill.llm import blocks
from pagemill.llm.components import components
from pagemill.sources.scratch import materialize

COSINE = 0.98
TABLES = 6
PROBES = 12
CELL = 1.0
SEED = 4


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points whose coordinates are integers of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    gap = x[odd] - near[odd]
    worst = np.abs(gap).argmax(axis=1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8, or D8 moved by one half in each coordinate."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors of the lattice, a point's steps to its neighbours."""
    pairs = [(i, j, a, b) for i in range(8) for j in range(i) for a in (-1, 1) for b in (-1, 1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(whole, pairs):
        row[i], row[j] = a, b
    signs = np.array(np.meshgrid(*[[-0.5, 0.5]] * 8)).reshape(8, -1).T
    return np.concatenate([whole, signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _keys(points: np.ndarray, table: int) -> np.ndarray:
    odd = np.random.default_rng(table).integers(1 << 62, size=8, dtype=np.int64) * 2 + 1
    with np.errstate(over="ignore"):
        mixed = ((points * 2).astype(np.int64) * odd).sum(axis=-1) + table
        mixed ^= mixed >> 29
        return mixed * np.int64(0x1CE4E5B9BF58476D)


def cells(units: np.ndarray, tables: int, probes: int, cell: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each vector's own cell in each table, and those of the cells it probes."""
    steps = shortest_e8()
    rng = np.random.default_rng([seed, units.shape[1]])
    own, near = [], []
    for table in range(tables):
        x = units @ rng.standard_normal((units.shape[1], 8)) / cell
        points = nearest_e8(x)
        order = np.argpartition(-((x - points) @ steps.T), probes - 1, axis=1)[:, :probes]
        own.append(_keys(points, table))
        near.append(_keys(points[:, None, :] + steps[order], table))
    return np.stack(own, axis=1), np.concatenate(near, axis=1)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


@arrow_udf(BinaryType())
def _unit_bytes(lists: pa.Array) -> pa.Array:
    """Each vector divided by its length, as bytes of doubles."""
    out = []
    for row in lists:
        v = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
        v = v / np.abs(v).max()
        out.append((v / np.sqrt((v * v).sum())).tobytes())
    return pa.array(out, pa.binary())


def _cell_lists(tables: int, probes: int, cell: float, seed: int):
    @arrow_udf(ArrayType(LongType()))
    def run(units: pa.Array) -> pa.Array:
        """The own cells, then the probed ones."""
        out: list[np.ndarray | None] = [None] * len(units)
        sizes = np.array([len(u) for u in units.to_pylist()])
        for width in np.unique(sizes):
            rows = np.flatnonzero(sizes == width)
            matrix = blocks.fixed_rows(pa.chunked_array([units.take(pa.array(rows))]), "f8", width // 8)
            own, near = cells(matrix, tables, probes, cell, seed)
            for row, keys in zip(rows, np.concatenate([own, near], axis=1)):
                out[row] = keys
        return pa.array(out, pa.list_(pa.int64()))

    return run


def _cosine(table: pa.Table, threshold: float) -> blocks.Linked:
    units = table.column("unit").combine_chunks().to_pylist()
    width = max((len(u) for u in units), default=0)
    matrix = np.frombuffer(b"".join(u.ljust(width, b"\0") for u in units), np.float64).reshape(len(units), -1)
    sizes = np.array([len(u) for u in units])

    def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (np.einsum("ij,ij->i", matrix[i], matrix[j]) >= threshold) & (sizes[i] == sizes[j])

    return linked


def near_vectors(
    vectors: DataFrame,
    threshold: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Rows link when their labels are equal and their cosine is at least ``threshold``.
    Rows whose label, id or embedding is null, and embeddings that are zero or hold a
    null or non-finite component, link with nothing and name their own component (null
    for a null id, which is kept). Embeddings of different lengths do not link. Repeated rows
    are vectors like any other and link with each other; so are different vectors, or labels, of
    one id, each of which has its own links. An empty table gives no rows.

    Equal vectors become one class before anything is compared. Verified meetings give
    components; within them all vectors are compared, in blocks, so that ``n_links``
    does not depend on how often a pair met.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    fit = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    rows = rows.withColumn("_fit", fit)
    same = rows.where("_fit").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Classes are numbered in storage: one id may stand for several vectors.
    numbered = same.withColumns({"node": F.monotonically_increasing_id(), "unit": _unit_bytes(F.col("embedding"))})
    classes = materialize(numbered)

    keys = classes.select("node", "label", _cell_lists(tables, probes, cell, seed)(F.col("unit")).alias("keys"))
    filed = keys.select("node", "label", F.posexplode("keys").alias("_pos", "key")).select(
        "node", F.xxhash64("label", "key").alias("key"), (F.col("_pos") < tables).alias("own")
    )
    filed = materialize(filed)
    met = (
        filed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.max("own").alias("_any"))
        .where("size > 1 AND _any")
    )
    members = filed.join(met, "key").join(classes.select("node", "unit"), "node")
    dealt = blocks.blocked(members.select("key", "node", "size", "unit"), "key", "node", F.col("size"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks.whole_groups(batches, "block"):
            block, nodes, part, mixed = blocks.flags(table, ["block", "node", "part", "mixed"])
            labels = blocks.tie(blocks.group_bounds(block), part, mixed, _cosine(table, threshold))
            moved = labels != np.arange(len(labels))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[labels[moved]])], ["a", "b"])

    edges = dealt.select("block", "node", "part", "mixed", "unit").mapInArrow(meet, "a long, b long")
    found = materialize(components(edges))

    firsts = found.join(classes.select("node", "first"), "node").groupBy("component")
    sized = firsts.agg(F.count(F.lit(1)).alias("size"), F.min("first").alias("least"))
    found = materialize(found.join(sized, "component"))
    grouped = found.drop("least").join(classes.select("node", "n", "unit"), "node")
    dealt = blocks.blocked(grouped, "component", "node", F.col("size"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks.whole_groups(batches, "block"):
            block, nodes, part, mixed, n = blocks.flags(table, ["block", "node", "part", "mixed", "n"])
            sums, _ = blocks.count(blocks.group_bounds(block), part, mixed, n, _cosine(table, threshold))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sums)], ["node", "links"])

    links = dealt.select("block", "node", "part", "mixed", "n", "unit").mapInArrow(compare, "node long, links long")
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("label", "embedding", "node", "first", "n").join(links, "node", "left")
    named = named.join(found.select("node", "least"), "node", "left")
    named = named.select(
        "label",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"),
    )
    alone = rows.where("NOT _fit").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("_fit").join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
