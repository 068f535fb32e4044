"""Connected components of a graph given as edges, by alternating star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.sources.scratch import materialize


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v) with u > v."""
    a, b = (F.col(c) for c in edges.columns)
    return edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge, from edges of two bigint columns;
    a component is named by its smallest node. Null ends are ignored.

    A step ties every node's larger neighbours, then its smaller ones, to the smallest
    node it sees. The number of edges never grows, and the steps needed are about the
    logarithm of the longest path. Each step is stored; nothing is collected but the
    count and the checksum that tell whether a step changed anything.
    """
    edges = materialize(_oriented(edges))
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), F.col("u") == F.col("w")).where("v > u").select("v", "m")
        large = materialize(_oriented(large))
        tied = large.join(_smallest(large), F.col("u") == F.col("w"))
        small = tied.select("u", "m").unionByName(tied.select(F.col("v").alias("u"), "m"))
        edges = materialize(_oriented(small))
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
