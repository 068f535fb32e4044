"""Positions of rows in a global order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.sources.scratch import materialize


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``rank`` from 0 in ``order``: sorted over ranges, numbered within each
    range, and shifted by the sizes of the ranges before. Only those sizes, one for each
    partition, pass the driver."""
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        in_order.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    sizes = {r[0]: r[1] for r in placed.groupBy("_part").count().collect()}
    shifts, total = [], 0
    for part in sorted(sizes):
        shifts.append((part, total))
        total += sizes[part]
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift bigint")
    row = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    shifted = placed.join(F.broadcast(table), "_part")
    return shifted.withColumn("rank", row + F.col("_shift")).drop("_part", "_row", "_shift")
