"""Joins against lists, broadcast only behind a check of the list's size."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    NumericType,
    StringType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from pagemill.functions.bloom import bloom_filter
from pagemill.sources.scratch import materialize

# Estimated bytes up to which a list is broadcast, and what a row takes besides its values.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32
_FIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def _value_bytes(field: StructField) -> Column | None:
    """The bytes of a value of varying length; those of fixed length count as part of the row."""
    if isinstance(field.dataType, _FIXED):
        return None
    value = F.col(field.name)
    if not isinstance(field.dataType, (StringType, BinaryType)):
        value = F.to_json(F.struct(value))
    return F.coalesce(F.octet_length(value), F.lit(0))


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of each row."""
    varying = [b for b in map(_value_bytes, df.schema) if b is not None]
    return sum(varying, F.lit(ROW_BYTES + 8 * (len(df.columns) - len(varying))).cast("bigint"))


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of a list: every task sums up its rows, and only the sums meet."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a list is estimated at no more than ``max_bytes``."""
    return estimated_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def sized(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """A list, stored, and broadcast if it is known to be small; any other is shuffled
    and merged, where the adaptive planner splits hot keys."""
    stored = materialize(df)
    return F.broadcast(stored) if fits(stored, max_bytes) else stored.hint("merge")


def join_listed(df: DataFrame, keys: DataFrame, on: str, how: str = "inner", max_bytes: int | None = None) -> DataFrame:
    """``df`` joined with a list. A small list is broadcast. Of a larger one, a Bloom filter is,
    which has bounded size: rows of ``df`` that it tells are not listed stay where they are,
    and only the others are shuffled and merged. ``df`` is then read twice for a left_anti
    join, once for each kind of row."""
    stored = materialize(keys)
    if fits(stored, max_bytes):
        return df.join(F.broadcast(stored), on, how)
    merged = stored.hint("merge")
    if df.schema[on].dataType != stored.schema[on].dataType:
        return df.join(merged, on, how)
    listed = bloom_filter(stored.select(on)).might_hold(df, on)
    found = df.where(listed).join(merged, on, how)
    return df.where(~listed).unionByName(found) if how == "left_anti" else found


def keep_listed(df: DataFrame, keys: DataFrame, on: str, max_bytes: int | None = None) -> DataFrame:
    return join_listed(df, keys, on, "left_semi", max_bytes)


def drop_listed(df: DataFrame, keys: DataFrame, on: str, max_bytes: int | None = None) -> DataFrame:
    return join_listed(df, keys, on, "left_anti", max_bytes)
