"""Bloom filters: a set of keys as bits of bounded number, tested where rows are."""

from dataclasses import dataclass
from functools import reduce
from math import log
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

# Bits for each key, up to the most a filter has: 16 MB, whatever the number of keys.
BITS_PER_KEY = 10
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 10
_SEED = 11


def _hashes(*keys: Column) -> tuple[Column, Column]:
    """Two independent hashes; their sums in varying proportion give all positions."""
    return F.xxhash64(*keys), F.xxhash64(F.lit(_SEED), *keys)


@dataclass(frozen=True)
class BloomFilter:
    """``words`` hold the bits, ``probes`` the number of positions of a key."""

    words: np.ndarray
    probes: int

    def might_hold(self, df: DataFrame, *keys: str) -> Column:
        """Of rows of ``df``: false only for keys that were not put in, and for null ones."""
        shipped = df.sparkSession.sparkContext.broadcast(self.words)
        probes, last = self.probes, np.int64(len(self.words) * 64 - 1)

        @arrow_udf(BooleanType())
        def test(first: pa.Array, second: pa.Array) -> pa.Array:
            one, two = (x.to_numpy(zero_copy_only=False) & last for x in (first, second))
            held = np.ones(len(one), bool)
            for i in range(probes):
                at = (one + i * two) & last
                held &= (shipped.value[at >> 6] >> (at & 63)) & 1 == 1
            return pa.array(held)

        columns = [F.col(k) for k in keys]
        known = reduce(and_, (c.isNotNull() for c in columns))
        return known & test(*_hashes(*columns))


def bloom_filter(keys: DataFrame, most_bits: int = MOST_BITS) -> BloomFilter:
    """The filter of all columns of ``keys``; rows with a null are left out.

    Each task sets bits in words of 64 and only words meet, by bitwise or. The driver gets
    a row for each word that is not empty, two million at most. With more keys than the
    bits suit, fewer rows are told apart, none wrongly left out.
    """
    n = keys.count()
    bits = min(max(LEAST_BITS, 1 << (BITS_PER_KEY * n - 1).bit_length() if n else 0), most_bits)
    probes = max(1, min(8, round(bits / max(n, 1) * log(2))))
    one, two = _hashes(*map(F.col, keys.columns))
    one, two = (h.bitwiseAND(bits - 1) for h in _hashes(*map(F.col, keys.columns)))
    placed = keys.na.drop().select(one.alias("one"), two.alias("two"))
    turns = F.lit(list(range(probes))).cast("array<bigint>")
    at = F.transform(turns, lambda i: (F.col("one") + i * F.col("two")).bitwiseAND(bits - 1))
    placed = placed.select(F.explode(at).alias("at"))
    word = F.call_function("shiftright", F.col("at"), F.lit(6)).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(63).cast("int")).alias("bit")
    merged = placed.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[merged["word"].to_numpy()] = merged["bits"].to_numpy()
    return BloomFilter(words, probes)
