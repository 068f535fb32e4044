"""64-bit document fingerprints and Hamming-distance predicates."""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from pagemill.constants import MIN_TOKENS, SHORT_HASH

# The 64-bit FNV-1a offset basis and prime.
FNV_OFFSET = 0xCBF29CE484222325
FNV_PRIME = 0x100000001B3

BLOCKS = 4
BLOCK_BITS = 16
_CHUNK_TOKENS = 1 << 16
# Words of more bytes than this are hashed one by one.
_LONG_WORD = 256


def signed64(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def block_shift(block: int) -> int:
    """Lowest bit of a block; block 0 is the top one."""
    if block not in range(BLOCKS):
        raise ValueError(f"block must be 0..{BLOCKS - 1}, got {block}")
    return 64 - BLOCK_BITS * (block + 1)


def fnv1a(distinct: pa.Array) -> np.ndarray:
    """FNV-1a of each string, byte position by byte position over all strings."""
    raw = distinct.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], dtype=np.int64)
    bounds = bounds[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)
    lengths = np.diff(bounds)
    longest_first = np.argsort(-lengths, kind="stable")
    starts = bounds[:-1][longest_first]
    lengths = lengths[longest_first]
    state = np.full(len(raw), FNV_OFFSET, dtype=np.uint64)
    prime = np.uint64(FNV_PRIME)
    n_long = int(np.count_nonzero(lengths > _LONG_WORD))
    for i in range(n_long):
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        value = FNV_OFFSET
        for byte in word:
            value = ((value ^ byte) * FNV_PRIME) & 0xFFFFFFFFFFFFFFFF
        state[i] = value
    # Words still being hashed at each byte position, counted once for all of them.
    ended = np.cumsum(np.bincount(lengths[n_long:], minlength=_LONG_WORD + 1))
    for pos in range(int(lengths[n_long]) if n_long < len(lengths) else 0):
        part = slice(n_long, len(lengths) - int(ended[pos]))
        state[part] = (state[part] ^ data[starts[part] + pos].astype(np.uint64)) * prime
    hashes = np.empty_like(state)
    hashes[longest_first] = state
    return hashes


def simhash_lists(lists: pa.ListArray) -> np.ndarray:
    """Simhash of each word list: bit i is the majority of bit i over its words."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy()
    bounds = bounds - bounds[0]
    bits = np.unpackbits(
        fnv1a(encoded.dictionary).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1
    )
    out = np.zeros(len(lists), dtype=np.uint64)
    filled = np.flatnonzero(np.diff(bounds))
    starts, ends = bounds[filled], bounds[filled + 1]
    at = 0
    while at < len(filled):
        # As many whole lists as fit the chunk, at least one.
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK_TOKENS, side="right")))
        chunk = bits[codes[starts[at] : ends[stop - 1]]]
        ones = np.add.reduceat(chunk, starts[at:stop] - starts[at], axis=0, dtype=np.int64)
        majority = 2 * ones > (ends[at:stop] - starts[at:stop])[:, None]
        out[filled[at:stop]] = np.packbits(majority, axis=1).view(">u8").ravel()
        at = stop
    return out.view(np.int64)


@arrow_udf(LongType())
def _simhash(word_lists: pa.Array) -> pa.Array:
    return pa.array(simhash_lists(word_lists))


# A filter on the finished hash must not be pushed below its computation: words would be
# cut and hashed once for the filter and again for the result.
_simhash = _simhash.asNondeterministic()


def simhash(ws: Column, min_tokens: int = MIN_TOKENS) -> Column:
    """Fingerprint of a word array, or -1 for ``min_tokens`` words or fewer.

    All words of a document sit in one row, so this needs no shuffle. Spark has no
    FNV function, and the fold over bytes written with ``aggregate`` took about ten
    times as long as this Arrow batch function.
    """
    safe = F.coalesce(ws, F.array().cast("array<string>"))
    return F.when(F.size(safe) > min_tokens, _simhash(safe)).otherwise(F.lit(SHORT_HASH).cast("bigint"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def within(a: Column, b: Column, k: int) -> Column:
    """Hamming distance of at most ``k`` bits."""
    return distance(a, b) <= k


def block_key(h: Column, block: int) -> Column:
    """The hash with one 16-bit block zeroed; the other 48 bits stay."""
    hole = ((1 << BLOCK_BITS) - 1) << block_shift(block)
    return h.bitwiseAND(F.lit(signed64(~hole & (1 << 64) - 1)).cast("bigint"))


def ball(h: Column, radius: int = 1) -> Column:
    """The hash and all values within ``radius`` bits of it."""
    masks = [sum(1 << i for i in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return F.transform(F.lit([signed64(m) for m in masks]).cast("array<bigint>"), lambda m: h.bitwiseXOR(m))
