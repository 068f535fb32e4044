"""Words of texts and runs of words as 64-bit hashes, over whole Arrow batches.

A word is a run of letters and digits in lower case. Its hash is a polynomial in its
code points, read off a running sum, so no word is ever cut out as a string.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pagemill.llm import chars

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEQUENCE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each span."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(values))[:-1], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(values))[starts])


def word_hashes(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each text, the end last."""
    data, bounds = chars.raw(pc.utf8_lower(texts))
    points, byte_at = chars.code_points(data)
    begin = np.searchsorted(byte_at, bounds)
    inside = (classes[points] == chars.LETTER) | (classes[points] == chars.NUMBER)
    first = np.zeros(len(points) + 1, bool)
    first[begin] = True
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1] | first[1:-1])[: len(inside)])
    ends = np.flatnonzero(inside & np.append(~inside[1:] | first[1:-1], True)[: len(inside)]) + 1
    return span_hashes(points, starts, ends), np.searchsorted(starts, begin)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, and the bounds per text. A
    text of fewer words has one run, all of them; a text without words has none."""
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.append(0, np.cumsum(runs))
    starts = np.arange(out[-1]) - np.repeat(out[:-1] - bounds[:-1], runs)
    ends = np.minimum(starts + size, np.repeat(bounds[1:], runs))
    return span_hashes(words, starts, ends), out


def sequence_keys(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's whole word sequence."""
    one, two = (span_hashes(words ^ np.uint64(k), bounds[:-1], bounds[1:]) for k in _SEQUENCE)
    return one.view(np.int64), two.view(np.int64)
