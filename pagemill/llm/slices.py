"""Runs of bytes cut out of many texts at once."""

import numpy as np
import pyarrow as pa


def text_starts(size: int, bounds: np.ndarray) -> np.ndarray:
    """Whether each of ``size`` bytes is the first of a text; ``bounds`` as of ``chars.raw``."""
    firsts = np.zeros(size, bool)
    firsts[bounds[:-1][np.diff(bounds) > 0]] = True
    return firsts


def cut(data: np.ndarray, kept: np.ndarray, breaks: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The runs of ``kept`` bytes, a new one at every byte of ``breaks``, and where they start."""
    begins = kept.copy()
    begins[1:] &= ~kept[:-1] | breaks[1:]
    starts = np.flatnonzero(begins)
    placed = np.cumsum(kept)
    offsets = np.append(placed[starts] - 1, placed[-1] if len(placed) else 0).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[kept])])
    return runs, starts


def owners(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The text that each run is of."""
    return np.searchsorted(bounds, starts, side="right") - 1
