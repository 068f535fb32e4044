"""Whether a 64-bit hash is within a few bits of one of many listed hashes.

Cut into one block more than bits may differ, two near hashes agree in a block at least. The
listed hashes are kept in order of each block; a hash is compared with those that share one.
"""

import numpy as np

# Comparisons made at once.
STEP = 1 << 20


class NearIndex:
    """Listed hashes, ordered by each block."""

    def __init__(self, listed: np.ndarray, bits: int):
        self.listed = np.unique(listed.astype(np.int64).view(np.uint64))
        self.bits = bits
        orders = [(b, np.argsort(b, kind="stable")) for b in self._blocks(self.listed)]
        self.ordered = [(b[order], self.listed[order]) for b, order in orders]

    def _blocks(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The value of each block of every hash; widths differ by one bit at most."""
        bounds = [64 * n // (self.bits + 1) for n in range(self.bits + 2)]
        return [(hashes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(bounds, bounds[1:])]

    def near(self, hashes: np.ndarray) -> np.ndarray:
        """For each signed hash whether one within ``bits`` bits is listed."""
        distinct, back = np.unique(hashes.astype(np.int64).view(np.uint64), return_inverse=True)
        found = np.zeros(len(distinct), bool)
        for own, (values, listed) in zip(self._blocks(distinct), self.ordered):
            open_ = np.flatnonzero(~found)
            low = np.searchsorted(values, own[open_], "left")
            many = np.searchsorted(values, own[open_], "right") - low
            ends = np.cumsum(many)
            start = 0
            while start < len(open_):
                base = ends[start] - many[start]
                stop = max(start + 1, int(np.searchsorted(ends, base + STEP, "right")))
                n = many[start:stop]
                row = np.repeat(open_[start:stop], n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[start:stop], n)
                close = np.bitwise_count(distinct[row] ^ listed[at]) <= self.bits
                found[row[close]] = True
                start = stop
        return found[back]
