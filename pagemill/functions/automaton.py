"""Which texts contain one of many strings: an Aho-Corasick automaton as arrays.

States are numbered in the order in which they are reached, level by level, so that the
sorted list of (state, byte) steps leads to states 1, 2, 3 and so on, and needs no targets.
"""

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass(frozen=True)
class Automaton:
    """``steps``: state << 8 | byte of every step of the tree, sorted; step i leads to state i + 1.
    ``falls``: of each state, the longest shorter one that its text ends in.
    ``found``: whether a listed string ends in a state or in one that it falls to."""

    steps: np.ndarray
    falls: np.ndarray
    found: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.steps, self.falls, self.found

    def step(self, states: np.ndarray, octets: np.ndarray) -> np.ndarray:
        """The state after one byte more. A state without that step falls back until one has it."""
        out = np.zeros(len(states), np.int64)
        open_ = np.arange(len(states))
        at = states
        while len(open_):
            wanted = at << 8 | octets[open_]
            place = np.minimum(np.searchsorted(self.steps, wanted), len(self.steps) - 1)
            known = self.steps[place] == wanted
            out[open_[known]] = place[known] + 1
            falling = ~known & (at > 0)
            at, open_ = self.falls[at[falling]], open_[falling]
        return out

    def contained(self, texts: pa.Array) -> np.ndarray:
        """Whether each text has a listed string in it, all texts read byte by byte together.
        A text is left as soon as one is found."""
        raw = texts.cast(pa.large_binary())
        bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        hit = np.zeros(len(raw), bool)
        if not len(self.steps):
            return hit
        lengths = np.diff(bounds)
        going = np.argsort(-lengths, kind="stable")
        states, at = np.zeros(len(going), np.int64), 0
        while len(going):
            alive = int(np.searchsorted(-lengths[going], -at))  # those longer than ``at``
            going, states = going[:alive], states[:alive]
            states = self.step(states, data[bounds[going] + at].astype(np.int64))
            ended = self.found[states]
            hit[going[ended]] = True
            going, states = going[~ended], states[~ended]
            at += 1
        return hit


def automaton(strings: Iterable[bytes]) -> Automaton:
    """The automaton of the strings that are not empty."""
    listed = sorted({s for s in strings if s})
    lengths = np.array([len(s) for s in listed], np.int64)
    data = np.frombuffer(b"".join(listed), np.uint8).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    at = np.zeros(len(listed), np.int64)
    levels, n, depth = [], 1, 0
    ends = []
    while (longer := np.flatnonzero(lengths > depth)).size:
        reached, which = np.unique(at[longer] << 8 | data[starts[longer] + depth], return_inverse=True)
        levels.append(reached)
        at[longer] = n + which
        n, depth = n + len(reached), depth + 1
        ends.append(at[lengths == depth])
    steps = np.concatenate(levels) if levels else np.zeros(0, np.int64)
    falls, found = np.zeros(n, np.int64), np.zeros(n, bool)
    found[np.concatenate(ends) if ends else []] = True
    built, first = Automaton(steps, falls, found), 1
    for depth, reached in enumerate(levels):
        own = slice(first, first + len(reached))
        if depth:
            falls[own] = built.step(falls[reached >> 8], reached & 0xFF)
            found[own] |= found[falls[own]]
        first += len(reached)
    return built
