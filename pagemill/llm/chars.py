"""Texts of an Arrow batch as code points, and the classes of code points."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 18

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)

# White space other than U+0020, by the Unicode property White_Space.
BLANKS = (
    *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


# Ranges of letters and numbers that came after Unicode 16, the version
# whose classes the public tokenizer libraries use.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)


def text_or_empty(c: Column) -> Column:
    """The text as valid UTF-8; null is the empty text."""
    return F.make_valid_utf8(F.coalesce(c.cast("string"), F.lit("")))


def classes() -> np.ndarray:
    """The class of every code point: letter, number, space, other blank, other.

    The regex package carries newer Unicode tables than the standard library; it is
    asked once per code point here, never about texts.
    """
    table = np.zeros(0x110000, np.uint8)
    # Either side of the surrogates; as a list of characters they would take 100 MB.
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = np.arange(low, high, dtype="<u4").tobytes().decode("utf-32-le")
        for kind, prop in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for found in regex.finditer(prop, every):
                table[low + found.start() : low + found.end()] = kind
    for low, high in LATER:
        table[low : high + 1] = OTHER
    table[list(BLANKS)] = BLANK
    table[ord(" ")] = SPACE
    return table


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``most`` bytes, each of one text at least."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(sizes[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield texts.slice(at, stop - at)
        at = stop
    # Workers live on between stages; what Arrow holds for later would add to the next one's peak.
    pa.default_memory_pool().release_unused()


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts joined, and where each text starts and the last one ends."""
    binary = texts.cast(pa.large_binary())
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the byte at which each starts, with the end last."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(points) + 1, np.int64)
    if len(points) == len(data):
        starts[:] = np.arange(len(points) + 1)
    else:
        widths = 1 + (points > 0x7F).view(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
        np.cumsum(widths, out=starts[1:])
    return points, starts
