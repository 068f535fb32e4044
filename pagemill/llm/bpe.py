"""Byte-level BPE: whole texts to token ids and back.

Texts are cut into pieces without a regular expression. Every code point becomes a
symbol: its class and what the pattern may look ahead to. A symbol is a function
from scan state to scan state; functions compose associatively, so the state
before every code point comes from a blocked prefix scan over numpy arrays. The
pieces are slices of the batch's own bytes; each distinct one is merged once and
kept in a cache.
"""

import base64
import heapq
from collections.abc import Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from pagemill.llm import chars
from pagemill.llm.chars import BLANK, LETTER, NUMBER, SPACE
from pagemill.llm.names import unused

# Symbols: letter, number, other, apostrophe that starts a contraction of one or of
# two letters, the last blank of a run before a visible character (space or other),
# and any other blank.
_LETTER, _NUMBER, _OTHER, _SHORT, _LONG, _LAST_SPACE, _LAST_BLANK, _BLANK = range(8)
_SYMBOLS = 8
# States: at a boundary, within letters, numbers, others or blanks, after a space that
# joins what follows, and with one or two letters of a contraction to come.
_NEW, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _JOINING, _IN_BLANKS, _ONE_MORE, _TWO_MORE = range(8)
_STATES = 8

# The contractions of the pattern.
_ONE_LETTER = "stmd"
_TWO_LETTERS = ("re", "ve", "ll")

# Pieces kept with their ids, and the longest piece kept.
CACHED_PIECES = 60_000
CACHED_BYTES = 48

DECODED_ROWS = 256

_NONE = np.int64(1 << 40)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """State after a symbol, and whether a piece starts at it."""
    if state in (_ONE_MORE, _TWO_MORE):
        return (_NEW if state == _ONE_MORE else _ONE_MORE), False
    runs = {_LETTER: _IN_LETTERS, _NUMBER: _IN_NUMBERS, _OTHER: _IN_OTHERS}
    if symbol in (_SHORT, _LONG):
        if state in (_IN_OTHERS, _JOINING):
            return _IN_OTHERS, False
        return (_ONE_MORE if symbol == _SHORT else _TWO_MORE), True
    if symbol in runs:
        return runs[symbol], state not in (runs[symbol], _JOINING)
    if symbol == _BLANK:
        return _IN_BLANKS, state != _IN_BLANKS
    return (_JOINING if symbol == _LAST_SPACE else _NEW), True


def scan_tables() -> tuple[np.ndarray, ...]:
    """(next state, starts a piece) by state and symbol, and the functions that symbols
    compose to: product of two functions, value of a function at a state, function of
    a symbol. About 300 functions are all there are.

    A symbol of 8 or more is the first of its text: it acts as if at a boundary.
    """
    table = [[_step(s if symbol < _SYMBOLS else _NEW, symbol % _SYMBOLS) for symbol in range(2 * _SYMBOLS)] for s in range(_STATES)]
    after = np.array([[x[0] for x in row] for row in table], np.uint8)
    begins = np.array([[x[1] for x in row] for row in table], bool)
    begins[:, _SYMBOLS:] = True
    known = [tuple(range(_STATES)), *dict.fromkeys(tuple(after[:, k]) for k in range(2 * _SYMBOLS))]
    index = {f: i for i, f in enumerate(known)}
    for f in known:  # grows while it is read
        for k in range(2 * _SYMBOLS):
            g = tuple(after[s, k] for s in f)
            if g not in index:
                index[g] = len(known)
                known.append(g)
    values = np.array(known, np.uint8)
    product = np.array([[index[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    functions = np.array([index[tuple(after[:, k])] for k in range(2 * _SYMBOLS)], np.uint16)
    return after, begins, product, values, functions


def piece_starts(symbols: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether a piece starts at each symbol."""
    after, begins, product, values, functions = tables
    n = len(symbols)
    if not n:
        return np.zeros(0, bool)
    width = max(1, int(n**0.5) // 4)
    columns = -(-n // width)
    padded = np.zeros(columns * width, np.uint8)
    padded[:n] = symbols
    steps = np.ascontiguousarray(padded.reshape(columns, width).T)
    whole = np.zeros(columns, np.uint16)  # function 0 is the identity
    for step in steps:
        whole = product[whole, functions[step]]
    shift = 1
    while shift < columns:  # prefix products of the blocks, doubling the span
        whole[shift:] = product[whole[:-shift], whole[shift:]].copy()
        shift *= 2
    state = np.full(columns, _NEW, np.uint8)
    state[1:] = values[whole[:-1], _NEW]
    out = np.empty(steps.shape, bool)
    for k, step in enumerate(steps):
        out[k] = begins[state, step]
        state = after[state, step]
    return out.T.reshape(-1)[:n]


def text_symbols(points: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``firsts`` marks the first of each text."""
    n = len(points)
    kinds = classes[points]
    last = np.empty(n, bool)
    last[:-1], last[-1:] = firsts[1:], True
    blank = kinds >= SPACE
    seen_next = np.zeros(n, bool)
    seen_next[:-1] = ~blank[1:]
    seen_next &= ~last
    by_kind = np.array([_OTHER, _LETTER, _NUMBER, _BLANK, _BLANK], np.uint8)
    symbols = by_kind[kinds]
    symbols[(kinds == SPACE) & seen_next] = _LAST_SPACE
    symbols[(kinds == BLANK) & seen_next] = _LAST_BLANK
    quotes = np.flatnonzero((points == ord("'")) & ~last)
    one = points[quotes + 1]
    symbols[quotes[np.isin(one, [ord(c) for c in _ONE_LETTER])]] = _SHORT
    room = quotes[quotes + 2 < n]
    room = room[~last[room + 1]]
    pairs = points[room + 1].astype(np.int64) << 32 | points[room + 2]
    symbols[room[np.isin(pairs, [ord(a) << 32 | ord(b) for a, b in _TWO_LETTERS])]] = _LONG
    symbols[firsts] += _SYMBOLS
    return symbols


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank merges first, the leftmost of equals."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0: no part starts here
    before = list(range(-1, n - 1))
    offered = [-1] * n

    def offer(i: int) -> None:
        j = end[i]
        rank = ranks.get(piece[i : end[j]]) if j < n else None
        offered[i] = -1 if rank is None else rank
        if rank is not None:
            heapq.heappush(heap, (rank, i))

    heap: list[tuple[int, int]] = []
    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i = heapq.heappop(heap)
        if offered[i] != rank:
            continue
        j = end[i]
        end[i], end[j], offered[j] = end[j], 0, -1
        if end[i] < n:
            before[end[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def joining_pairs(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens that joins to a token, in order, and that token."""
    ranks = {t: i for i, t in enumerate(tokens)}
    joins = {}
    for rank, token in enumerate(tokens):
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                joins[left << 32 | right] = rank
    keys = sorted(joins)
    return np.array(keys, np.int64), np.array([joins[k] for k in keys], np.int64)


def find_pairs(pairs: tuple[np.ndarray, np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of tokens, or ``_NONE``."""
    keys, ranks = pairs
    wanted = left << 32 | right
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ranks[at], _NONE)


def merge_pieces(pieces: list[bytes], pairs: tuple[np.ndarray, np.ndarray], byte_ids: np.ndarray) -> list[list[int]]:
    """Ids of many short pieces: in each round, every piece merges its leftmost pair
    of lowest rank."""
    tokens = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    ended = np.append(owner[1:] != owner[:-1], True)
    ranks = np.where(ended, _NONE, find_pairs(pairs, tokens, np.append(tokens[1:], 0)))
    done_tokens, done_owner = [], []
    while len(tokens):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        counts = np.diff(np.append(starts, len(owner)))
        best = np.repeat(np.minimum.reduceat(ranks, starts), counts)
        going = best < _NONE
        done_tokens.append(tokens[~going])
        done_owner.append(owner[~going])
        tokens, owner, ranks, best = tokens[going], owner[going], ranks[going], best[going]
        hits = np.flatnonzero(ranks == best)
        at = hits[np.append(True, owner[hits][1:] != owner[hits][:-1])[: len(hits)]]
        tokens[at] = ranks[at]
        kept = np.ones(len(tokens), bool)
        kept[at + 1] = False
        at = np.cumsum(kept)[at] - 1
        tokens, owner, ranks = tokens[kept], owner[kept], ranks[kept]
        changed = np.concatenate([at, at[at > 0] - 1])
        after = np.minimum(changed + 1, len(tokens) - 1)
        joined = (after > changed) & (owner[after] == owner[changed])
        ranks[changed] = np.where(joined, find_pairs(pairs, tokens[changed], tokens[after]), _NONE)
    tokens, owner = np.concatenate(done_tokens), np.concatenate(done_owner)
    tokens = tokens[np.argsort(owner, kind="stable")].tolist()
    ends = np.cumsum(np.bincount(owner, minlength=len(pieces))).tolist()
    return [tokens[i:j] for i, j in zip([0, *ends], ends)]


class Vocabulary:
    """Token bytes by rank, and the tables made of them."""

    def __init__(self, tokens: list[bytes], tables: dict | None = None):
        self.tokens = tokens
        self.tables = tables or {
            "tokens": tokens,
            "pairs": joining_pairs(tokens),
            "scan": scan_tables(),
            "classes": chars.classes(),
        }
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.arrow = pa.array(tokens, pa.binary())
        self.kept: dict[bytes, list[int]] = {}

    @staticmethod
    def shipped(tables: dict) -> "Vocabulary":
        """The vocabulary of broadcast tables, one for each worker, with its cache."""
        if "vocabulary" not in tables:
            tables["vocabulary"] = Vocabulary(tables["tokens"], tables)
        return tables["vocabulary"]

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of distinct pieces, those of the cache and those merged now."""
        found = [self.kept.get(p) for p in pieces]
        new = [i for i, ids in enumerate(found) if ids is None]
        short = []
        for i in new:
            if pieces[i] in self.ranks or len(pieces[i]) > CACHED_BYTES:
                found[i] = merge_piece(pieces[i], self.ranks)
            else:
                short.append(i)
        if short:
            for i, ids in zip(short, merge_pieces([pieces[i] for i in short], self.tables["pairs"], self.byte_ids)):
                found[i] = ids
        if len(self.kept) + len(new) > CACHED_PIECES:
            self.kept.clear()
        self.kept.update((pieces[i], found[i]) for i in new if len(pieces[i]) <= CACHED_BYTES)
        return found


def read_vocabulary(path: str) -> Vocabulary:
    """A rank file of the driver: lines of a token in base64 and its rank, from 0
    without gaps. It has about a megabyte and is shipped to the executors once."""
    lines = [line.split() for line in Path(path).read_bytes().splitlines() if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in lines)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return Vocabulary([t for _, t in ranked])


def encode_texts(texts: pa.Array, vocabulary: Vocabulary) -> pa.StructArray:
    """(ids, starts) of each text: its tokens, and the byte at which each one starts."""
    data, bounds = chars.raw(texts)
    points, byte_at = chars.code_points(data)
    firsts = np.zeros(len(points), bool)
    begin = np.searchsorted(byte_at, bounds)
    firsts[begin[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(piece_starts(text_symbols(points, firsts, vocabulary.tables["classes"]), vocabulary.tables["scan"]))
    offsets = np.append(byte_at[starts], len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).dictionary_encode()
    merged = vocabulary.ids(pieces.dictionary.to_pylist())
    counts = np.fromiter(map(len, merged), np.int64, len(merged))
    flat = np.fromiter(chain.from_iterable(merged), np.int32, int(counts.sum()))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), flat)
    ids = lists.take(pieces.indices).flatten().to_numpy()
    lengths = vocabulary.lengths[ids]
    token_at = np.cumsum(lengths) - lengths
    per_piece = np.append(0, np.cumsum(counts[pieces.indices.to_numpy()]))
    of_text = per_piece[np.searchsorted(offsets[:-1], bounds)]
    relative = token_at - np.repeat(bounds[:-1], np.diff(of_text))
    rows = pa.array(of_text, pa.int32())
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(rows, ids), pa.ListArray.from_arrays(rows, relative.astype(np.int32))],
        names=["ids", "starts"],
    )


def decode_ids(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    """The bytes that each list of ids stands for."""
    joined = tokens.take(lists.flatten())
    ends = np.frombuffer(joined.cast(pa.large_binary()).buffers()[1], np.int64)
    rows = lists.offsets.to_numpy().astype(np.int64)
    offsets = ends[rows - rows[0]]
    data = joined.cast(pa.large_binary()).buffers()[2]
    return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets), data])


_PARTS = {"ids": "array<int>", "starts": "array<int>", "packed": "binary", "decoded": "binary"}


def encode(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", parts: Sequence[str] = ("ids", "starts")
) -> DataFrame:
    """``df`` with the parts asked for of its whole texts; no shuffle.

    ``ids`` are the tokens and ``starts`` the bytes at which they start, ``packed`` is
    the ids as unsigned 32-bit integers with the lowest byte first, and ``decoded``
    the bytes that the ids, decoded again, stand for. All of them take one Python pass.

    A null or empty text has no tokens. Malformed UTF-8 is read as U+FFFD. Every
    length is encoded: a text is one row of a batch, and a piece of any length is
    merged with a heap. Columns of these names are replaced.
    """
    shipped = df.sparkSession.sparkContext.broadcast(vocabulary.tables)

    @arrow_udf("struct<" + ",".join(f"{p}:{_PARTS[p]}" for p in parts) + ">")
    def run(texts: pa.Array) -> pa.Array:
        own = Vocabulary.shipped(shipped.value)
        done = []
        for part in chars.chunks(texts):
            coded = encode_texts(part, own)
            made = {"ids": coded.field("ids"), "starts": coded.field("starts")}
            if "packed" in parts:
                made["packed"] = little_endian(coded.field("ids"))
            if "decoded" in parts:
                made["decoded"] = decode_ids(coded.field("ids"), own.arrow).cast(pa.binary())
            done.append(pa.StructArray.from_arrays([made[p] for p in parts], names=list(parts)))
        return pa.concat_arrays(done)

    (made,) = unused(df, "_coded")
    coded = df.withColumn(made, run(chars.text_or_empty(F.col(text))))
    return coded.withColumns({p: F.col(f"{made}.{p}") for p in parts}).drop(made)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of its ids; null ids decode to no bytes."""
    shipped = df.sparkSession.sparkContext.broadcast(vocabulary.tables)

    @arrow_udf(BinaryType())
    def run(lists: pa.Array) -> pa.Array:
        own = Vocabulary.shipped(shipped.value)
        done = [decode_ids(lists.slice(i, DECODED_ROWS), own.arrow) for i in range(0, len(lists), DECODED_ROWS)]
        return pa.concat_arrays(done).cast(pa.binary())

    return df.withColumn("decoded", run(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def little_endian(lists: pa.Array) -> pa.Array:
    """Ids as unsigned 32-bit integers, the lowest byte first."""
    rows = lists.offsets.to_numpy().astype(np.int64)
    values = np.ascontiguousarray(lists.flatten().to_numpy(), "<i4")
    offsets = ((rows - rows[0]) * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
