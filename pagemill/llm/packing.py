"""Packing documents into training sequences of balanced attention cost.

A sequence costs its tokens, and the square of every document's share of it, since
tokens attend within their document only. Documents go in descending order to the
sequence of lowest cost that has room for them. Sequences of a pool have, together, room
for exactly its tokens: full ones, and for the rest one for each power of two in it, so
that nothing is padded. A document that fits nowhere whole is cut.

Tokens come from the ``tokenizers`` library, which is asked about every distinct piece
of a batch once: white space, and the border of an ASCII word, part what it encodes.
"""

import os
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from pagemill.llm import chars, slices

CAPACITY = 4096
# The id after each document.
END = 2
# Tokens packed together: what a task holds besides the batch that it reads.
POOL_TOKENS = 1 << 20
# A token costs as much as attention to so many others: six times the width of the model.
LINEAR = 6 * 4096
# Distinct pieces kept with their ids, and the longest piece kept.
CACHED_PIECES = 500_000
CACHED_BYTES = 32
# Bytes of text encoded at once.
CHUNK_BYTES = 1 << 21

_GAP, _ALNUM, _MARK, _OTHER = range(4)


def byte_kinds() -> np.ndarray:
    """Of each byte: white space, ASCII letter or digit, ASCII mark that parts words, other.

    An apostrophe may belong to a contraction and parts nothing, nor does a byte of a
    code point beyond ASCII, which may combine with what is next to it.
    """
    kinds = np.full(256, _OTHER, np.uint8)
    for byte in range(128):
        if chr(byte).isspace() and not 0x1C <= byte <= 0x1F:
            kinds[byte] = _GAP
        elif chr(byte).isalnum():
            kinds[byte] = _ALNUM
        elif 0x20 < byte < 0x7F and byte != ord("'"):
            kinds[byte] = _MARK
    return kinds


class Encoder:
    """A tokenizer with the ids of pieces seen before."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kinds = byte_kinds()
        self.kept: dict[bytes, list[int]] = {}

    @staticmethod
    def shipped(tables: dict) -> "Encoder":
        """The encoder of broadcast tables, one for each worker, with its cache."""
        if "encoder" not in tables:
            tables["encoder"] = Encoder(tables["model"])
        return tables["encoder"]

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        found = [self.kept.get(p) for p in pieces]
        new = [i for i, ids in enumerate(found) if ids is None]
        texts = [pieces[i].decode("utf-8") for i in new]
        for i, coded in zip(new, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[i] = coded.ids
        if len(self.kept) + len(new) > CACHED_PIECES:
            self.kept.clear()
        self.kept.update((pieces[i], found[i]) for i in new if len(pieces[i]) <= CACHED_BYTES)
        return found

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, each text's followed by ``end``, and where each starts."""
        data, bounds = chars.raw(texts)
        kinds = self.kinds[data]
        follows = np.append(data[1:], 0) > 0x7F
        follows[bounds[1:][bounds[1:] > 0] - 1] = False
        # A capital before a combining mark may have no composed form where the small letter has one.
        capital = (data >= ord("A")) & (data <= ord("Z")) & ~follows
        lower = data | (capital.view(np.uint8) << 5)
        breaks = slices.text_starts(len(data), bounds)
        before, after = kinds[:-1], kinds[1:]
        breaks[1:] |= ((before == _ALNUM) & (after == _MARK)) | ((before == _MARK) & (after == _ALNUM))
        pieces, starts = slices.cut(lower, kinds != _GAP, breaks)
        coded = pieces.dictionary_encode()
        merged = self.ids(coded.dictionary.to_pylist())
        counts = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter(chain.from_iterable(merged), np.int32, int(counts.sum()))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), flat)
        ids = lists.take(coded.indices).flatten().to_numpy()
        per_piece = np.append(0, np.cumsum(counts[coded.indices.to_numpy()]))
        ends = per_piece[np.searchsorted(starts, bounds)]
        return np.insert(ids, ends[1:], end), ends + np.arange(len(ends))


def cost(length: np.ndarray | int) -> np.ndarray | int:
    """Linear and quadratic cost of a document's tokens within one sequence."""
    return LINEAR * length + length * length


def rooms(tokens: int, capacity: int) -> np.ndarray:
    """Sizes of sequences that hold ``tokens`` exactly: full ones, and powers of two."""
    rest = tokens % capacity
    parts = [1 << i for i in reversed(range(rest.bit_length())) if rest >> i & 1]
    return np.array([capacity] * (tokens // capacity) + parts, np.int64)


def assign(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (document, start, length, sequence, offset), by sequence and offset, of documents
    of the given tokens.

    What fills whole sequences of a long document is cut off first. Then every document, the
    longest first, goes to the sequence of lowest cost with room for all of it; without
    one, it fills what has most room and goes on with the rest.
    """
    whole = lengths // capacity
    full = np.repeat(np.arange(len(lengths)), whole)
    turn = np.arange(len(full)) - np.repeat(np.cumsum(whole) - whole, whole)
    placed = [
        np.stack([full, turn * capacity, np.full_like(full, capacity), np.arange(len(full)), np.zeros_like(full)], axis=1)
    ]
    left = lengths - whole * capacity
    room = rooms(int(left.sum()), capacity)
    size, spent = room.copy(), np.zeros(len(room), np.int64)
    costs = cost(np.arange(capacity + 1)).tolist()
    none = np.iinfo(np.int64).max
    rows = []
    for doc in np.argsort(-left, kind="stable").tolist():
        rest, start = int(left[doc]), int(whole[doc]) * capacity
        while rest:
            at = int(np.where(room >= rest, spent, none).argmin())
            part = rest
            if room[at] < rest:
                at = int(room.argmax())
                part = int(room[at])
            rows.append((doc, start, part, len(full) + at, int(size[at] - room[at])))
            room[at] -= part
            spent[at] += costs[part]
            start, rest = start + part, rest - part
    placed.append(np.array(rows, np.int64).reshape(-1, 5))
    out = np.concatenate(placed)
    return out[np.lexsort((out[:, 4], out[:, 3]))]


def read_model(path: str) -> str:
    """A tokenizer file of the driver, shipped to the executors once."""
    return Path(path).read_text(encoding="utf-8")


def pack(
    docs: DataFrame,
    model: str,
    capacity: int = CAPACITY,
    end: int = END,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """(doc_id, start, length, packed, doc_tokens, sequence_id, offset) of every piece of the
    documents (doc_id, text); no shuffle.

    ``model`` is the tokenizer as JSON, see ``read_model``. ``packed`` holds the piece's ids as
    unsigned 32-bit integers, the lowest byte first; ``doc_tokens`` counts the document's
    ids, with ``end``. Sequences are filled pool by pool of about ``pool_tokens``, within a
    partition; a longer document is a pool of its own with what came before it.

    A null or empty text has the id ``end`` only. Null and repeated ids are rows like any
    other. Malformed UTF-8 is read as U+FFFD. Further columns are not read. An empty table
    gives no rows. The same partitions give the same sequences, so a lost task is redone alike.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("sequences must hold a power of two of tokens")
    shipped = docs.sparkSession.sparkContext.broadcast({"model": model})
    read = docs.select("doc_id", chars.text_or_empty(F.col("text")).alias("text"))
    longs = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = StructType(
        [read.schema["doc_id"], *(StructField(n, LongType()) for n in longs), StructField("packed", BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shipped(shipped.value)
        first = TaskContext.get().partitionId() << 33
        doc_ids, ids, lengths, held = [], [], [], 0

        def packed_pool() -> pa.RecordBatch:
            nonlocal first, held
            sizes, tokens = np.concatenate(lengths), np.concatenate(ids).astype("<i4")
            begins = np.cumsum(sizes) - sizes
            rows = assign(sizes, capacity)
            doc, start, length, sequence, offset = rows.T
            ends = np.cumsum(length)
            order = np.repeat(begins[doc] + start - (ends - length), length) + np.arange(len(tokens))
            data = np.ascontiguousarray(tokens[order])
            bounds = np.append(0, ends * 4)
            kind = pa.binary() if bounds[-1] < 1 << 31 else pa.large_binary()
            wide = np.int32 if kind == pa.binary() else np.int64
            packed = pa.Array.from_buffers(kind, len(rows), [None, pa.py_buffer(bounds.astype(wide)), pa.py_buffer(data)])
            known = pa.concat_arrays(doc_ids).take(pa.array(doc))
            columns = [known, *map(pa.array, (start, length, sizes[doc], first + sequence, offset)), packed]
            first += int(sequence[-1]) + 1
            doc_ids.clear(), ids.clear(), lengths.clear()
            held = 0
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            at = 0
            for part in chars.chunks(batch.column(1), CHUNK_BYTES):
                tokens, starts = encoder.encode(part, end)
                doc_ids.append(batch.column(0).slice(at, len(part)))
                ids.append(tokens)
                lengths.append(np.diff(starts))
                at, held = at + len(part), held + len(tokens)
                if held >= pool_tokens:
                    yield packed_pool()
        if held:
            yield packed_pool()

    return read.mapInArrow(run, schema)
