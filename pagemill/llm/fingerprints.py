"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last ``WINDOW`` bytes ends a chunk where it hits a value that the block
size makes rare; every chunk gives one character of the signature. A fingerprint holds
the signatures of its block size and of twice that, so that texts of up to twice the
length compare at a size both have.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import chars
from pagemill.llm.shingles import mix64, span_hashes
from pagemill.sources.scratch import materialize

WINDOW = 7
LONGEST = 64
SMALLEST_BLOCK = 3
# Signatures with no run of this many characters in common are unlike.
COMMON = 7

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = 0x100000001B3


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte, fewer at the start."""
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), data.astype(np.uint64) + np.uint64(1)])
    out = np.zeros(len(data), np.uint64)
    for k in range(WINDOW):
        out += padded[WINDOW - 1 - k : len(padded) - k] * np.uint64(pow(_ROLL, k, 1 << 64))
    return mix64(out) >> np.uint64(32)


def fingerprint(data: np.ndarray) -> str:
    """``block size:signature:signature at twice the block size`` of a text's bytes.

    The block size is the largest of 3, 6, 12 ... whose signature has at least half of
    the ``LONGEST`` characters, or 3; a signature's last character covers the rest of the
    text. Without bytes both signatures are empty.
    """
    if not len(data):
        return f"{SMALLEST_BLOCK}::"
    rolled = _rolling(data)
    size = SMALLEST_BLOCK
    while size * LONGEST < len(data):
        size *= 2

    def ends(block: int) -> np.ndarray:
        return np.flatnonzero(rolled % np.uint64(block) == np.uint64(block - 1))

    found = ends(size)
    while size > SMALLEST_BLOCK and len(found) < LONGEST // 2:
        size //= 2
        found = ends(size)

    def signature(at: np.ndarray) -> str:
        at = at[: LONGEST - 1] + 1
        stops = np.append(at, len(data)) if not len(at) or at[-1] < len(data) else at
        starts = np.append(0, stops[:-1])
        return ALPHABET[(span_hashes(data, starts, stops) & np.uint64(63)).astype(np.int64)].tobytes().decode()

    return f"{size}:{signature(found)}:{signature(ends(2 * size))}"


def _common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair of signatures, by bits:
    a word per pair holds the state of a whole row of the table."""
    n = len(a)
    width = max(map(len, b), default=0)
    masks = np.zeros((n, 128), np.uint64)
    for row, s in enumerate(a):
        for i, c in enumerate(s.encode()):
            masks[row, c] |= np.uint64(1 << i)
    chars_b = np.frombuffer("".join(s.ljust(width, "\0") for s in b).encode(), np.uint8).reshape(n, width)
    state, rows = np.full(n, ~np.uint64(0)), np.arange(n)
    for k in range(width):
        met = state & masks[rows, chars_b[:, k]]
        state = (state + met) | (state - met)
    lengths = np.array([len(s) for s in a], np.uint64)
    used = np.where(lengths == 64, ~np.uint64(0), (np.uint64(1) << (lengths % np.uint64(64))) - np.uint64(1))
    return np.bitwise_count(~state & used).astype(np.int64)


def likeness(first: list[str], second: list[str]) -> np.ndarray:
    """Likeness of pairs of fingerprints, 0 to 1: one less the edit distance (insertions
    and deletions) of their signatures over the characters of both, at the better of the
    block sizes that both have. It is 0 if there is none, or if signatures longer than
    ``COMMON`` have no run of as many characters in common; equal fingerprints have 1."""
    out = np.zeros(len(first))
    rows: list[int] = []
    left: list[str] = []
    right: list[str] = []
    for row, (x, y) in enumerate(zip(first, second)):
        if x == y:
            out[row] = 1.0
            continue
        (bx, *sx), (by, *sy) = x.split(":"), y.split(":")
        at_x = {int(bx): sx[0], 2 * int(bx): sx[1]}
        at_y = {int(by): sy[0], 2 * int(by): sy[1]}
        for size in at_x.keys() & at_y.keys():
            p, q = at_x[size], at_y[size]
            if min(len(p), len(q)) > COMMON:
                runs = {p[i : i + COMMON] for i in range(len(p) - COMMON + 1)}
                if not any(q[i : i + COMMON] in runs for i in range(len(q) - COMMON + 1)):
                    continue
            rows.append(row)
            left.append(p)
            right.append(q)
    if rows:
        both = np.array([len(p) + len(q) for p, q in zip(left, right)])
        np.maximum.at(out, rows, np.where(both > 0, 2 * _common_lengths(left, right) / np.maximum(both, 1), 0))
    return out


def _of(texts: list[str]) -> list[str]:
    return [fingerprint(np.frombuffer(t.encode(), np.uint8)) for t in texts]


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, side int, text string"
)


def edit_probe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row of (doc_id, text).

    The next document follows in descending doc_id, null ids last and equal ids by text
    hash; the first follows the last. A null text is the empty one. Equal rows follow one
    another. An empty table gives no rows, and a single document follows itself.

    Texts are dealt out by ranges of doc_id once. Each task takes its range in order; its
    last document waits for the first of the next range. Those two of every range are
    all that is brought together afterwards.
    """
    text = chars.text_or_empty(F.col("text"))
    rows = docs.select("doc_id", text.alias("text")).withColumn("_key", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_key")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def frame(ids, texts, own, other, nexts, part, side) -> pa.RecordBatch:
        """Rows whose next text is known (side 0), or that wait for it (side 1, no results)."""
        known = side == 0
        new = [edited(t, o) for t, o in zip(texts, other)] if known else texts
        new_prints = _of(new) if known else own
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(new if known else [None] * len(texts), pa.string()),
                pa.array(own, pa.string()),
                pa.array(new_prints, pa.string()),
                pa.array(likeness(own, new_prints)),
                pa.array(likeness(own, nexts if known else own)),
                pa.array([part] * len(texts), pa.int32()),
                pa.array([side] * len(texts), pa.int32()),
                pa.array([None] * len(texts) if known else texts, pa.string()),
            ],
            [c.split()[0] for c in _RESULT.split(", ")],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part, first = None, None, True
        for batch in batches:
            at = 0
            for piece in chars.chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(at, len(piece)).to_pylist()
                at += len(piece)
                texts, part = piece.to_pylist(), batch.column("part")[0].as_py()
                prints = _of(texts)
                if first:
                    yield frame(ids[:1], texts[:1], prints[:1], [], [], part, 2)
                    first = False
                if held is not None:
                    ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
                held = ids[-1], texts[-1], prints[-1]
                if len(texts) > 1:
                    yield frame(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], part, 0)
        if held is not None:
            yield frame([held[0]], [held[1]], [held[2]], [], [], part, 1)

    sha = F.sha2("edited_text", 256).alias("edited_sha256")
    walked = dealt.mapInArrow(walk, _RESULT).select("*", sha).drop("edited_text")
    walked = materialize(walked)

    # One row of each side per range: the ranges, not the documents, are put in order.
    ends = walked.where("side <> 0").groupBy("part").agg(
        *(F.max_by(c, F.when(F.col("side") == side, 1)).alias(f"{c}_{side}") for side in (1, 2) for c in ("doc_id", "text", "fingerprint"))
    )
    ends = materialize(ends)
    parts = sorted(r.part for r in ends.select("part").collect())
    following = dict(zip(parts, [*parts[1:], *parts[:1]]))
    pairs = docs.sparkSession.createDataFrame(list(following.items()), "part int, next_part int")
    last = ends.select("part", F.col("doc_id_1").alias("doc_id"), F.col("text_1").alias("text"), F.col("fingerprint_1").alias("fingerprint"))
    head = ends.select(F.col("part").alias("next_part"), F.col("text_2").alias("next_text"), F.col("fingerprint_2").alias("next_print"))
    met = last.join(pairs, "part").join(head, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            if cols["text"]:
                yield frame(cols["doc_id"], cols["text"], cols["fingerprint"], cols["next_text"], cols["next_print"], 0, 0)

    finished = met.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(finish, _RESULT)
    named = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return walked.where("side = 0").select(named).unionByName(finished.select("*", sha).select(named))
