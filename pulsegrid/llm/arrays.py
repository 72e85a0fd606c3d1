"""Text columns as flat byte arrays, and hashes over them, for steps that run inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: rows that travel to a Python worker at a time
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 4_000
#: bytes of text that one step works on at a time; a longer document is a step of its own
STEP_BYTES = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: the bytes 0x09-0x0D and 0x20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values over 64 bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base², ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins and ends; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0]:ends[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def steps(batch: pa.RecordBatch, text: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of text, so that arrays of a step stay small."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    at = 0
    while at < len(column):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def arrow_step(work: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], text: str,
               size: int = STEP_BYTES) -> Callable:
    """``work`` over bounded pieces, in the form ``mapInArrow`` takes. Rows of whole texts are wide, so the session
    sends fewer of them at a time than it does by default."""
    session = SparkSession.getActiveSession()
    if session is not None and int(session.conf.get(BATCH)) > BATCH_ROWS:
        session.conf.set(BATCH, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in steps(batch, text, size):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return run


def space_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: start, end and number of the text of each."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~SPACE[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    starts_text = ends[:-1][ends[:-1] < len(data)]
    first[starts_text] = inside[starts_text]
    start = np.flatnonzero(first)
    # a word runs to the next white space or to the end of its text
    owner = np.searchsorted(ends, start, side="right") - 1
    gaps = np.flatnonzero(~inside)
    end = np.minimum(gaps[np.searchsorted(gaps, start)], ends[owner + 1])
    return start, end, owner


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased word ``data[start:end]``."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[data]] * powers(_BASE, len(data)), out=total[1:])
        return mix((total[end] - total[start]) * powers(_INVERSE, len(data) + 1)[start], 1)


def shingle_sets(data: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``n``-word shingles of each text as sorted hashes: hashes and their text's number.

    A text with fewer words has its whole sequence as its one shingle; without words it has none.
    """
    start, end, owner = space_words(data, ends)
    words = word_hashes(data, start, end)
    count = np.bincount(owner, minlength=len(ends) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    short = (count > 0) & (count < n)
    left = first[owner + 1] - np.arange(len(words))  # words from here to the end of the text
    opens = (left >= n) | (short[owner] & (left == count[owner]))
    at = np.flatnonzero(opens)
    value = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            there = left[at] > k
            value[there] += mix(words[at[there] + k], 2 + k)
    value = mix(value, 1)
    of = owner[at]
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], of[new]
