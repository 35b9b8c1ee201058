"""Words of many texts at once, as 64-bit hashes, with numpy over Arrow buffers.

A text is read as its UTF-8 bytes; all separators used here are ASCII, so no character is cut.
A-Z is lower-cased, everything else is kept.  Null texts have no words.  Two words share a hash with a
chance of about 2**-64, which every caller of this module accepts as equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that separate words: space and 0x09-0x0D; or every ASCII byte but digits and letters.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALPHANUMERIC = np.zeros(256, bool)
NOT_ALPHANUMERIC[:128] = True
NOT_ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def noise(first: int, n: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values with the numbers first, first + 1, ..."""
    return mix((np.arange(first, first + n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts and ends in them (nulls are empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most ``limit`` bytes of text, or of one row."""
    _, ends = text_bytes(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _hash_runs(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes, taken eight bytes at a time."""
    eights = np.ndarray((len(data),), "V8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    hashes = mix(length.astype(np.uint64) + np.uint64(1))
    still, left, at, held = np.arange(len(begin)), length, begin, hashes
    while len(still):
        block = eights[at].view("<u8")
        spare = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
        held = mix((held ^ ((block << spare) >> spare)) * _STEP + _STEP)
        hashes[still] = held
        more = left > 8
        still, left, at, held = still[more], left[more] - 8, at[more] + 8, held[more]
    return hashes


class Words:
    """Hashes of all words in order.

    ``starts``: the first word of each text, then the number of words.  ``begin`` and ``end``: where each word lies
    in the joined bytes of all texts; ``bounds``: where each text starts there, then their length.
    """

    def __init__(self, column: pa.Array, separators: np.ndarray = BLANKS):
        data, ends = text_bytes(column)
        data = LOWER[data]
        inside = ~separators[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < ends[1:]]
        first[heads] = inside[heads]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[ends[1:][ends[:-1] < ends[1:]] - 1] = inside[ends[1:][ends[:-1] < ends[1:]] - 1]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hashes = _hash_runs(data, self.begin, self.end - self.begin)
        self.starts, self.bounds = np.searchsorted(self.begin, ends), ends

    def owner(self) -> np.ndarray:
        """The number of each word's text in the column."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def chain(hashes: np.ndarray, n: int, step: np.uint64 = _STEP) -> np.ndarray:
    """A hash of each run of n consecutive values."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total * step + hashes[k : len(hashes) - n + 1 + k])
    return total
