"""Arrays of numbers as binary cells, so that a shuffle moves a few thousand large rows, not one row a number."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray, width: int = 8) -> bytes:
    """The lowest ``width`` bytes of unsigned values, plane by plane (sorted values then compress well)."""
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return pa.compress(np.ascontiguousarray(raw.T).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(cell: bytes, n: int, width: int = 8) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        raw = pa.decompress(cell, n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def cuts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin, then the number of keys."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """The rows of each key in turn, from batches that are sorted by it; null keys come first."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = batch.column(key).to_pylist()
        start = 0
        for at in range(len(values)):
            if not held and at == start:
                current = values[at]
            if values[at] != current:
                if at > start:
                    held.append(batch.slice(start, at - start))
                yield current, pa.Table.from_batches(held)
                held, start, current = [], at, values[at]
        if len(values) > start:
            held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function for ``mapInArrow``; at the end of the task it returns freed memory to the system.

    Workers outlive their tasks, and an idle one would otherwise hold on to the largest arrays it has had.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped
