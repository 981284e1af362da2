"""Texts as UTF-8 bytes in numpy: rows of Arrow batches, words, and hashes of stretches of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


def octets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the rows' offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse for i < n, modulo 2**64."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _BACK, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Stretches:
    """Hashes of any stretch of a sequence of 64-bit numbers; equal stretches have equal hashes."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values) * up[:-1], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.total[end] - self.total[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, row and hash of every run of bytes that are not white space; A-Z count as a-z if ``fold_case``."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    full = offsets[:-1][np.diff(offsets) > 0]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:], after[:-1] = space[:-1], space[1:]
        before[full] = True
        after[full[1:] - 1] = True
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    low = data.astype(np.uint64)
    if fold_case:
        low += np.where((data >= 65) & (data <= 90), np.uint64(32), np.uint64(0))
    return start, np.searchsorted(offsets, start, side="right") - 1, Stretches(low)(start, end)
