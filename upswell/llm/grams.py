"""Hashed features of texts, computed with numpy over batches of Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters worked on at once; a longer text is a batch of its own.
BATCH_CHARS = 500_000
_MIX = np.uint32(2654435761)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter (general category L)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def slices(column: pa.Array, limit: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows whose texts have about ``limit`` bytes in all; null is the empty text."""
    if len(column) == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
        yield int(a), [t or "" for t in column.slice(a, b - a).to_pylist()]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as code points, each preceded by a space; the texts' starts (of that space), with the end last."""
    low = [t.lower() for t in texts]
    starts = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in low], out=starts[1:])
    joined = ("".join(" " + t for t in low) + " ").encode("utf-32-le", "replace")
    return np.frombuffer(joined, np.uint32), starts


def char_grams(points: np.ndarray, longest: int, bits: int, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every gram of 1 to ``longest`` characters and the place of its first character.

    Grams of ``whole`` characters (letters by default) may have one other character, taken as a space, at either end
    (word beginnings and ends count), never inside.
    """
    inside = letters()[points] if whole is None else whole
    c = np.where(inside, points, np.uint32(32))
    buckets, places = [], []
    for n in range(1, longest + 1):
        if len(c) < n:
            break
        m = len(c) - n + 1
        h = np.full(m, n * 0x01000193, np.uint32)
        for k in range(n):
            h = (h ^ c[k : k + m]) * _MIX
            h ^= h >> np.uint32(15)
        ok = inside[:m].copy() if n < 3 else inside[1 : 1 + m].copy()
        if n == 2:
            ok |= inside[1 : 1 + m]
        for k in range(2, n - 1):
            ok &= inside[k : k + m]
        at = np.flatnonzero(ok)
        buckets.append((h[at] * _MIX) >> np.uint32(32 - bits))
        places.append(at)
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(places)


def word_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every run of letters and its start."""
    inside = letters()[points]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power = np.cumprod(np.full(len(points) + 1, _BASE, np.uint64))
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    back = np.cumprod(np.full(len(points) + 1, _BACK, np.uint64))
    h = (total[end] - total[start]) * back[start]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32)), start


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of value rows by ascending row number."""
    out = np.zeros((n, values.shape[1]))
    if len(rows):
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[first]] = np.add.reduceat(values, first, axis=0)
    return out
