"""Texts as NumPy byte arrays: slicing of Arrow string columns, word bounds, 64-bit hashes.

Everything works on slices of a bounded number of bytes (one long text may exceed it), so that a worker's memory
does not depend on the batch that Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
U64 = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over an array of unsigned 64-bit integers."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def keyed(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit integers that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_BYTE = keyed(256, 11)
_P = int(0xD6E8FEB86659FD93)
_PINV = pow(_P, -1, 1 << 64)
_powers = np.ones((2, 1), U64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if _powers.shape[1] < n:
        size = max(n, 2 * SLICE_BYTES)
        rows = np.ones((2, size), U64)
        for row, base in zip(rows, (_P, _PINV), strict=True):
            row[1:] = U64(base)
            np.multiply.accumulate(row, out=row)
        if size > 16 * SLICE_BYTES:
            return rows  # one very long text; not kept
        _powers = rows
    return _powers


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most `limit` bytes, or one longer row. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of maximal runs of true bytes; a run never crosses a row's bound."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than 0x20 and 0x09-0x0D."""
    return runs(~IS_SPACE[data], offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span stands."""
    powers = _power_table(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers[0, : len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * powers[1, starts] + (ends - starts).astype(U64))


def row_bounds(row: np.ndarray, n: int) -> np.ndarray:
    """For ascending row numbers: n + 1 positions, where row i has the entries from bounds[i] to bounds[i + 1]."""
    return np.searchsorted(row, np.arange(n + 1))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
