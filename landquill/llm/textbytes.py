"""Vectorised byte and word helpers used inside Arrow tasks.

A task sees a stream of Arrow batches. ``text_blocks`` cuts each batch into
blocks of whole texts of about ``max_bytes`` so that the working arrays of a
task stay small whatever the batch size is; one longer text forms a block of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of anything but space and \t-\r.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of ASCII letters, digits and anything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and the n + 1 offsets; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_blocks(batch: pa.RecordBatch, text: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of blocks of whole texts."""
    data, offs = text_buffer(batch.column(text))
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
        yield slice(i, j), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_bounds(data: np.ndarray, offs: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the index of its first word (n + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = member[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, int(n).bit_length())
    if size not in _tables:
        _tables.clear()
        pair = []
        for base in (_P, _P_INV):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        _tables[size] = tuple(pair)
    return _tables[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2^64; see ``range_hash``."""
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each values[start:end]; equal contents give equal hashes wherever they stand."""
    _, down = _powers(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for every i; empty segments give 0."""
    c = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=c[1:])
    return c[bounds[1:]] - c[bounds[:-1]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all [start, start + length), on end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def lookup(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in the sorted keys, found) of each value."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values
