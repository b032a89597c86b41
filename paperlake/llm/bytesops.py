"""Numpy on the raw UTF-8 bytes of a text column, inside Spark tasks.

All functions work on pieces of a batch of about ``PIECE`` bytes, so their
memory does not depend on the batch size; a text longer than that is a piece
of its own and is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1

# [\x20\x09-\x0D], the white space of all word rules here; no byte of a longer UTF-8 sequence is in it.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection of 64-bit integers."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> "Powers":
        if len(self.up) < n:
            size = max(n, PIECE + 1)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return held[at[0]:at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE):
    """Cuts a batch into runs of whole rows of about ``limit`` bytes: (rows, data, offsets)."""
    data, offsets = buffers(batch.column(text))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows, start + 20_000)
        at = offsets[start:stop + 1]
        yield batch.slice(start, stop - start), data[at[0]:at[-1]], at - at[0]
        start = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and one-past-last byte of each word, and the position of its text."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_hash(data: np.ndarray, powers: Powers, table: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Sums from which the hash of every substring follows (see ``span_hash``)."""
    powers.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * powers.up[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts, ends, powers: Powers) -> np.ndarray:
    """64-bit hashes of the byte spans."""
    return mix((sums[ends] - sums[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts, ends, powers: Powers, lower: bool = True) -> np.ndarray:
    return span_hash(prefix_hash(data, powers, BYTE_VALUES[LOWER] if lower else BYTE_VALUES), starts, ends, powers)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values; one shorter by ``width - 1`` than the input."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total = total * _U(0xFF51AFD7ED558CCD) + hashes[j:j + n]
    return mix(total)


def signed(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes).view(np.int64)
