"""Whole-batch text arithmetic in numpy for the operators that run in Arrow
batches: words, word hashes and shingles of many texts at once.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Hashes are 64-bit, the
same in every process (no per-process seed)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64, at least ``n`` of each."""
    global _POWERS
    if len(_POWERS[0]) < n:
        def up(b):
            out = np.full(max(n, SLICE_BYTES + 1), b, np.uint64)
            out[0] = 1
            return np.cumprod(out)
        _POWERS = (up(_BASE), up(_INVERSE))
    return _POWERS


_POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def string_array(column) -> pa.Array:
    """One large_string array without nulls (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string array; text i is
    bytes[offsets[i]:offsets[i+1]]."""
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer text stands alone),
    so that working arrays stay small whatever the batch holds."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def lower(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set for the bytes of the given closed ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


def words(raw: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of all words, the runs of bytes that ``outside``
    doesn't flag; words never span two rows."""
    if not len(raw):
        e = np.zeros(0, np.int64)
        return e, e, e
    solid = ~outside[raw]
    full = offsets[:-1][np.diff(offsets) > 0]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = solid[:-1]
    before[full] = False
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after[last] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as a large_string array."""
    edge = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=edge[1:])
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    data = raw[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edge), pa.py_buffer(np.ascontiguousarray(data)))


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Running sums of symbol * base^i: any slice's hash in O(1)."""
    pw, _ = powers(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * pw[:len(symbols)], out=out[1:])
    return out


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = prefix_hashes(_BYTE[raw])
    _, inverse = powers(len(raw) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingle_arrays(hashes: np.ndarray, row: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, edge): row i's sorted distinct hashes of its ``width``-word
    shingles are elements[edge[i]:edge[i + 1]]; a row of fewer words gives one
    hash of the whole sequence, a row without words an empty set."""
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    acc = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    odd = mix(np.arange(1, width + 1, dtype=np.uint64)) | U(1)
    for j in range(width):
        acc += hashes[j:len(hashes) - width + 1 + j] * odd[j] if len(acc) else acc
    acc = mix(acc)
    size = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    edge = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(edge[-1]), np.uint64)
    whole = np.where(count >= width, size, 0)
    begin = np.cumsum(whole) - whole
    step = np.arange(int(whole.sum()))
    out[step + np.repeat(edge[:-1] - begin, whole)] = acc[step + np.repeat(first - begin, whole)]
    for i in np.flatnonzero((count > 0) & (count < width)):
        n, a = count[i], first[i]
        part = (hashes[a:a + n] * odd[:n]).sum(dtype=np.uint64, keepdims=True)
        out[edge[i]] = mix(part + U(int(n) * 0xA0761D6478BD642F % 2**64))[0]
    at = edge.tolist()
    for a, z in zip(at, at[1:]):
        out[a:z].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[edge[:-1][size > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[edge]


def shingle_sets(hashes: np.ndarray, row: np.ndarray, n_rows: int, width: int) -> list[np.ndarray]:
    """The sets of ``shingle_arrays``, one by one."""
    out, edge = shingle_arrays(hashes, row, n_rows, width)
    return [out[a:z] for a, z in zip(edge[:-1], edge[1:], strict=True)]


class Lookup:
    """Fixed map from uint64 keys to int64 values, probed in whole arrays
    (open addressing, load at most one half)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys, values = np.asarray(keys, np.uint64), np.asarray(values)
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift, self.mask = U(64 - bits), (1 << bits) - 1
        self.slot = np.full(1 << bits, -1, np.int32)
        self.keys, self.values = keys, values
        at = self._home(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.slot[at[left]] < 0
            self.slot[at[left[free]]] = left[free]
            left = left[self.slot[at[left]] != left]
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys):
        return (mix(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index into ``keys`` of the map, -1 where absent."""
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        at = self._home(keys)
        got = self.slot[at]
        hit = (got >= 0) & (self.keys[got] == keys)
        out[hit] = got[hit]
        left = np.flatnonzero((got >= 0) & ~hit)
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            got = self.slot[at[left]]
            ok = (got >= 0) & (self.keys[got] == keys[left])
            out[left[ok]] = got[ok]
            left = left[(got >= 0) & ~ok]
        return out
