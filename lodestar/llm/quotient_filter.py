"""Counting quotient filters of packed n-grams, without loss.

An n-gram of k word ids of ``bits`` bits is packed into lanes of at most 63
bits. A keyed permutation of the lanes, each in turn combined with a hash of the
others, spreads the keys evenly and can be undone. The top bits of a permuted key are
its quotient, all others its remainder, so that filters count exactly: a
key can be restored from its place and its remainder.

A filter holds the keys of one range of quotients (those with given top bits),
sorted: one bit per quotient that has a run of keys, one bit per key that ends
its run, the remainders in whole bytes per lane, and a byte per count, with
counts of 255 and more behind them. Sorted filters of the same range are merged
by their permuted keys, whatever their number of quotient bits."""

from __future__ import annotations

import struct

import numpy as np

from . import textnum as T

U = np.uint64
PASSES = 2
_HEAD = struct.Struct("<qB")
_BIG = 255


class Packing:
    """The packing and the permutation of n-grams of ``k`` ids of ``bits`` bits."""

    def __init__(self, k: int, bits: int):
        per = max(1, 63 // bits)
        lanes = max(2, -(-k // per))
        self.k, self.bits = k, bits
        self.sizes = [k // lanes + (i < k % lanes) for i in range(lanes)]
        self.widths = [n * bits for n in self.sizes]

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        out, at = [], 0
        for n in self.sizes:
            lane = np.zeros(len(ids[0]), np.uint64)
            for one in ids[at:at + n]:
                lane = (lane << U(self.bits)) | one.astype(np.uint64)
            out.append(lane)
            at += n
        return out

    def unpack(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        mask = U((1 << self.bits) - 1)
        return [((lane >> U((n - 1 - i) * self.bits)) & mask).astype(np.int64)
                for n, lane in zip(self.sizes, lanes, strict=True) for i in range(n)]

    def _shift(self, lanes, i: int, r: int) -> np.ndarray:
        x = U((r * 64 + i + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for j, lane in enumerate(lanes):
            if j != i:
                x = T.mix(lane + x)
        return x >> U(64 - self.widths[i])

    def permute(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        lanes = list(lanes)
        for r in range(PASSES):
            for i in range(len(lanes)):
                lanes[i] = lanes[i] ^ self._shift(lanes, i, r)
        return lanes

    def restore(self, lanes: list[np.ndarray]) -> list[np.ndarray]:
        lanes = list(lanes)
        for r in reversed(range(PASSES)):
            for i in reversed(range(len(lanes))):
                lanes[i] = lanes[i] ^ self._shift(lanes, i, r)
        return lanes

    def _words(self, lanes) -> list[np.ndarray]:
        """The lanes joined into as few 64-bit words as hold them."""
        out, free = [], 0
        for lane, width in zip(lanes, self.widths, strict=True):
            if width <= free:
                out[-1] = (out[-1] << U(width)) | lane
                free -= width
            else:
                out.append(lane)
                free = 64 - width
        return out

    def count(self, lanes: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Sorted distinct keys with their summed counts (1 each by default)."""
        words = self._words(lanes)
        by = np.argsort(words[0], kind="stable") if len(words) == 1 else np.lexsort(words[::-1])
        new = np.zeros(len(by), bool)
        new[:1] = True
        for w in words:
            w = w[by]
            new[1:] |= w[1:] != w[:-1]
        head = np.flatnonzero(new)
        if counts is None:
            total = np.diff(np.append(head, len(by)))
        else:
            total = np.add.reduceat(counts[by], head) if len(head) else np.zeros(0, np.int64)
        return [x[by[head]] for x in lanes], total


def encode(packing: Packing, lanes: list[np.ndarray], counts: np.ndarray, top: int) -> bytes:
    """A filter of sorted distinct permuted keys that agree in ``top`` bits."""
    n, first = len(counts), packing.widths[0]
    q = min(first, top + max(0, n - 1).bit_length())
    quotient = (lanes[0] >> U(first - q)) & U((1 << (q - top)) - 1)
    occupied = np.zeros(1 << (q - top), bool)
    occupied[quotient.astype(np.int64)] = True
    ends = np.ones(n, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    out = [_HEAD.pack(n, q), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes()]
    for i, (lane, width) in enumerate(zip(lanes, packing.widths, strict=True)):
        width -= q if i == 0 else 0
        rest = lane & U((1 << width) - 1)
        out.append(rest.astype("<u8").view(np.uint8).reshape(n, 8)[:, :-(-width // 8)].tobytes())
    out.append(np.minimum(counts, _BIG).astype(np.uint8).tobytes())
    out.append(counts[counts >= _BIG].astype("<i8").tobytes())
    return b"".join(out)


def decode(packing: Packing, data: bytes, top: int, head: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(permuted keys, counts) of a filter, whose keys' top bits are ``head``."""
    n, q = _HEAD.unpack_from(data)
    raw, at, first = np.frombuffer(data, np.uint8), _HEAD.size, packing.widths[0]

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size:at]

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << (q - top)) // 8)), count=1 << (q - top)))
    ends = np.unpackbits(take(-(-n // 8)), count=n).astype(np.int64)
    quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64) | U(head << (q - top))
    lanes = []
    for i, width in enumerate(packing.widths):
        width -= q if i == 0 else 0
        size = -(-width // 8)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = take(n * size).reshape(n, size)
        lanes.append(wide.view("<u8").reshape(n).astype(np.uint64))
    lanes[0] |= quotient << U(first - q)
    counts = take(n).astype(np.int64)
    big = counts == _BIG
    counts[big] = take(8 * int(big.sum())).view("<i8")
    return lanes, counts


def segments(packing: Packing, lanes: list[np.ndarray], counts: np.ndarray, top: int) -> list[tuple[int, bytes]]:
    """(range, filter) of sorted distinct permuted keys, cut at their ``top`` bits."""
    head = (lanes[0] >> U(packing.widths[0] - top)).astype(np.int64)
    cut = np.flatnonzero(np.diff(head, prepend=-1))
    return [(int(head[a]), encode(packing, [x[a:b] for x in lanes], counts[a:b], top))
            for a, b in zip(cut, np.append(cut[1:], len(head)), strict=True)]


def merge(packing: Packing, filters: list[bytes], top: int, head: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The merged (permuted keys, counts) of filters of one range."""
    parts = [decode(packing, f, top, head) for f in filters]
    if len(parts) == 1:
        return parts[0]
    return packing.count([np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)],
                         np.concatenate([p[1] for p in parts]))
