"""Hashes of many byte slices of one buffer at once, in NumPy.

``Lanes`` gives the 8 bytes from each place of a buffer on as one number, so
a slice's hash takes one gather for 8 bytes.  ``xxh64`` is the published
64-bit xxHash with seed 0 (slices of one length advance together); ``Crc``
joins CRC-32 values of neighbouring slices without their bytes.  Tests hold
both against the libraries.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

# The five primes of 64-bit xxHash.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
LONG = 160  # longer slices go to the library, one by one
POLYNOMIAL = 0xEDB88320  # of CRC-32, reversed


class Lanes:
    """A buffer that ends with 8 spare bytes."""

    def __init__(self, buf: np.ndarray) -> None:
        self.bytes = buf.tobytes()
        self.at = np.ascontiguousarray(np.ndarray(len(buf) - 7, "<u8", self.bytes, strides=(1,)))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the slices at ``a`` and at ``b`` of these lengths agree."""
        out = np.ones(len(a), bool)
        live, done = np.flatnonzero(a != b), 0
        while len(live):
            left = length[live] - done
            spare = np.maximum(8 - left, 0).astype(np.uint64) << np.uint64(3)
            differ = (self.at[a[live] + done] ^ self.at[b[live] + done]) << spare
            out[live] = same = differ == 0
            live, done = live[same & (left > 8)], done + 8
        return out


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def _xxh64(lanes: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the slices of ``n`` bytes at ``start``."""
    at = 0
    if n >= 32:
        acc = [np.full(len(start), s) for s in (P1 + P2, P2, np.uint64(0), ~P1 + np.uint64(1))]
        while n - at >= 32:
            acc = [_round(a, lanes[start + at + 8 * i]) for i, a in enumerate(acc)]
            at += 32
        h = sum(_turn(a, bits) for a, bits in zip(acc, (1, 7, 12, 18), strict=True))
        for a in acc:
            h = (h ^ _round(np.uint64(0), a)) * P1 + P4
    else:
        h = np.full(len(start), P5)
    h = h + np.uint64(n)
    while n - at >= 8:
        h = _turn(h ^ _round(np.uint64(0), lanes[start + at]), 27) * P1 + P4
        at += 8
    if at < n:
        rest = lanes[start + at]
        if n - at >= 4:
            h = _turn(h ^ (rest & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
            rest, at = rest >> np.uint64(32), at + 4
        for _ in range(n - at):
            h = _turn(h ^ (rest & np.uint64(255)) * P5, 11) * P1
            rest = rest >> np.uint64(8)
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxh64(lanes: Lanes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The 64-bit xxHash of each slice."""
    out = np.zeros(len(start), np.uint64)
    order = np.argsort(np.minimum(length, LONG + 1).astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(np.minimum(length, LONG + 1)[order], prepend=-1))
    with np.errstate(over="ignore"):
        for a, b in zip(first, [*first[1:], len(order)], strict=True):
            of = order[a:b]
            n = int(length[of[0]])
            if n <= LONG:
                out[of] = _xxh64(lanes.at, start[of], n)
            else:
                out[of] = [xxhash.xxh64_intdigest(lanes.bytes[s: s + k]) for s, k in zip(start[of], length[of], strict=True)]
    return out


class Crc:
    """CRC-32 of a slice followed by another, from the two values: that of the
    first is moved on by the second's length, which is linear in its bits."""

    def __init__(self) -> None:
        self._moved: dict[int, np.ndarray] = {}
        powers = np.zeros(256, np.uint32)
        for byte in range(256):
            c = byte
            for _ in range(8):
                c = (c >> 1) ^ (POLYNOMIAL if c & 1 else 0)
            powers[byte] = c
        self._step = powers

    def _table(self, n: int) -> np.ndarray:
        """What each byte of a value becomes ``n`` bytes later."""
        if n not in self._moved:
            bits = np.left_shift(np.uint32(1), np.arange(32, dtype=np.uint32))
            for _ in range(n):
                bits = (bits >> np.uint32(8)) ^ self._step[bits & np.uint32(255)]
            value = np.arange(256, dtype=np.uint32)
            table = np.zeros((4, 256), np.uint32)
            for place in range(4):
                for bit in range(8):
                    table[place] ^= np.where(value >> np.uint32(bit) & np.uint32(1), bits[8 * place + bit], np.uint32(0))
            self._moved[n] = table.ravel()
        return self._moved[n]

    def join(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Values of the joined slices; ``length`` is that of the second ones."""
        distinct, code = np.unique(length, return_inverse=True)
        table = np.concatenate([self._table(int(n)) for n in distinct]) if len(distinct) else np.zeros(0, np.uint32)
        base = code * 1024
        out = b.astype(np.uint32)
        for place in range(4):
            out ^= table[base + (256 * place) + ((a >> np.uint32(8 * place)) & np.uint32(255))]
        return out


def crc32(values: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, values), np.uint32, len(values))
