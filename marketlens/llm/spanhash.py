"""Hashes of many byte spans at once: eight bytes of every span a step.

``Spans`` reads the buffer through a window of eight bytes at each position, so
a step over all spans is one gather. Spans of more than ``LONG`` bytes are
hashed one by one, so a step count never follows a very long word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

LONG = 256

# fixed values: the primes of XXH64
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)

_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Spans:
    """Byte ranges [start, end) of one buffer."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.buf, self.start, self.end = buf, start, end
        self.size = end - start
        padded = np.zeros(len(buf) + 8, dtype=np.uint8)
        padded[:len(buf)] = buf
        self.window = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))

    def chunk(self, which: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at + 8`` of some spans as a number; what lies past an end counts as zero."""
        return self.window[self.start[which] + at] & _FIRST[np.minimum(self.size[which] - at, 8)]

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()

    def keys(self) -> np.ndarray:
        """A well-mixed 64-bit hash of every span."""
        h = self.size.astype(np.uint64) * P5 + P3
        which, at = np.flatnonzero(self.size <= LONG), 0
        which = which[self.size[which] > 0]
        while len(which):
            x = h[which] ^ (self.chunk(which, at) * P2)
            x = _turn(x, 31) * P1
            h[which] = x ^ (x >> np.uint64(29))
            at += 8
            which = which[self.size[which] > at]
        for i in np.flatnonzero(self.size > LONG):
            h[i] = int.from_bytes(hashlib.blake2b(self.bytes_of(i), digest_size=8).digest(), "little")
        h ^= h >> np.uint64(33)
        h *= P2
        return h ^ (h >> np.uint64(29))

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans ``a`` hold the same bytes as the spans ``b``, one by one."""
        same = self.size[a] == self.size[b]
        at, which = 0, np.flatnonzero(same & (self.size[a] > 0) & (self.size[a] <= LONG))
        while len(which):
            ok = self.chunk(a[which], at) == self.chunk(b[which], at)
            same[which[~ok]] = False
            at += 8
            which = which[ok]
            which = which[self.size[a[which]] > at]
        for i in np.flatnonzero(same & (self.size[a] > LONG)):
            same[i] = np.array_equal(self.buf[self.start[a[i]]:self.end[a[i]]], self.buf[self.start[b[i]]:self.end[b[i]]])
        return same

    def xxh64(self, seed: int) -> np.ndarray:
        """XXH64 of every span."""
        out = np.zeros(len(self.size), dtype=np.uint64)
        for i in np.flatnonzero(self.size > LONG):
            out[i] = xxhash.xxh64_intdigest(self.bytes_of(i), seed)
        short = np.flatnonzero(self.size <= LONG)
        at, size = self.start[short], self.size[short]
        h = np.full(len(short), (seed + int(P5)) % 2**64, dtype=np.uint64)
        big = np.flatnonzero(size >= 32)
        if len(big):
            lanes = [np.full(len(big), (seed + v) % 2**64, dtype=np.uint64) for v in (int(P1) + int(P2), int(P2), 0, -int(P1))]
            go = np.arange(len(big))
            while len(go):
                where = at[big[go]]
                for k in range(4):
                    lanes[k][go] = _turn(lanes[k][go] + self.window[where + 8 * k] * P2, 31) * P1
                at[big[go]] += 32
                go = go[at[big[go]] + 32 <= self.end[short[big[go]]]]
            x = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for lane in lanes:
                x = (x ^ (_turn(lane * P2, 31) * P1)) * P1 + P4
            h[big] = x
        h += size.astype(np.uint64)
        left = self.end[short] - at
        which = np.flatnonzero(left >= 8)
        while len(which):
            k = _turn(self.window[at[which]] * P2, 31) * P1
            h[which] = _turn(h[which] ^ k, 27) * P1 + P4
            at[which] += 8
            left[which] -= 8
            which = which[left[which] >= 8]
        which = np.flatnonzero(left >= 4)
        k = self.window[at[which]] & np.uint64(0xFFFFFFFF)
        h[which] = _turn(h[which] ^ (k * P1), 23) * P2 + P3
        at[which] += 4
        left[which] -= 4
        which = np.flatnonzero(left > 0)
        while len(which):
            k = self.window[at[which]] & np.uint64(0xFF)
            h[which] = _turn(h[which] ^ (k * P5), 11) * P1
            at[which] += 1
            left[which] -= 1
            which = which[left[which] > 0]
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        out[short] = h ^ (h >> np.uint64(32))
        return out
