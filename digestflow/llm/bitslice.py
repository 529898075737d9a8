"""Bit-sliced Hamming comparison: bit planes stored vertically, counted by carry-save adders, blocks abandoned early.

Plane k holds bit k of every sketch of a collection, 64 sketches to a machine word. The planes are made once for each collection; to compare every
sketch with the one `step` places on, a plane is XORed with itself shifted by `step` bits, and to compare a collection with one foreign sketch,
with a word of equal bits. One word operation so advances 64 distances. Planes are summed eight at a time by carry-save adders
into vertical counters; after every group the counters are compared with the radius, and a word whose pairs have all exceeded it, or were never
asked for, is abandoned: later planes are not read for it.
"""

from __future__ import annotations

import numpy as np

ALL = ~np.uint64(0)


def planes(sketches: np.ndarray) -> np.ndarray:
    """(rows, bytes) of sketches to (bits, words) of vertical planes; the rows are padded to whole words."""
    pad = -len(sketches) % 64
    bits = np.unpackbits(np.pad(sketches, ((0, pad), (0, 0))), axis=1)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def packed(flags: np.ndarray) -> np.ndarray:
    """Booleans to words, padded by zeros."""
    return np.packbits(np.pad(flags, (0, -len(flags) % 64)), bitorder="little").view(np.uint64)


def unpacked(words: np.ndarray, size: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little")[:size].astype(bool)


def _full(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _sum8(p: np.ndarray) -> list[np.ndarray]:
    """Vertical count (4 planes) of eight planes."""
    s1, c1 = _full(p[0], p[1], p[2])
    s2, c2 = _full(p[3], p[4], p[5])
    s3, c3 = _full(s1, s2, p[6])
    ones, c4 = s3 ^ p[7], s3 & p[7]
    t1, d1 = _full(c1, c2, c3)
    twos, d2 = t1 ^ c4, t1 & c4
    return [ones, twos, d1 ^ d2, d1 & d2]


def _add(counter: list[np.ndarray], part: list[np.ndarray]) -> None:
    carry = np.zeros_like(counter[0])
    for i in range(len(counter)):
        other = part[i] if i < len(part) else np.zeros_like(carry)
        counter[i], carry = _full(counter[i], other, carry)


def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Vertical comparison counter > radius."""
    more, same = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for i in range(len(counter) - 1, -1, -1):
        if radius >> i & 1:
            same &= counter[i]
        else:
            more |= same & counter[i]
            same &= ~counter[i]
    return more


def survivors(xored: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
    """Words of the pairs among `asked` (packed) whose XORed planes (bits, words) count at most `radius`."""
    out = np.zeros(xored.shape[1], dtype=np.uint64)
    at = np.flatnonzero(asked)
    xored, gone = xored[:, at], ~asked[at]
    counter = [np.zeros(len(at), dtype=np.uint64) for _ in range(int(xored.shape[0]).bit_length())]
    for k in range(0, xored.shape[0], 8):
        _add(counter, _sum8(xored[k : k + 8]))
        gone |= _exceeds(counter, radius)
        live = gone != ALL
        if not live.all():  # abandoned words leave all arrays
            at, xored, gone, counter = at[live], xored[:, live], gone[live], [c[live] for c in counter]
            if not len(at):
                break
    out[at] = ~gone
    return out


def near_at(vertical: np.ndarray, step: int, asked: np.ndarray, radius: int) -> np.ndarray:
    """Which rows i of `asked` (booleans) are within the radius of row i + step, from the planes of all rows."""
    words = packed(asked)
    at = np.flatnonzero(words)
    far, bit = divmod(step, 64)
    wide = np.pad(vertical, ((0, 0), (0, far + 2)))
    other = wide[:, at + far]
    if bit:
        other = (other >> np.uint64(bit)) | (wide[:, at + far + 1] << np.uint64(64 - bit))
    found = np.zeros(len(words), dtype=np.uint64)
    found[at] = survivors(vertical[:, at] ^ other, words[at], radius)
    return unpacked(found, len(asked))


def near_across(left: np.ndarray, rows: int, right: np.ndarray, others: int, radius: int) -> np.ndarray:
    """(others, rows) of booleans: which of the first `rows` rows of the left planes are within the radius of each of the first `others` rows of the right planes."""
    bits = np.unpackbits(right.view(np.uint8), axis=1, bitorder="little")[:, :others].astype(np.uint64)
    xored = left[:, None, :] ^ (np.uint64(0) - bits)[:, :, None]
    asked = np.broadcast_to(packed(np.ones(rows, dtype=bool)), (others, left.shape[1])).ravel()
    found = survivors(xored.reshape(len(left), -1), np.ascontiguousarray(asked), radius).reshape(others, -1)
    return np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, :rows].astype(bool)


def within_radius(left: np.ndarray, right: np.ndarray, radius: int, words: int = 64) -> np.ndarray:
    """Boolean per pair of sketch rows (uint8, a multiple of 8 bits): Hamming distance at most `radius`."""
    out = np.zeros(len(left), dtype=bool)
    for start in range(0, len(left), 64 * words):
        block = slice(start, min(start + 64 * words, len(left)))
        size = block.stop - block.start
        out[block] = unpacked(survivors(planes(left[block] ^ right[block]), packed(np.ones(size, dtype=bool)), radius), size)
    return out
