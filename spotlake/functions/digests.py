"""MD5 of many short texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

_SHIFTS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_ADDED = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint64)
_BEGIN = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]
#: Texts whose words stay in the processor's cache; letters that one block of MD5 takes.
_TOGETHER, _BLOCK = 12288, 55


def texts_matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one a row, and their lengths."""
    each = [t.encode() for t in texts]
    length = np.fromiter(map(len, each), np.int64, len(each))
    width = max(1, int(length.max(initial=0)))
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in each), np.uint8).reshape(len(each), width), length


def md5_tops(prefix: bytes, matrix: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 64 bits and the next 32 of the MD5 of *prefix* and each text, in the order of the digest's letters."""
    high, low = np.empty(len(matrix), np.uint64), np.empty(len(matrix), np.uint32)
    if len(prefix) + matrix.shape[1] > _BLOCK:
        for i, (row, n) in enumerate(zip(matrix, length)):
            digest = hashlib.md5(prefix + row[:n].tobytes()).digest()
            high[i], low[i] = int.from_bytes(digest[:8]), int.from_bytes(digest[8:12])
        return high, low
    for at in range(0, len(matrix), _TOGETHER):
        s = slice(at, at + _TOGETHER)
        a, b, c = _block(prefix, matrix[s], length[s])
        high[s] = a.byteswap().astype(np.uint64) << np.uint64(32) | b.byteswap()
        low[s] = c.byteswap()
    return high, low


def _block(prefix: bytes, matrix: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, head = len(matrix), len(prefix)
    used = -(-(head + matrix.shape[1] + 1) // 4)  # words that hold letters; the others are zero
    text = np.zeros((n, used * 4), np.uint8)
    text[:, :head] = np.frombuffer(prefix, np.uint8)
    text[:, head : head + matrix.shape[1]] = matrix
    text[np.arange(n), head + length] = 0x80
    words: list[np.ndarray | None] = [*np.ascontiguousarray(text.view("<u4").T), *[None] * (16 - used)]
    words[14] = ((head + length) * 8).astype(np.uint32)
    a, b, c, d = (np.full(n, x, np.uint32) for x in _BEGIN)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            g = i
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            g = (5 * i + 1) % 16
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            g = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            g = 7 * i % 16
        f += a
        f += np.uint32(_ADDED[i])
        if words[g] is not None:
            f += words[g]
        turn = _SHIFTS[kind][i % 4]
        np.right_shift(f, np.uint32(32 - turn), out=t)
        f <<= np.uint32(turn)
        f |= t
        f += b
        a, d, c, b, f = d, c, b, f, a
    return a + np.uint32(_BEGIN[0]), b + np.uint32(_BEGIN[1]), c + np.uint32(_BEGIN[2])
