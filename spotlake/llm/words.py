"""Words of texts as 64-bit hashes, and shingles of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from spotlake.llm.utf8 import LETTER, NUMBER, byte_classes, text_chunks

#: Odd multipliers of the hashes.
_BYTE_STEP, _WORD_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Texts that are decoded at a time, bytes of them (or one text) that are worked on at a time, and words that are hashed at a time.
TEXTS_AT_ONCE, CHUNK_BYTES, WORDS_AT_ONCE = 500, 1 << 20, 1 << 16
_COMMAND = re.compile(r"\\[A-Za-z]+")


def words(text: str) -> list[str]:
    """The words of one text: commands become blanks, lower case, longest runs of letters and digits."""
    return re.findall(r"[^\W_]+", _COMMAND.sub(" ", text).lower())


@lru_cache(maxsize=2)
def _powers(step: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(step)
    return np.cumprod(out, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lower-case texts as UTF-8: a hash for each word, and the offsets of the texts' words."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    _, kind = byte_classes(data)
    inside = (kind == LETTER) | (kind == NUMBER)
    latin = (data >= 0x61) & (data <= 0x7A)  # the texts are in lower case
    slash = np.flatnonzero(data[:-1] == 0x5C) + 1
    slash = slash[latin[slash] & ~np.isin(slash, offsets)]
    if len(slash):  # the letters of a command are no word
        edge = np.flatnonzero(np.r_[True, latin[1:] != latin[:-1], True])
        run = np.searchsorted(edge, slash)
        run_end = np.minimum(edge[run + 1], offsets[np.searchsorted(offsets, slash, "right")])
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, slash, 1)
        np.add.at(step, run_end, -1)
        inside &= np.cumsum(step[:n]) == 0
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    start = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | begins[:n]))
    if not len(start):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    end = np.flatnonzero(inside & (np.r_[~inside[1:], True] | begins[1:])) + 1
    size = end - start
    power = _powers(int(_BYTE_STEP), 1 << int(size.max()).bit_length())
    hashed = np.empty(len(start), np.uint64)
    for k in range(0, len(start), WORDS_AT_ONCE):
        n_letters, first = size[k : k + WORDS_AT_ONCE], start[k : k + WORDS_AT_ONCE]
        before = np.cumsum(n_letters) - n_letters
        within = np.arange(n_letters.sum()) - np.repeat(before, n_letters)
        letter = data[np.repeat(first, n_letters) + within].astype(np.uint64) + np.uint64(1)
        hashed[k : k + WORDS_AT_ONCE] = np.add.reduceat(letter * power[within], before)
    return _mix(hashed + size.astype(np.uint64)), np.searchsorted(start, offsets)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every *width* hashes in a row (also across texts; the caller leaves those out)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * _WORD_STEP + hashes[i : i + n]
    return _mix(out)


def lower_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """text_chunks() of the texts in lower case, TEXTS_AT_ONCE at a time, where letters that turn into ASCII can't join a command."""
    for first in range(0, len(texts), TEXTS_AT_ONCE):
        low = []
        for t in texts.slice(first, TEXTS_AT_ONCE).to_pylist():
            t = t or ""
            if "\u212a" in t or "\u0130" in t:
                t = _COMMAND.sub(" ", t).replace("\\", " ")
            low.append(t.lower())
        for a, b, data, offsets in text_chunks(pa.array(low, pa.large_string()), CHUNK_BYTES):
            yield first + a, first + b, data, offsets


def shingle_rows(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each chunk of texts: (row, position, hash) of every shingle, as arrays."""
    for a, _, data, offsets in lower_chunks(texts):
        hashes, first = word_hashes(data, offsets)
        made = shingle_hashes(hashes, width)
        count = np.maximum(np.diff(first) - width + 1, 0)
        pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first[:-1], count) + pos
        yield np.repeat(np.arange(len(count)) + a, count), pos.astype(np.int32), made[at].view(np.int64) if len(at) else np.empty(0, np.int64)
