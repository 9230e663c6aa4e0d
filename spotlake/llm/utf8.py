"""Classes of characters and chunks of texts, on UTF-8 bytes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Bytes of text that are worked on together; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Space, letter, number or other, for every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            table[cp] = LETTER
        elif c == "N":
            table[cp] = NUMBER
    spaces = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[spaces] = SPACE
    return table


def byte_classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of UTF-8 bytes: whether each begins a character, and the class of its character."""
    lead = (data & 0xC0) != 0x80
    kind = _classes()[data]
    wide = np.flatnonzero(data >= 0xC0)
    if len(wide):
        b = data[wide].astype(np.int32)
        padded = np.r_[data, np.zeros(3, np.uint8)]
        c1, c2, c3 = (padded[wide + i].astype(np.int32) & 0x3F for i in (1, 2, 3))
        two, three = b < 0xE0, (b >= 0xE0) & (b < 0xF0)
        cp = np.where(two, (b & 0x1F) << 6 | c1, np.where(three, (b & 0x0F) << 12 | c1 << 6 | c2, (b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
        k = _classes()[np.minimum(cp, 0x10FFFF)]
        size = np.where(two, 2, np.where(three, 3, 4))
        for i in range(4):
            far = size > i
            kind[wide[far] + i] = k[far]
    return lead, kind


def text_chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about *size* bytes: first and last row, their bytes and the offsets of the texts in them. Null texts are empty."""
    whole = texts.cast(pa.large_binary())
    if whole.null_count:
        whole = whole.fill_null(b"")
    if not len(whole):
        return
    sizes = np.diff(np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1])
    group = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(whole)]
    for a, b in zip(cuts, cuts[1:]):
        part = whole.slice(a, b - a)
        off = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        yield a, b, np.frombuffer(part.buffers()[2] or b"", np.uint8)[off[0] : off[-1]], off - off[0]
