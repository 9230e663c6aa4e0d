"""Encoding of a whole corpus by a byte-level BPE vocabulary (problem 7)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spotlake.llm.utf8 import OTHER, SPACE, byte_classes, text_chunks

#: The folder of public vocabulary files; a parameter, nothing is copied from it.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
#: Encoded pieces that a worker remembers; the memory starts anew beyond that.
REMEMBERED = 1 << 19
#: Nodes of all segment trees that are worked on together.
TREE_NODES = 1 << 20
#: Up to this many pieces of one size go through the trees one by one.
FEW = 4

_NONE = np.int64(1) << 40
#: The endings that part from a word after an apostrophe.
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


class Vocabulary:
    """Ranks of byte strings; a pair of tokens merges to the token of the joined bytes, the lowest rank first."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.size = max(self.ranks.values()) + 1
        pairs = {}
        for whole, rank in self.ranks.items():
            for cut in range(1, len(whole)):
                a, b = self.ranks.get(whole[:cut]), self.ranks.get(whole[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair merges to, _NONE where it doesn't."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], _NONE)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def piece_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pieces begin that byte-pair merges don't cross, in UTF-8 bytes of several texts one after another.

    A piece is a run of letters, of numbers or of other marks, with one blank before it; a run of white space without its last
    character if something follows; the endings _ENDINGS after a single apostrophe part from what follows.
    """
    n = len(data)
    lead, kind = byte_classes(data)
    begins = np.zeros(n + 1, bool)
    begins[text_starts] = True
    begins[n] = True
    change = begins.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    starts = change.copy()
    # the last character of a run of white space that something follows in the same text
    run = np.flatnonzero(change[:n])
    end = np.r_[run[1:], n]
    white = kind[run] == SPACE
    followed = white & ~begins[end]
    tail = end[followed] - 1
    while len(tail) and not lead[tail].all():
        tail = np.where(lead[tail], tail, tail - 1)
    starts[tail] = True
    blank = end[followed][data[tail] == 0x20]
    starts[blank] = False  # a blank belongs to the run after it
    # endings after an apostrophe that stands alone and begins a piece
    single = run[(kind[run] == OTHER) & (data[run] == 0x27) & (end - run == 1) & starts[run]]
    if len(single):
        padded = np.r_[data, np.zeros(3, np.uint8)]
        a, b = padded[single + 1], padded[single + 2]
        for ending in _ENDINGS:
            ok = (a == ending[0]) & ~begins[np.minimum(single + 1, n)]
            if len(ending) == 2:
                ok &= (b == ending[1]) & ~begins[np.minimum(single + 2, n)]
            at = single[ok]
            starts[at + 1] = False
            starts[at + 1 + len(ending)] |= True
    starts[n] = True
    return np.flatnonzero(starts)


def _merge_together(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Merge rows of token ids (padded with -1, a power of two wide), one segment tree over each row's positions.

    A leaf holds the rank of the pair that begins at its position, an inner node the leftmost minimum of its children as
    rank and position in one number. Each round takes the root's pair of every row, joins it, and updates the leaves of the joined
    position, of its live left neighbour and of the swallowed one, each with the path above it.
    """
    rows, width = ids.shape
    at = np.arange(width, dtype=np.int64)
    right = np.broadcast_to(at + 1, ids.shape).copy()
    left = np.broadcast_to(at - 1, ids.shape).copy()
    tree = np.full((rows, 2 * width), _NONE * width, dtype=np.int64)
    pair = np.full(ids.shape, _NONE, dtype=np.int64)
    pair[:, :-1] = v.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, width - 1)
    tree[:, width:] = np.where(pair < _NONE, pair * width + at, _NONE * width)
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2
    live = np.flatnonzero(tree[:, 1] < _NONE * width)

    def update(r: np.ndarray, p: np.ndarray, value: np.ndarray) -> None:
        node = p + width
        tree[r, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    def pair_at(r: np.ndarray, p: np.ndarray) -> np.ndarray:
        q = right[r, p]
        rank = v.rank(ids[r, p], np.where(q < width, ids[r, np.minimum(q, width - 1)], -1))
        return np.where(rank < _NONE, rank * width + p, _NONE * width)

    while len(live):
        best = tree[live, 1]
        p, rank = best % width, best // width
        q = right[live, p]
        after = right[live, q]
        ids[live, p], ids[live, q] = rank, -1
        right[live, p] = after
        inner = after < width
        left[live[inner], after[inner]] = p[inner]
        update(live, q, np.full(len(live), _NONE * width))
        update(live, p, pair_at(live, p))
        before = left[live, p]
        has = before >= 0
        if has.any():
            update(live[has], before[has], pair_at(live[has], before[has]))
        live = live[tree[live, 1] < _NONE * width]
    return ids


def _merge_one(ids: list[int], v: Vocabulary) -> list[int]:
    """The same tree and updates for one long piece."""
    n, width = len(ids), 1
    while width < n:
        width *= 2
    size, pairs, none = v.size, v.pairs, int(_NONE) * width
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    tree = [none] * (2 * width)
    for i in range(n - 1):
        r = pairs.get(ids[i] * size + ids[i + 1])
        if r is not None:
            tree[width + i] = r * width + i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def update(p: int, value: int) -> None:
        node = p + width
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            m = a if a < b else b
            if tree[node] == m:
                return
            tree[node] = m

    def pair_at(p: int) -> int:
        q = right[p]
        r = pairs.get(ids[p] * size + ids[q]) if q < n else None
        return none if r is None else r * width + p

    while tree[1] < none:
        rank, p = divmod(tree[1], width)
        q = right[p]
        after = right[q]
        ids[p], ids[q] = rank, -1
        right[p] = after
        if after < n:
            left[after] = p
        update(q, none)
        update(p, pair_at(p))
        if left[p] >= 0:
            update(left[p], pair_at(left[p]))
    return [i for i in ids if i >= 0]


def encode_pieces(pieces: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Token ids of each piece."""
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
    groups: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        whole = v.ranks.get(p)
        if whole is not None:
            out[i] = np.array([whole], np.int32)
        elif p:
            groups.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
    for width, members in groups.items():
        step = max(1, TREE_NODES // (2 * width))
        for k in range(0, len(members), step):
            some = members[k : k + step]
            if len(some) <= FEW and width > 64:
                for i in some:
                    out[i] = np.array(_merge_one(v.of_byte[np.frombuffer(pieces[i], np.uint8)].tolist(), v), np.int32)
                continue
            ids = np.full((len(some), width), -1, np.int64)
            size = np.array([len(pieces[i]) for i in some])
            ids[np.arange(width) < size[:, None]] = v.of_byte[np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)]
            ids = _merge_together(ids, v)
            keep = ids >= 0
            flat = ids[keep].astype(np.int32)
            for i, x in zip(some, np.split(flat, np.cumsum(keep.sum(1))[:-1])):
                out[i] = x
    return out


class Encoder:
    """Encodes texts; remembers the pieces it has met, within REMEMBERED."""

    def __init__(self, path: str) -> None:
        self.v = vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.begin, self.size = np.empty(1 << 15, np.int64), np.empty(1 << 15, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        for piece, ids in zip(pieces, encode_pieces(pieces, self.v)):
            k = len(self.known)
            self.known[piece] = k
            if k >= len(self.begin):
                self.begin, self.size = np.resize(self.begin, 2 * k), np.resize(self.size, 2 * k)
            while self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used : self.used + len(ids)] = ids
            self.begin[k], self.size[k] = self.used, len(ids)
            self.used += len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts as UTF-8 bytes with offsets (one more than texts): the token ids one after another, and their offsets."""
        texts = len(offsets) - 1
        if not len(data):
            return np.empty(0, np.int32), np.zeros(texts + 1, np.int64)
        if len(self.known) > REMEMBERED or self.used > 8 * REMEMBERED:
            self.forget()
        starts = piece_starts(data, offsets[:-1][offsets[:-1] < len(data)])
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        self._learn([p for p in distinct if p not in known])
        of = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        size = self.size[of]
        end = np.cumsum(size)
        at = np.arange(end[-1]) + np.repeat(self.begin[of] - (end - size), size)
        first = np.searchsorted(starts[:-1], offsets)  # the piece at which each text begins
        return self.flat[at], np.r_[0, end][first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps what it learnt between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_corpus(df: DataFrame, id_column: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """id and ids (array of int), the tokens of each text, without special tokens.

    Null and empty texts get an empty list. Rows stay in their partitions; whole texts are encoded, in chunks of
    CHUNK_BYTES or one text, so memory doesn't grow with a partition. Repeated rows give repeated results.
    """
    path = os.path.join(folder, f"{tokenizer}.tiktoken")
    kind = dict(df.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(1)):
                ids, ends = encoder(path).encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["id", "ids"])

    return df.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>".replace(f"`{id_column}`", "id")).withColumnRenamed("id", id_column)
