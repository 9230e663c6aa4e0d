"""Stretches of sequences worked on together in numpy: codes of letters, packed k-mers and melting temperatures of windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlake.functions.sequences import END_AT, END_GC, GAS, NEIGHBOURS

#: Code of a letter other than ACGT, and of the gap between two sequences.
OTHER = 4
_CODES = np.full(256, OTHER, np.uint8)
_CODES[np.frombuffer(b"ACGT", np.uint8)] = range(4)
#: Enthalpy and entropy of two letters (four times the first and the second).
_PAIRS = np.array([NEIGHBOURS[a + b] for a in "ACGT" for b in "ACGT"])
_ENDS = np.array([END_AT, END_GC, END_GC, END_AT])


def in_chunks(df: DataFrame, sequence: str, letters: int, by: list[Column], least: int = 1) -> tuple[DataFrame, int]:
    """*df* with _chunk, a hash of *by*, and the number of chunks: about *letters* letters each, *least* chunks at least. Measuring reads the sequences' lengths."""
    total = df.agg(F.sum(F.length(sequence)).alias("n")).first()["n"] or 0
    n = max(least, -(-total // letters))
    return df.withColumn("_chunk", F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")), n


def coded(sequences: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all letters (A, C, G, T are 0 to 3), a gap behind each sequence, and where each sequence begins."""
    texts = [s.encode("latin-1", "replace") for s in sequences]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    return _CODES[np.frombuffer(b"".join(t + b"." for t in texts), np.uint8)], starts


def running(mask: np.ndarray) -> np.ndarray:
    """How many of the values before each place are true."""
    return np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])


def within(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The number of true values in each stretch, from running()."""
    return sums[starts + length] - sums[starts]


def packed_kmers(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the k-mer that starts there, two bits a letter (k up to 16), and whether it is of plain letters."""
    n = max(0, len(codes) - k + 1)
    packed = np.zeros(n, np.uint32)
    for j in range(k):
        packed = (packed << np.uint32(2)) | (codes[j : j + n] & 3)
    others = running(codes == OTHER)
    return packed, others[k:] == others[: max(0, len(others) - k)]


def window_places(sequences: pd.Series, starts: np.ndarray, length: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The row and the shift of every window."""
    n = np.maximum(0, (sequences.str.len().to_numpy() - length) // step + 1)
    rows = np.repeat(np.arange(len(n)), n)
    return rows, (np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)) * step


def melting(codes: np.ndarray, at: np.ndarray, length: int, na_molar: float = 0.33, strand_nm: float = 25.0) -> np.ndarray:
    """functions.sequences.melting_temperature of the plain stretches that start *at*, added up in the same order."""
    pairs = codes[:-1] * np.uint8(4) + codes[1:]
    total = np.zeros((2, len(at)))
    for j in range(length - 1):
        total += _PAIRS.T[:, pairs[at + j]]
    total += _ENDS.T[:, codes[at]] + _ENDS.T[:, codes[at + length - 1]]
    entropy = total[1] + 0.368 * (length - 1) * np.log(na_molar)
    return 1000 * total[0] / (entropy + GAS * np.log(strand_nm / 2 * 1e-9)) - 273.15


def holding(codes: np.ndarray, at: np.ndarray, length: int, site: str) -> np.ndarray:
    """Whether the stretches that start *at* hold the site."""
    n = max(0, len(codes) - len(site) + 1)
    here = np.ones(n, bool)
    for j, c in enumerate(_CODES[np.frombuffer(site.encode(), np.uint8)]):
        here &= codes[j : j + n] == c
    return within(running(here), at, length - len(site) + 1) > 0
