"""Ordered folds: algorithms that walk the rows of a key in order and decide row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Step = Callable[[Any, pd.DataFrame], tuple[Any, np.ndarray]]


def keep_in_order(df: DataFrame, keys: list[str], order: list[str], step: Step) -> DataFrame:
    """The rows that *step* keeps, walking each key's rows in *order*.

    step(state, rows) gets the state after the key's rows so far (None at first) and its next rows, and returns the new state
    and a mask. Rows are sorted by Spark, which spills, and streamed through in batches: a task holds one batch and one
    state, never all rows of a key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for batch in batches:
            if not len(batch):
                continue
            codes = batch.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            masks = []
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                key = tuple(None if pd.isna(k) else k for k in batch[keys].iloc[a])
                if key != last:
                    last, state = key, None
                state, mask = step(state, batch.iloc[a:b])
                masks.append(mask)
            yield batch[np.concatenate(masks)]

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, df.schema)


def no_overlap(start: str, length: Callable[[pd.DataFrame], np.ndarray]) -> Step:
    """Interval scheduling: keep a row if it starts at or after the end of the last kept one."""

    def step(end: float | None, rows: pd.DataFrame) -> tuple[float | None, np.ndarray]:
        starts, ends = rows[start].to_numpy(), rows[start].to_numpy() + length(rows)
        mask = np.zeros(len(rows), bool)
        for i, s in enumerate(starts):
            if end is None or s >= end:
                mask[i], end = True, ends[i]
        return end, mask

    return step


def sparse_centers(columns: list[str], radius: float, norm: str = "max") -> Step:
    """Keep a row if every kept one is farther than *radius* (greatest coordinate difference, or 'l2')."""

    def step(kept: dict | None, rows: pd.DataFrame) -> tuple[dict, np.ndarray]:
        kept = {} if kept is None else kept
        points = rows[columns].to_numpy(dtype=float)
        mask = np.zeros(len(rows), bool)
        around = np.stack(np.meshgrid(*[[-1, 0, 1]] * len(columns), indexing="ij"), -1).reshape(-1, len(columns))
        for i, p in enumerate(points):
            cell = np.floor(p / radius).astype(int)
            near = [q for c in cell + around for q in kept.get(tuple(c), ())]
            gap = np.abs(np.array(near) - p) if near else np.empty((0, len(columns)))
            if not ((gap.max(1) if norm == "max" else np.sqrt((gap**2).sum(1))) <= radius).any():
                mask[i] = True
                kept.setdefault(tuple(cell), []).append(p)
        return kept, mask

    return step
