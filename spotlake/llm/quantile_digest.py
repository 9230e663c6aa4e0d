"""Percentiles of very large numeric columns from mergeable digests (problem 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.session import cut

#: Size of a digest: it has at most this many centroids; the rank error falls in proportion.
DELTA = 200
#: The stated bound of the rank error, besides half a row for small groups.
ERROR_BOUND = 0.01
#: Rows that a task holds before it writes digests.
BUFFER_ROWS = 400_000
#: A key's digests are first merged within this many random groups, then over them.
SALTS = 16
#: Digests (of some 4 kB) that a task merges together.
BUFFER_DIGESTS = 5_000
#: Percentile estimates are broadcast for the counting pass only if there are at most this many keys.
BROADCAST_KEYS = 50_000

_DIGEST = "n bigint, low double, high double, means array<double>, weights array<double>"


def cluster(codes: np.ndarray, values: np.ndarray, weights: np.ndarray, delta: int) -> tuple[np.ndarray, ...]:
    """Cluster the values of each code under the size function delta/(2 pi) asin(2q - 1): (code, mean, weight) of the centroids."""
    order = np.lexsort((values, codes))
    codes, values, weights = codes[order], values[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    sizes = np.diff(np.r_[first, len(codes)])
    before = np.cumsum(weights) - weights
    q = (before - np.repeat(before[first], sizes) + weights / 2) / np.repeat(np.add.reduceat(weights, first), sizes)
    bucket = np.floor(delta * (np.arcsin(np.clip(2 * q - 1, -1, 1)) / np.pi + 0.5)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (bucket[1:] != bucket[:-1])])
    total = np.add.reduceat(weights, at)
    return codes[at], np.add.reduceat(values * weights, at) / total, total


def _digests(rows: pd.DataFrame, keys: list[str], fields: list[str], delta: int) -> pd.DataFrame:
    """A digest of each key and field of some rows; null and NaN values don't count."""
    codes = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    of = rows[keys].iloc[np.unique(codes, return_index=True)[1]]
    out = []
    for field in fields:
        value = rows[field].to_numpy(dtype="float64", na_value=np.nan)
        good = np.isfinite(value)
        if not good.any():
            continue
        c, v = codes[good], value[good]
        cc, means, weights = cluster(c, v, np.ones(len(v)), delta)
        first = np.flatnonzero(np.r_[True, cc[1:] != cc[:-1]])
        size = len(of)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        np.minimum.at(low, c, v)
        np.maximum.at(high, c, v)
        which = cc[first]
        d = of.iloc[which].reset_index(drop=True)
        d["field"], d["n"], d["low"], d["high"] = field, np.add.reduceat(weights, first).astype("int64"), low[which], high[which]
        d["means"], d["weights"] = np.split(means, first[1:]), np.split(weights, first[1:])
        out.append(d)
    return pd.concat(out) if out else pd.DataFrame()


def partial_digests(df: DataFrame, keys: list[str], fields: list[str], delta: int = DELTA) -> DataFrame:
    """One digest for each key, field and buffer of a task; combines rows before anything is shuffled."""
    types = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + f", field string, {_DIGEST}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, like = [], 0, None
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BUFFER_ROWS:
                yield from flush(held)
                held, n = [], 0
        yield from flush(held)

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).to_pandas() if held else pd.DataFrame()
        out = _digests(rows, keys, fields, delta) if len(rows) else rows
        if len(out):
            arrow = {k: held[0].schema.field(k).type for k in keys}
            numbers = pa.list_(pa.float64())
            want = pa.schema([*arrow.items(), ("field", pa.string()), ("n", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("means", numbers), ("weights", numbers)])
            yield from pa.Table.from_pandas(out, schema=want, preserve_index=False).to_batches()

    return df.select(*keys, *fields).mapInArrow(run, schema)


def _merge(rows: pd.DataFrame, keys: list[str], delta: int) -> pd.DataFrame:
    """One digest for each key of some digests, all keys re-clustered together."""
    codes = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    first = np.unique(codes, return_index=True)[1]
    size = rows["means"].map(len).to_numpy()
    cc, means, weights = cluster(np.repeat(codes, size), np.concatenate(rows["means"].to_numpy()), np.concatenate(rows["weights"].to_numpy()), delta)
    cut_at = np.flatnonzero(cc[1:] != cc[:-1]) + 1
    one = rows[keys].iloc[first].reset_index(drop=True)
    per = rows.groupby(codes)
    one["n"], one["low"], one["high"] = per["n"].sum().to_numpy(), per["low"].min().to_numpy(), per["high"].max().to_numpy()
    one["means"], one["weights"] = pd.Series(np.split(means, cut_at)), pd.Series(np.split(weights, cut_at))
    return one


def _merge_stream(keys: list[str], delta: int):
    """Over partitions sorted by key: merge buffers of digests; only the last key of a buffer waits for the next, as one digest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            if len(b):
                held.append(b)
                n += len(b)
            if n >= BUFFER_DIGESTS:
                made = _merge(pd.concat(held, ignore_index=True), keys, delta)
                yield made.iloc[:-1]
                held, n = [made.iloc[-1:]], 1
        if held:
            yield _merge(pd.concat(held, ignore_index=True), keys, delta)

    return run


def merge_digests(digests: DataFrame, keys: list[str], delta: int = DELTA) -> DataFrame:
    """Merge digests into one for each key by re-clustering their centroids, in two levels so that no task gathers all of a hot key.

    Works on any mixture of digests: of partitions, days or runs. A null key is a group of its own.
    """
    types = dict(digests.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {_DIGEST}"
    part = digests.select(*keys, "n", "low", "high", "means", "weights")
    salt = F.pmod(F.hash("n", "low", "high", "means"), F.lit(SALTS))
    once = part.repartition(*keys, salt).sortWithinPartitions(*keys).mapInPandas(_merge_stream(keys, delta), schema)
    return once.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_merge_stream(keys, delta), schema)


def _estimate(low: float, high: float, n: int, means: np.ndarray, weights: np.ndarray, quantiles: list[float]) -> list[float]:
    middle = np.cumsum(weights) - weights / 2
    return np.interp(np.asarray(quantiles) * n, np.r_[0, middle, n], np.r_[low, means, high]).tolist()


def estimate_quantiles(digests: DataFrame, quantiles: list[float]) -> DataFrame:
    """The digests' columns before the centroids, and ``estimates``, the values at the quantiles."""

    def values(n: pd.Series, low: pd.Series, high: pd.Series, means: pd.Series, weights: pd.Series) -> pd.Series:
        return pd.Series([_estimate(b, c, a, d, e, quantiles) for a, b, c, d, e in zip(n, low, high, means, weights)])

    f = F.pandas_udf(values, "array<double>")
    return digests.withColumn("estimates", f("n", "low", "high", "means", "weights")).drop("low", "high", "means", "weights")


def certify(rows: DataFrame, estimates: DataFrame, keys: list[str], fields: list[str], quantiles: list[float]) -> DataFrame:
    """Count, over all rows, how many values lie under and up to each estimate: the exact rank error of each percentile.

    The estimates are broadcast if their number of keys is measured to be small, else joined by key, where AQE splits hot keys.
    Counts are combined on the map side. Columns: keys, field, quantile, value, n, rank_error, within_bound.
    """
    estimates = cut(estimates)
    few = estimates.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    stacked = ", ".join(f"'{f}', `{f}`" for f in fields)
    values = rows.select(*keys, F.expr(f"stack({len(fields)}, {stacked}) as (field, number)")).filter("number IS NOT NULL AND NOT isnan(number) AND abs(number) < double('infinity')")
    right = estimates.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("field").alias("_field"), "estimates")
    same = F.col("field") == F.col("_field")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    counts = [F.count_if(F.col("number") < F.col("estimates")[i]).alias(f"under_{i}") for i in range(len(quantiles))]
    counts += [F.count_if(F.col("number") <= F.col("estimates")[i]).alias(f"upto_{i}") for i in range(len(quantiles))]
    right = F.broadcast(right) if few else right
    per_key = values.join(right, same).groupBy(*keys, "field").agg(F.count(F.lit(1)).alias("n"), *counts)
    counted = per_key.join(right, same)
    per = [F.struct(F.lit(float(q)).alias("quantile"), F.col("estimates")[i].alias("value"), F.col(f"under_{i}").alias("under"), F.col(f"upto_{i}").alias("upto")) for i, q in enumerate(quantiles)]
    out = counted.select(*keys, "field", "n", F.explode(F.array(*per)).alias("p")).select(*keys, "field", "n", "p.*")
    error = F.greatest(F.lit(0.0), F.col("under") / F.col("n") - F.col("quantile"), F.col("quantile") - F.col("upto") / F.col("n"))
    return out.select(*keys, "field", "quantile", "value", "n", error.alias("rank_error"), (error <= ERROR_BOUND + 0.5 / F.col("n")).alias("within_bound"))
