"""Nearest-codeword decoding of intensity traces, and the factors that even the bits out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.ranking import exact_quantiles
from spotlake.session import cut, measured

#: Codewords that are sent to every task at once; a larger codebook takes several passes over the traces.
CODES_AT_ONCE = 100_000
#: Codewords that are broadcast as one array (some 0.5 kB each).
CODES_IN_ROW = 10_000


def unit(c: Column) -> Column:
    """A trace of length one; zeros stay zeros."""
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(c, lambda x: x / norm)).otherwise(c)


def min_max(c: Column) -> Column:
    """A trace between its least and largest value; constant ones are null."""
    low, high = F.array_min(c), F.array_max(c)
    return F.transform(c, lambda x: F.try_divide(x - low, high - low))


def long_bits(df: DataFrame, keys: list[str], trace: str) -> DataFrame:
    """keys, bit (from 0), value."""
    return df.select(*keys, F.posexplode(trace).alias("bit", "value"))


def bit_quantiles(df: DataFrame, trace: str, high: float = 0.95, low: float = 0.05) -> DataFrame:
    """bit, scale, background: the exact quantiles of each bit's values, by counts and running sums."""
    return exact_quantiles(long_bits(df, [], trace), ["bit"], "value", {"scale": high, "background": low})


def rescale(df: DataFrame, key: str, trace: str, factors: DataFrame) -> DataFrame:
    """*df* with the trace less each bit's background, over its scale. factors has one row a bit and is broadcast as one array."""
    one = factors.agg(F.array_sort(F.collect_list(F.struct("bit", "scale", "background"))).alias("_f"))
    scaled = F.zip_with(F.col(trace), F.col("_f"), lambda x, f: F.try_divide(x - f["background"], f["scale"]))
    return df.join(F.broadcast(one)).withColumn(trace, scaled).drop("_f")


def nearest_code_sql(df: DataFrame, key: str, trace: str, codes: DataFrame, code_key: str, code: str) -> DataFrame:
    """key, code_key, dist: the nearest unit codeword of each unit trace (the least key of ties), by built-in expressions over one broadcast array of codes.

    A codebook of more than CODES_IN_ROW codes goes to nearest_code() instead, whose passes are bounded.
    """
    if codes.count() > CODES_IN_ROW:
        return nearest_code(df, key, trace, codes, code_key, code)
    table = codes.agg(F.array_sort(F.collect_list(F.struct(F.col(code_key).alias("k"), unit(F.col(code)).alias("v")))).alias("_codes"))
    gap = lambda v: F.aggregate(F.zip_with(F.col("_t"), v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    best = F.array_min(F.transform("_codes", lambda c: F.struct(F.round(F.sqrt(gap(c["v"])), 9).alias("dist"), c["k"].alias("k"))))
    return df.select(key, unit(F.col(trace)).alias("_t")).join(F.broadcast(table)).select(key, best.alias("b")).select(key, F.col("b.k").alias(code_key), F.col("b.dist").alias("dist"))


def nearest_code(df: DataFrame, key: str, trace: str, codes: DataFrame, code_key: str, code: str, most: float | None = None) -> DataFrame:
    """The same by one matrix product for each Arrow batch; code_key is -1 beyond the distance *most*. Keys are those of single rows.

    The codebook is shipped with the function in parts of about CODES_AT_ONCE codes, one pass over the traces each; the nearest of the
    parts' nearest codes is the nearest of all.
    """
    parts = max(1, -(-codes.count() // CODES_AT_ONCE))
    if parts > 1:
        hashed = [codes.filter(F.pmod(F.xxhash64(code_key), F.lit(parts)) == i) for i in range(parts)]
        each = [_nearest_of_part(df, key, trace, part, code_key, code, None) for part in hashed]
        every = each[0]
        for other in each[1:]:
            every = every.unionByName(other)
        best = every.groupBy(key).agg(F.min(F.struct("dist", code_key)).alias("m")).select(key, F.col(f"m.{code_key}").alias(code_key), "m.dist")
        return best if most is None else best.withColumn(code_key, F.when(F.col("dist") > most, F.lit(-1)).otherwise(F.col(code_key)).cast("bigint"))
    return _nearest_of_part(df, key, trace, codes, code_key, code, most)


def _nearest_of_part(df: DataFrame, key: str, trace: str, codes: DataFrame, code_key: str, code: str, most: float | None) -> DataFrame:
    rows = codes.select(code_key, code).orderBy(code_key).collect()  # about CODES_AT_ONCE at most
    if not rows:
        return df.select(key, F.lit(None).cast("bigint").alias(code_key), F.lit(None).cast("double").alias("dist")).limit(0)
    names = np.array([r[0] for r in rows])
    words = np.array([r[1] for r in rows], dtype=float)
    words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-300)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            t = np.array(b[trace].tolist(), dtype=float)
            norm = np.linalg.norm(t, axis=1, keepdims=True)
            t = np.where(norm > 0, t / np.where(norm > 0, norm, 1), t)
            d2 = (t * t).sum(1)[:, None] - 2 * t @ words.T + (words * words).sum(1)
            at = np.round(np.sqrt(np.maximum(d2, 0)), 9).argmin(1)
            dist = np.sqrt(((t - words[at]) ** 2).sum(1)).round(9)
            found = names[at]
            yield pd.DataFrame({key: b[key], code_key: found if most is None else np.where(dist > most, -1, found), "dist": dist})

    types = dict(df.dtypes)
    return df.select(key, trace).mapInPandas(run, f"`{key}` {types[key]}, `{code_key}` bigint, dist double")


def refactors(decoded: DataFrame, code_key: str, trace: str, bits: str) -> DataFrame:
    """bit, refactor: the mean over codes with the bit on of their mean unit intensity in it, relative to the mean over bits."""
    each = decoded.select(code_key, F.posexplode(F.arrays_zip(unit(F.col(trace)).alias("t"), F.col(bits).alias("b"))).alias("bit", "x")).filter("x.b = 1")
    per = each.groupBy(code_key, "bit").agg(F.avg("x.t").alias("m")).groupBy("bit").agg(F.avg("m").alias("m"))
    return per.join(F.broadcast(per.agg(F.avg("m").alias("all")))).select("bit", F.try_divide(F.col("m"), F.col("all")).alias("refactor"))


def backgrounds(decoded: DataFrame, code_key: str, trace: str, bits: str) -> DataFrame:
    """bit, background: the sum over codes with the bit off of their mean intensity in it, over the molecules of those codes."""
    each = decoded.select(code_key, F.posexplode(F.arrays_zip(F.col(trace).alias("t"), F.col(bits).alias("b"))).alias("bit", "x")).filter("x.b = 0")
    per = each.groupBy(code_key, "bit").agg(F.avg("x.t").alias("m"), F.count(F.lit(1)).alias("n"))
    return per.groupBy("bit").agg(F.try_divide(F.sum("m"), F.sum("n")).alias("background"))


def optimize_scales(df: DataFrame, key: str, trace: str, codes: DataFrame, code_key: str, bits: str, rounds: int = 3, most: float = 1.2) -> DataFrame:
    """round, bit, scale: start from the high quantiles, then decode and multiply each bit's scale by its refactor, again and again.

    A round's result has one row a bit; it is kept in the shared folder, so a later round starts from it. Bits no code has on keep their scale.
    """
    now = cut(bit_quantiles(df, trace))
    history = now.select(F.lit(0).alias("round"), "bit", "scale")
    for i in range(1, rounds + 1):
        scaled = rescale(df, key, trace, now)
        found = nearest_code(scaled, key, trace, codes, code_key, bits, most).filter(F.col(code_key) != -1)
        decoded = found.join(scaled.select(key, trace), key).join(measured(codes.select(code_key, bits)), code_key)
        factor = refactors(decoded, code_key, trace, bits)
        now = cut(now.join(factor, "bit", "left").select("bit", (F.col("scale") * F.coalesce("refactor", F.lit(1.0))).alias("scale"), "background"))
        history = history.unionByName(now.select(F.lit(i).alias("round"), "bit", "scale"))
    return history


def trace_features(df: DataFrame, key: str, trace: str, bits: str) -> DataFrame:
    """Per trace: largest, least, range, mean and deviation, mean of the on and of the off bits, and their ratio (0 where it isn't finite)."""
    pairs = F.arrays_zip(F.col(trace).alias("t"), F.col(bits).alias("b"))
    side = lambda on: F.transform(F.filter(pairs, lambda x: x["b"] == on), lambda x: x["t"])
    mean = lambda c: F.try_divide(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), F.size(c).cast("double"))
    base = df.select(key, F.col(trace).alias("t"), side(1).alias("on"), side(0).alias("off"))
    m = mean(F.col("t"))
    sd = F.sqrt(F.try_divide(F.aggregate(F.transform("t", lambda x: (x - m) * (x - m)), F.lit(0.0), lambda a, x: a + x), F.size("t").cast("double")))
    return base.select(key, F.array_max("t").alias("high"), F.array_min("t").alias("low"), (F.array_max("t") - F.array_min("t")).alias("spread"), m.alias("mean"), sd.alias("sd"), mean(F.col("on")).alias("on_mean"), mean(F.col("off")).alias("off_mean"), F.coalesce(F.try_divide(mean(F.col("on")), mean(F.col("off"))), F.lit(0.0)).alias("ratio"))


def knn(df: DataFrame, key: str, vector: str, queries: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """query, key, dist, place: the *k* nearest rows of each query row, itself left out (the least key of ties).

    Queries are a stated set. Queries and rows are hashed to groups of about *block*; every pair of groups is one task's matrix product that
    keeps k candidates of each query, so a query ranks (groups of rows x k) candidates and nothing goes through the driver.
    Rows are shuffled once for each group of queries. Null vectors and keys have no neighbours and are none.
    """
    types = dict(df.dtypes)
    good = lambda d: d.select(key, vector).filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    groups = lambda d: max(1, -(-good(d).count() // block))
    n_q, n_d = groups(queries), groups(df)
    part = lambda n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    asked = good(queries).withColumn("_q", part(n_q)).withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(n_d - 1))))
    rows = good(df).withColumn("_d", part(n_d)).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query": a[key].iloc[:0], key: b[key].iloc[:0], "dist": np.empty(0)})
        names, ids = a[key].to_numpy(), b[key].to_numpy()
        q, x = (np.array(t[vector].tolist(), dtype=np.float64) for t in (a, b))
        d = np.sqrt(np.maximum((q * q).sum(1)[:, None] - 2 * q @ x.T + (x * x).sum(1), 0)).round(9)
        d[names[:, None] == ids] = np.inf
        order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
        out = pd.DataFrame({"query": np.repeat(names, order.shape[1]), key: ids[order].ravel(), "dist": np.take_along_axis(d, order, 1).ravel()})
        return out[np.isfinite(out["dist"])]

    found = asked.groupBy("_q", "_d").cogroup(rows.groupBy("_q", "_d")).applyInPandas(near, f"query {types[key]}, `{key}` {types[key]}, dist double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("dist", key))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def impute(neighbours: DataFrame, values: DataFrame, key: str, feature: str, value: str, least: float) -> DataFrame:
    """query, feature, mean over the neighbours of the value (missing ones are 0), 0 under *least*. values: key, feature, value."""
    size = neighbours.groupBy("query").agg(F.count(F.lit(1)).alias("k"))
    mean = neighbours.join(values, key).groupBy("query", feature).agg(F.sum(value).alias("s")).join(size, "query").withColumn("mean", F.col("s") / F.col("k"))
    return mean.select("query", feature, F.when(F.col("mean") < least, 0.0).otherwise(F.col("mean")).alias("mean"))
