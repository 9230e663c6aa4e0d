"""Tests, corrections, correlations and permutations."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.functions.digests import md5_tops, texts_matrix
from spotlake.operators.ranking import row_numbers, running_minima, running_sums
from spotlake.session import cut, freed

#: The polynomial of Abramowitz and Stegun 7.1.26 for the error function (absolute error under 1.5e-7).
ERF_P = 0.3275911
ERF_A = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]
#: Permutations that are made in one pass, whose files are dropped before the next; rows of a part of one permutation; rows that a task draws together.
SHUFFLES_AT_ONCE, BUCKET, DRAWN = 10, 1 << 17, 1 << 17
#: A product of deviations up to this is taken as no variation.
NO_SPREAD = 1e-15


def two_sided_p(z: Column) -> Column:
    """The two-sided normal p-value of z."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + ERF_P * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + a) * t
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def two_sided_p_sql(z: str) -> str:
    """The same in SQL."""
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1 / (1 + {ERF_P} * {x}))"
    poly = "0"
    for a in reversed(ERF_A):
        poly = f"(({poly} + ({a})) * {t})"
    return f"least(1.0, {poly} * exp(-{x} * {x}))"


def adjust(df: DataFrame, keys: list[str], p: str, method: str = "bh", name: str = "q") -> DataFrame:
    """p-values corrected within their keys: Benjamini-Hochberg ('bh') or Benjamini-Yekutieli ('by'). A null p stays null and isn't counted.

    Works on the distinct p-values of a key with their counts, which are numbered by distributed running sums; the least value from the
    largest p downwards is the same kind of sum over range parts, so no task gathers a key's rows.
    """
    if method not in ("bh", "by"):
        raise ValueError(f"unknown method {method}")
    df = cut(df)
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    counted = df.filter(F.col(p).isNotNull()).groupBy(*keys, F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    size = counted.groupBy(*keys).agg(F.sum("_c").alias("_m"))
    ranked = running_sums(counted, keys, ["_p"], {"_b": F.col("_c")})
    sized = ranked.alias("a").join(size.alias("b"), same("a", "b") or F.lit(True)).select("a.*", "_m")
    # of equal p-values the last has the largest number, hence the least value
    harmonic = F.aggregate(F.sequence(F.lit(1), F.col("_m").cast("int")), F.lit(0.0), lambda a, i: a + 1.0 / i) if method == "by" else F.lit(1.0)
    value = sized.select(*keys, "_p", (F.col("_p") * F.col("_m") * harmonic / (F.col("_b") + F.col("_c"))).alias("_q"))
    stepped = running_minima(value, keys, "_p", "_q")
    joined = df.alias("a").join(stepped.alias("b"), [*same("a", "b"), F.col(f"a.{p}") == F.col("b._p")], "left")
    return joined.select("a.*", F.when(F.col("b._q").isNotNull(), F.least(F.lit(1.0), F.col("b._q"))).alias(name))


def rank_sum_against_controls(df: DataFrame, key: str, group: str, value: str, control: object) -> DataFrame:
    """Mann-Whitney U of each group against the controls of its key: key, group, n, n_control, u, z, p (ties and continuity corrected).

    Values are counted by (key, value, group) first; the controls under each value are one distributed running sum
    over (key, value), so neither the controls nor a hot key are copied to every group or gathered in a task. Null and NaN values don't
    count. z and p are null where all values are equal or a side is empty.
    """
    good = df.filter(F.col(value).isNotNull() & ~F.isnan(value) & F.col(group).isNotNull())
    hist = good.groupBy(F.col(key).alias("key"), F.col(value).alias("v"), F.col(group).alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    by_value = hist.groupBy("key", "v").agg(F.sum(F.when(F.col("grp") == control, F.col("n")).otherwise(0)).alias("c"))
    under = running_sums(by_value, ["key"], ["v"], {"below": F.col("c")})
    cube = lambda t: t * t * t - t
    controls = by_value.groupBy("key").agg(F.sum("c").alias("n0"), F.sum(cube(F.col("c").cast("double"))).alias("ties0"))
    both = F.col("n") + F.col("c")
    per = (
        hist.filter(F.col("grp") != control)
        .join(under, ["key", "v"])
        .groupBy("key", "grp")
        .agg(
            F.sum("n").alias("n1"),
            F.sum(F.col("n") * (F.col("below") + 0.5 * F.col("c"))).alias("u"),
            F.sum(cube(both.cast("double")) - cube(F.col("c").cast("double"))).alias("ties1"),
        )
        .join(controls, "key")
    )
    n1, n0, total = F.col("n1"), F.col("n0"), F.col("n1") + F.col("n0")
    mean = n1 * n0 / 2
    ties = F.try_divide(F.col("ties0") + F.col("ties1"), (total * (total - 1)).cast("double"))
    sd = F.sqrt(n1 * n0 / 12 * (total + 1 - ties))
    top = F.greatest(F.col("u"), n1 * n0 - F.col("u"))
    z = F.try_divide(top - mean - 0.5, sd)
    sign = F.when(F.col("u") < mean, -1.0).otherwise(1.0)
    return per.withColumn("z", z * sign).withColumn("p", two_sided_p(F.greatest(z, F.lit(0.0)))).select(F.col("key").alias(key), F.col("grp").alias(group), F.col("n1").alias("n"), F.col("n0").alias("n_control"), "u", "z", "p")


def differential(counts: DataFrame, cells: DataFrame, n_in: Column, n_all: Column) -> DataFrame:
    """Per gene, cells of the group against the others: mean ratio, rank-sum z (without tie correction) and p.

    counts: cell, gene, n (zeros aren't stored); cells: cell, in_group; n_in and n_all are the numbers of cells. Ranks come from counts of
    equal values: the zeros are one block of ties under all stored values.
    """
    hist = counts.join(cells, "cell").groupBy("gene", "n").agg(F.count(F.lit(1)).alias("k"), F.count_if("in_group").alias("k1"))
    w = Window.partitionBy("gene")
    stored, stored1 = F.sum("k").over(w), F.sum("k1").over(w)
    below = F.coalesce(F.sum("k").over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = hist.select("gene", "n", "k", "k1", (n_all - stored).alias("zeros"), (n_in - stored1).alias("zeros1"), below.alias("below"))
    rank = F.col("zeros") + F.col("below") + (F.col("k") + 1) / 2
    per = ranked.groupBy("gene").agg(
        F.sum(F.col("k1") * rank).alias("r"), F.first("zeros").alias("zeros"), F.first("zeros1").alias("zeros1"), F.sum(F.col("n") * F.col("k1")).alias("s1"), F.sum(F.col("n") * (F.col("k") - F.col("k1"))).alias("s0")
    )
    n_out = n_all - n_in
    total = F.col("r") + F.col("zeros1") * (F.col("zeros") + 1) / 2
    z = F.try_divide(total - n_in * (n_all + 1) / 2, F.sqrt(n_in * n_out * (n_all + 1) / 12))
    ratio = F.try_divide(F.col("s1") / n_in, F.col("s0") / n_out)
    return per.select("gene", ratio.alias("ratio"), z.alias("z"), two_sided_p(z).alias("p"))


def welch_t(df: DataFrame, keys: list[str], value: str, in_group: Column) -> DataFrame:
    """Welch's t of the group against the rest, for each key; null without spread."""
    side = lambda f, c: f(F.when(c, F.col(value)))
    a = df.groupBy(*keys).agg(*[side(f, c).alias(n) for c, k in ((in_group, 1), (~in_group, 0)) for f, n in ((F.avg, f"m{k}"), (F.var_samp, f"v{k}"), (F.count, f"n{k}"))])
    return a.withColumn("t", F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(F.try_divide(F.col("v1"), F.col("n1")) + F.try_divide(F.col("v0"), F.col("n0"))))).select(*keys, "n1", "n0", "t")


def correlations(profiles: DataFrame, item: str, feature: str, value: str) -> DataFrame:
    """Correlation of every two items over the features both have: a, b (a < b), n, corr (null where one doesn't vary).

    Items are the groups of a screen, bounded by its design.
    """
    left = profiles.select(F.col(item).alias("a"), F.col(feature).alias("f"), F.col(value).alias("x"))
    right = profiles.select(F.col(item).alias("b"), F.col(feature).alias("f"), F.col(value).alias("y"))
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    return left.join(right, "f").filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.when(spread > NO_SPREAD, F.try_divide(F.covar_pop("x", "y"), spread)).alias("corr"))


def permuted(df: DataFrame, row_id: str, label: str, seed: int) -> DataFrame:
    """A uniform permutation of *label* over all rows: row_id, label. The order is that of md5(seed, id), so it can be repeated anywhere."""
    mixed = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(row_id).cast("string"))).alias("_mix")
    numbered = row_numbers(df.select(row_id), [], [row_id], "_row")
    return numbered.join(row_numbers(df.select(label, mixed), [], ["_mix"], "_row").drop("_mix"), "_row").drop("_row")


def permutation_p(df: DataFrame, row_id: str, unit: str, label: str, shuffles: int) -> DataFrame:
    """Per unit and label: the observed count and the share of *shuffles* in which more rows of the unit have the label (strictly), BH within the unit.

    A row's place in a shuffle is that of md5(shuffle, id). The hashes (96 bits, beyond which ties aren't decided) are counted by buckets first, so every
    bucket knows which places its rows take; then rows travel as packed hashes to their bucket, which holds the units of these places, and the counts of
    units and labels to the units' parts. SHUFFLES_AT_ONCE shuffles are made in a pass, and a pass's files are dropped before the next.
    """
    spark = df.sparkSession
    observed = cut(df.groupBy(unit, label).agg(F.count(F.lit(1)).alias("n")))
    coded = lambda c, name: cut(row_numbers(observed.select(c).filter(F.col(c).isNotNull()).distinct(), [], [c], name))
    units, labels = coded(unit, "_u"), coded(label, "_l")
    pairs = cut(observed.join(units, unit, "left").join(labels, label, "left"))
    code = lambda c: F.coalesce(c, F.lit(-1)).cast("int").alias(c)
    given = cut(df.select(row_id, unit, label).join(units, unit, "left").join(labels, label, "left").select(row_id, F.col(row_id).cast("string").alias("_id"), code("_u"), code("_l")))
    buckets = max(16, -(-given.count() // BUCKET))
    parts = buckets | 1

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of many rows, as bytes and lengths, and their labels."""
        held, n = [], 0
        for batch in chain(rows, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if n >= DRAWN or n and batch is None:
                matrix, length = texts_matrix([t for b in held for t in b.column("_id").to_pylist()])
                blobs = [matrix.tobytes(), length.tobytes(), np.concatenate([b.column("_l").to_numpy() for b in held]).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs], names=["ids", "lengths", "labels"])
                held, n = [], 0

    chunks = cut(given.filter("_id IS NOT NULL").select("_id", "_l").mapInArrow(packed, "ids binary, lengths binary, labels binary"))

    def drawn(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in rows:
            for r in batch.to_pylist():
                length = np.frombuffer(r["lengths"], np.int64)
                yield np.frombuffer(r["ids"], np.uint8).reshape(len(length), -1), length, np.frombuffer(r["labels"], np.int32)

    def bucket_of(high: np.ndarray) -> np.ndarray:
        return ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def sized(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros((shuffles, buckets), np.int64)
        for matrix, length, _ in drawn(rows):
            for seed in range(shuffles):
                sizes[seed] += np.bincount(bucket_of(md5_tops(f"{seed}-".encode(), matrix, length)[0]), minlength=buckets)
        seed, bucket = np.nonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(seed.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(sizes[seed, bucket])], names=["seed", "bucket", "n"])

    begins = np.zeros((shuffles, buckets + 1), np.int64)
    # one number for each shuffle and bucket of BUCKET rows
    for r in chunks.mapInArrow(sized, "seed int, bucket int, n bigint").groupBy("seed", "bucket").agg(F.sum("n").alias("n")).collect():
        begins[r.seed, r.bucket + 1] = r.n
    begins = begins.cumsum(1)
    low, high = begins[:, :-1].min(0), begins[:, 1:].max(0)

    def placed(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            at, of = pdf["_row"].to_numpy(), pdf["_u"].to_numpy().astype(np.int32)
            first, last = np.searchsorted(high, at, "right"), np.searchsorted(low, at, "right") - 1
            made = []
            for bucket in range(int(first.min(initial=buckets)), int(last.max(initial=-1)) + 1):
                here = (first <= bucket) & (bucket <= last)
                if here.any():
                    made.append((bucket, at[here].tobytes(), of[here].tobytes()))
            yield pd.DataFrame(made, columns=["at_bucket", "places", "units"])

    places = row_numbers(given.filter("_id IS NOT NULL").select(row_id, "_u"), [], [row_id], "_row").select("_row", "_u")
    slices = cut(places.mapInPandas(placed, "at_bucket int, places binary, units binary"))

    def sorted_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pair")
        return pd.DataFrame({"in_part": pdf.in_part.iloc[:1].to_numpy(), "known": [pdf.pair.to_numpy(np.int64).tobytes()], "n": [pdf.n.to_numpy(np.int64).tobytes()]})

    paired = pairs.filter("_u IS NOT NULL AND _l IS NOT NULL").select(F.pmod("_u", F.lit(parts)).cast("int").alias("in_part"), F.shiftleft("_u", 32).bitwiseOR(F.col("_l")).alias("pair"), "n")
    wanted = cut(paired.groupBy("in_part").applyInPandas(sorted_pairs, "in_part int, known binary, n binary"))

    def one_pass(seeds: range) -> DataFrame:
        """pair and times: the shuffles among *seeds* in which the pair is met more often than observed."""

        def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for matrix, length, label_of in drawn(rows):
                for seed in seeds:
                    tops, nexts = md5_tops(f"{seed}-".encode(), matrix, length)
                    bucket = bucket_of(tops)
                    order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
                    edges = np.r_[0, np.bincount(bucket, minlength=buckets).cumsum()]
                    there = np.flatnonzero(np.diff(edges))
                    blobs = [pa.array([x[edges[i] : edges[i + 1]].tobytes() for i in there], pa.binary()) for x in (tops[order], nexts[order], label_of[order])]
                    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(np.full(len(there), seed, np.int32)), *blobs], names=["bucket", "seed", "tops", "nexts", "labels"])

        def matched(key: tuple, pdf: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
            bucket = key[0]
            of = np.full(high[bucket] - low[bucket], -1, np.int32)
            for at, u in zip(here.places, here.units):
                of[np.frombuffer(at, np.int64) - low[bucket]] = np.frombuffer(u, np.int32)
            keys, times, sources = [], [], []
            for k, seed in enumerate(seeds):
                mine = pdf[pdf.seed == seed]
                tops, nexts, label_of = (np.frombuffer(b"".join(mine[c]), t) for c, t in (("tops", np.uint64), ("nexts", np.uint32), ("labels", np.int32)))
                order = np.argsort(tops)
                if (tops[order][1:] == tops[order][:-1]).any():
                    order = np.lexsort((nexts, tops))
                u = of[begins[seed, bucket] - low[bucket] : begins[seed, bucket + 1] - low[bucket]]
                met = u.astype(np.int64) << 32 | label_of[order]
                met = np.sort(met[(u >= 0) & (label_of[order] >= 0)])
                first = np.flatnonzero(np.r_[True, met[1:] != met[:-1]][: len(met)])
                keys.append(met[first])
                times.append(np.diff(np.r_[first, len(met)]))
                sources.append(np.full(len(first), k))
            keys, times, sources = (np.concatenate(x) for x in (keys, times, sources))
            part = (keys >> 32) % parts
            order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
            keys, times, sources, part = keys[order], times[order].astype(np.uint32), sources[order], part[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            made = []
            for p in np.flatnonzero(np.diff(edges)):
                x = slice(edges[p], edges[p + 1])
                again = np.flatnonzero(times[x] > 1).astype(np.uint32)
                made.append((p, keys[x].tobytes(), np.bincount(sources[x], minlength=len(seeds)).tobytes(), again.tobytes(), times[x][again].tobytes()))
            return pd.DataFrame(made, columns=["part", "pairs", "sizes", "again", "times"])

        def compared(pdf: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
            known, n = (np.frombuffer(b"".join(mine[c]), np.int64) for c in ("known", "n"))
            known = np.r_[known, np.int64(-1)]
            sums = np.zeros((len(seeds), len(known)), np.int64)
            for keys, sizes, again, more in zip(pdf.pairs, pdf.sizes, pdf["again"], pdf.times):
                keys = np.frombuffer(keys, np.int64)
                times = np.ones(len(keys), np.int64)
                times[np.frombuffer(again, np.uint32)] = np.frombuffer(more, np.uint32)
                place = np.searchsorted(known[:-1], keys)
                seen = known[place] == keys
                edges = np.r_[0, np.frombuffer(sizes, np.int64).cumsum()]
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    sums[k, place[a:b][seen[a:b]]] += times[a:b][seen[a:b]]  # a pair is there once
            beaten = (sums[:, :-1] > n).sum(0)
            return pd.DataFrame({"pair": known[:-1][beaten > 0], "times": beaten[beaten > 0]})

        sent = chunks.mapInArrow(hashed, "bucket int, seed int, tops binary, nexts binary, labels binary")
        met = sent.groupBy("bucket").cogroup(slices.groupBy("at_bucket")).applyInPandas(matched, "part int, pairs binary, sizes binary, again binary, times binary")
        return cut(met.groupBy("part").cogroup(wanted.groupBy("in_part")).applyInPandas(compared, "pair bigint, times bigint"))

    passes = None
    for first in range(0, shuffles, SHUFFLES_AT_ONCE):
        more = one_pass(range(first, min(first + SHUFFLES_AT_ONCE, shuffles)))
        passes = more if passes is None else passes.unionByName(more)
        freed(spark)
    beaten = passes.groupBy("pair").agg(F.sum("times").alias("times"))
    p = pairs.withColumn("pair", F.shiftleft("_u", 32).bitwiseOR(F.col("_l"))).join(beaten, "pair", "left").select(unit, label, "n", (F.coalesce("times", F.lit(0)) / F.lit(float(shuffles))).alias("p"))
    return adjust(p, [unit], "p")
