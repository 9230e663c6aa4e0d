"""Groups of cells compared: bootstrapped differences, permuted correlations and shapes of distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.ranking import row_numbers
from spotlake.operators.stats import NO_SPREAD, adjust, two_sided_p
from spotlake.session import cut

#: Steps of the repeatable draws (draw, repeat, group).
DRAW_STEPS = (7919, 104729, 15485863)


def bootstrap_differential(counts: DataFrame, cells: DataFrame, reference: int, repeats: int = 10, size: int = 250) -> DataFrame:
    """grp, gene, ratio, z, p: every group against the reference, as means over *repeats* samples of *size* cells of either, drawn with replacement.

    counts: cell, gene, n (zeros aren't stored); cells: cell, grp. Draw i of repeat r takes the cell whose number in its group is (a i + b r + c grp) mod the
    group's size (DRAW_STEPS), so it can be repeated anywhere. z is the rank-sum score without tie correction, from counts of equal values; the zeros are one block of ties
    under all stored values. ratio is null where the reference's mean is 0. Cells without group are left out.
    """
    named = cells.filter(F.col("grp").isNotNull() & F.col("cell").isNotNull())
    numbered = cut(row_numbers(named, ["grp"], ["cell"], "_row"))
    sizes = numbered.groupBy("grp").agg(F.count(F.lit(1)).alias("_size"))
    a, b, c = DRAW_STEPS
    at = F.pmod(F.col("_i") * a + F.col("rep") * b + F.col("grp") * c, F.col("_size"))
    draws = sizes.select("grp", "_size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(repeats - 1).cast("bigint"))).alias("rep")).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint"))).alias("_i"))
    drawn = draws.select("grp", "rep", at.alias("_row")).groupBy("grp", "rep", "_row").agg(F.count(F.lit(1)).alias("w")).join(numbered, ["grp", "_row"])
    hist = cut(drawn.join(counts, "cell").groupBy("grp", "rep", "gene", "n").agg(F.sum("w").alias("k")))
    others = sizes.filter(F.col("grp") != reference).select("grp")
    mine = hist.filter(F.col("grp") != reference).select("grp", "rep", "gene", "n", F.col("k").alias("k1"), F.lit(0).cast("bigint").alias("k0"))
    # the reference's counts once for each group of the screen; a join on the repeat, so no cross join
    theirs = hist.filter(F.col("grp") == reference).drop("grp").join(others.select("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(repeats - 1).cast("bigint"))).alias("rep")), "rep")
    both = mine.unionByName(theirs.select("grp", "rep", "gene", "n", F.lit(0).cast("bigint").alias("k1"), F.col("k").alias("k0"))).groupBy("grp", "rep", "gene", "n").agg(F.sum("k1").alias("k1"), F.sum("k0").alias("k0"))
    w = Window.partitionBy("grp", "rep", "gene")
    k = F.col("k1") + F.col("k0")
    below = F.coalesce(F.sum(k).over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = both.select("grp", "rep", "gene", "n", "k1", "k0", k.alias("k"), (2 * size - F.sum(k).over(w)).alias("zeros"), (size - F.sum("k1").over(w)).alias("zeros1"), below.alias("below"))
    rank = F.col("zeros") + F.col("below") + (F.col("k") + 1) / 2
    per = ranked.groupBy("grp", "rep", "gene").agg(F.sum(F.col("k1") * rank).alias("r"), F.first("zeros").alias("zeros"), F.first("zeros1").alias("zeros1"), F.sum(F.col("n") * F.col("k1")).alias("s1"), F.sum(F.col("n") * F.col("k0")).alias("s0"))
    total = F.col("r") + F.col("zeros1") * (F.col("zeros") + 1) / 2
    z = (total - size * (2 * size + 1) / 2) / F.sqrt(F.lit(size * size * (2 * size + 1) / 12))
    rated = per.select("grp", "gene", z.alias("z"), F.try_divide(F.col("s1"), F.col("s0")).alias("ratio"), two_sided_p(z).alias("p"))
    return rated.groupBy("grp", "gene").agg(F.avg("ratio").alias("ratio"), F.sum("z").alias("z"), F.sum("p").alias("p")).select("grp", "gene", "ratio", (F.col("z") / repeats).alias("z"), (F.col("p") / repeats).alias("p"))


def _profiles(counts: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, grp, gene, mean over all cells of the group."""
    sizes = labels.groupBy(*keys, "grp").agg(F.count(F.lit(1)).alias("cells"))
    return counts.join(labels, "cell").groupBy(*keys, "grp", "gene").agg(F.sum("n").alias("s")).join(sizes, [*keys, "grp"]).select(*keys, "grp", "gene", (F.col("s") / F.col("cells")).alias("mean"))


def _correlated(profiles: DataFrame, keys: list[str]) -> DataFrame:
    left = profiles.select(*keys, F.col("grp").alias("a"), "gene", F.col("mean").alias("x"))
    right = profiles.select(*keys, F.col("grp").alias("b"), "gene", F.col("mean").alias("y"))
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    corr = F.round(F.when(spread > NO_SPREAD, F.try_divide(F.covar_pop("x", "y"), spread)), 9)
    return left.join(right, [*keys, "gene"]).filter("a < b").groupBy(*keys, "a", "b").agg(corr.alias("corr"))


def correlation_p(counts: DataFrame, cells: DataFrame, shuffles: int, at_once: int = 25) -> DataFrame:
    """a, b (a < b), corr, p, q: the correlation of two groups' mean profiles over the genes both have, and the share of *shuffles* of the groups' labels over the cells in which it is larger (strictly).

    q is Benjamini-Hochberg over the whole matrix, pairs both ways and the groups with themselves (p = 1). Shuffles are key columns, *at_once* of them in a pass;
    the order of a shuffle is that of md5(shuffle, cell). Groups are the groups of a screen, bounded by its design.
    """
    named = cells.filter(F.col("grp").isNotNull())
    observed = cut(_correlated(_profiles(counts, named, []), []))
    numbered = cut(row_numbers(named.select("cell"), [], ["cell"], "_row"))
    beaten = None
    for first in range(0, shuffles, at_once):
        seed = F.explode(F.sequence(F.lit(first), F.lit(min(first + at_once, shuffles) - 1))).alias("seed")
        mixed = named.select("cell", "grp", seed).select("grp", "seed", F.md5(F.concat_ws("-", F.col("seed").cast("string"), F.col("cell").cast("string"))).alias("_mix"))
        labels = row_numbers(mixed, ["seed"], ["_mix"], "_row").select("seed", "grp", "_row").join(numbered, "_row").drop("_row")
        drawn = _correlated(_profiles(counts, labels, ["seed"]), ["seed"]).withColumnRenamed("corr", "other")
        more = drawn.join(observed, ["a", "b"]).filter("other > corr").select("a", "b")
        beaten = more if beaten is None else beaten.unionByName(more)
    times = beaten.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    p = cut(observed.join(times, ["a", "b"], "left").select("a", "b", "corr", (F.coalesce("times", F.lit(0)) / shuffles).alias("p")))
    groups = named.select(F.col("grp").alias("a")).distinct()
    matrix = p.select("a", "b", "p").unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b"), "p")).unionByName(groups.select("a", F.col("a").alias("b"), F.lit(1.0).alias("p")))
    q = adjust(matrix, [], "p").filter("a < b").select("a", "b", "q")
    return p.join(q, ["a", "b"])


def covariances(df: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """keys, n, the six covariances xx, xy, xz, yy, yz, zz of three axes, their determinant, and the inverse ixx, ... by cofactors (null where there is no spread)."""
    good = df.dropna(subset=axes)
    for c in axes:
        good = good.filter(~F.isnan(c))
    names = {f"{p}{q}": F.covar_pop(axes[i], axes[j]) for i, p in enumerate("xyz") for j, q in enumerate("xyz") if i <= j}
    made = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in names.items()])
    xx, xy, xz, yy, yz, zz = (F.col(n) for n in names)
    det = xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz)
    cof = {"ixx": yy * zz - yz * yz, "ixy": xz * yz - xy * zz, "ixz": xy * yz - xz * yy, "iyy": xx * zz - xz * xz, "iyz": xy * xz - xx * yz, "izz": xx * yy - xy * xy}
    spread = F.when(F.abs(F.col("det")) > NO_SPREAD, F.col("det"))
    return made.withColumn("det", det).select("*", *[F.try_divide(c, spread).alias(n) for n, c in cof.items()])


def divergence(a: str, b: str) -> Column:
    """Kullback-Leibler divergence of two centred Gaussians by covariances(): of the first, under alias *a*, from the second, under alias *b*."""
    c = lambda t, n: F.col(f"{t}.{n}")
    trace = sum((c(a, n) * c(b, f"i{n}") * (1 if n[0] == n[1] else 2) for n in ("xx", "xy", "xz", "yy", "yz", "zz")), F.lit(0.0))
    return F.when((c(a, "det") > NO_SPREAD) & (c(b, "det") > NO_SPREAD), (trace - 3 + F.log(c(b, "det") / c(a, "det"))) / 2)
