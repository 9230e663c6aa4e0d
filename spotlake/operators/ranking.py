"""Running sums and row numbers over whole tables without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.session import cut


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """*df* with, for each name in *sums*, the sum over the rows of its keys that come before the row in *order*.

    Rows are range-partitioned by keys and order, summed within each part, and the parts' totals (one row for each part
    and key met in it) are summed up and joined back: a key that holds most rows is spread over the parts. Rows equal in keys and
    order should be unique (sum them up before); else their order among themselves is undefined.
    """
    part = F.spark_partition_id().alias("_part")
    parts = cut(df.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).select("*", part))
    within = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"_in_{n}") for n, c in sums.items()])
    totals = parts.groupBy("_part", *keys).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *keys, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums])
    same = F.col("a._part") == F.col("b._part")
    for k in keys:
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return local.alias("a").join(offsets.alias("b"), same).select(*[F.col(f"a.{c}") for c in df.columns], *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums])


def running_minima(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """*df* (unique in keys and order) with *value* replaced by the least value of the rows of its keys from this one on, by range parts as in running_sums()."""
    parts = cut(df.repartitionByRange(*[F.col(c) for c in [*keys, order]]).select("*", F.spark_partition_id().alias("_part")))
    ahead = Window.partitionBy("_part", *keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumn("_in", F.min(value).over(ahead))
    later = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    rest = parts.groupBy("_part", *keys).agg(F.min(value).alias("_t")).select("_part", *keys, F.min("_t").over(later).alias("_off"))
    same = F.col("a._part") == F.col("b._part")
    for k in keys:
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return local.alias("a").join(rest.alias("b"), same).select(*[F.col(f"a.{c}") for c in df.columns if c != value], F.least("a._in", "b._off").alias(value))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """keys and, for each name in *quantiles*, the interpolated quantile of the rows' values; null and NaN values don't count.

    Values are counted first, then the counts' running sums say which values hold the ranks on either side, so no task holds all values of a key.
    """
    good = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counted = cut(good)
    size = counted.groupBy(*keys).agg(F.sum("_n").alias("_m"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys] or F.lit(True)
    ranked = running_sums(counted, keys, ["_v"], {"_b": F.col("_n")}).alias("a").join(size.alias("b"), same("a", "b")).select("a.*", "_m")
    at = {n: F.lit(float(q)) * (F.col("_m") - 1) for n, q in quantiles.items()}
    holds = lambda rank: (F.col("_b") <= rank) & (rank < F.col("_b") + F.col("_n"))
    low = {n: F.max(F.when(holds(F.floor(p)), F.col("_v"))) for n, p in at.items()}
    high = {n: F.max(F.when(holds(F.ceil(p)), F.col("_v"))) for n, p in at.items()}
    part = {n: F.max(p - F.floor(p)) for n, p in at.items()}
    return ranked.groupBy(*keys).agg(*[(low[n] + (high[n] - low[n]) * part[n]).alias(n) for n in quantiles])


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str = "row") -> DataFrame:
    """*df* with the number of each row from 0 in *order* within its keys; rows must differ in keys and order."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("bigint")})
