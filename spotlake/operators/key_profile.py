"""Per-key results when a few keys hold most rows (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_profile(df: DataFrame, keys: list[str], distinct_of: str, sum_of: str) -> DataFrame:
    """Count, sum and distinct count for every value of every column in *keys*, in one scan.

    Two algebraic levels, both combined on the map side before anything is shuffled: the first is keyed by
    (field, key, item), so a hot key is spread over its items and each task sends at most one state for each of them; the second
    merges those states by (field, key). No level gathers the rows of a key, so a key that holds a third of all
    rows costs its reducer as many states as it has items, not rows.

    A null key is a group of its own (key_value null). Null and NaN in *sum_of* don't add to the sum, which is null where a key has no number;
    nulls in *distinct_of* don't count as a value. Empty input gives no rows. Repeated rows count as they stand.
    Columns: field, key_value, n_rows, n_values, total, n_distinct.
    """
    stacked = ", ".join(f"'{k}', cast(`{k}` as bigint)" for k in keys)
    number = F.col(sum_of).cast("double")
    states = (
        df.select(
            F.expr(f"stack({len(keys)}, {stacked}) as (field, key_value)"),
            F.col(distinct_of).alias("item"),
            F.when(~F.isnan(number), number).alias("number"),
        )
        .groupBy("field", "key_value", "item")
        .agg(F.count(F.lit(1)).alias("n"), F.count("number").alias("n_values"), F.sum("number").alias("total"))
    )
    return states.groupBy("field", "key_value").agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
        F.count("item").alias("n_distinct"),
    )


def heavy_keys(profile: DataFrame, share: float) -> DataFrame:
    """The non-null keys that hold at least *share* of all rows of their field, from key_profile's result.

    The totals are one row for each field, so their broadcast doesn't grow with the data. The share is compared in
    whole numbers (parts in a million). Ties at the limit belong to the result. Columns: field, key_value, n_rows.
    """
    parts = round(share * 1_000_000)
    totals = profile.groupBy("field").agg(F.sum("n_rows").alias("all_rows"))
    return (
        profile.filter(F.col("key_value").isNotNull())
        .join(F.broadcast(totals), "field")
        .filter(F.col("n_rows") * 1_000_000 >= F.col("all_rows") * parts)
        .select("field", "key_value", "n_rows")
    )
