"""Connected components and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotlake.session import cut

#: Rounds after which the dropped nodes' parts are written as one.
JOIN_EVERY = 20


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of it), for the nodes of undirected edges (a, b).

    Large-star and small-star rounds: each joins the neighbours of a node to the least of them, so the number of rounds grows with
    the logarithm of the longest path and no adjacency list is gathered; a hub's edges are rows, and its least neighbour is a
    map-side combined minimum. Ends when a round changes nothing; loops (a = b) are components of their own.
    """
    loops = edges.filter("a = b").select(F.col("a").alias("node"))
    now = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = cut(small)
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    rest = loops.distinct().join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(rest).distinct()


def brightest_of_components(points: DataFrame, edges: DataFrame, node: str, rank: str) -> DataFrame:
    """Points that no edge meets, and of each component the one with the largest *rank* (the least id of ties)."""
    member = components(edges).withColumnRenamed("node", node)
    linked = points.join(member, node)
    order = Window.partitionBy("component").orderBy(F.desc(rank), node)
    best = linked.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k", "component")
    return points.join(member.select(node), node, "left_anti").unionByName(best)


def drop_most_overlapping(edges: DataFrame) -> DataFrame:
    """Nodes to drop until no edge is left, taking away in each round every node whose degree is the largest among its neighbours' (the larger hash of the id, then the larger id, of ties).

    Neighbours that have all other neighbours in common (the nodes of a clique, places that are the same) can't both stay, so all but the least
    id of them go at once. Rounds go on until no edge is left, and each ends with a checkpoint; degrees are map-side combined counts.
    """
    left = cut(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    dropped, rounds = None, 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mark = lambda c: F.xxhash64(c).cast("decimal(38,0)")
        degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.sum(mark("b")).alias("h")).select("a", "n", (F.col("h") + mark("a")).alias("h"))
        weight = F.struct("n", F.xxhash64("a").alias("x"), "a")
        own = degree.select("a", weight.alias("wa"), F.col("h").alias("ha"))
        other = degree.select(F.col("a").alias("b"), weight.alias("wb"), F.col("h").alias("hb"))
        twin = (F.col("ha") == F.col("hb")) & (F.col("wa.n") == F.col("wb.n")) & (F.col("a") > F.col("b"))
        worst = both.join(own, "a").join(other, "b").groupBy("a").agg(F.first("wa").alias("wa"), F.max("wb").alias("wb"), F.bool_or(twin).alias("twin")).filter("twin OR wa > wb").select(F.col("a").alias("node"))
        gone = cut(worst)
        dropped, rounds = gone if dropped is None else dropped.unionByName(gone), rounds + 1
        if rounds % JOIN_EVERY == 0:
            dropped = cut(dropped)
        left = cut(left.join(gone, left.a == gone.node, "left_anti").join(gone, F.col("b") == gone.node, "left_anti"))
    return dropped if dropped is not None else edges.select(F.col("a").alias("node")).limit(0)


def keep_greedy(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id of the nodes that are kept when they are walked from the largest *rank* down and one goes if a kept one is its neighbour.

    nodes: id, rank (no two alike); edges: a, b. In each round every node that ranks above all neighbours left is kept and its neighbours go, which is
    what the walk decides; nodes without edges are kept at once. Rounds go on until no edge is left and end with a checkpoint.
    """
    linked = cut(edges.join(nodes.select(F.col("id").alias("a"), F.col("rank").alias("ra")), "a").join(nodes.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b"))
    both = linked.select(F.when(F.col("ra") > F.col("rb"), F.col("a")).otherwise(F.col("b")).alias("high"), F.when(F.col("ra") > F.col("rb"), F.col("b")).otherwise(F.col("a")).alias("low"))
    left, gone = cut(both.distinct()), None
    while not left.isEmpty():
        top = left.select("high").distinct().join(left.select(F.col("low").alias("high")).distinct(), "high", "left_anti")
        beaten = cut(left.join(top, "high", "left_semi").select("low").distinct())
        gone = beaten if gone is None else gone.unionByName(beaten)
        out = beaten.withColumnRenamed("low", "node")
        left = cut(left.join(out, left.low == out.node, "left_anti").join(out, F.col("high") == out.node, "left_anti"))
    return nodes.select("id") if gone is None else nodes.select("id").join(gone.select(F.col("low").alias("id")), "id", "left_anti")
