"""Positions, tiles, neighbours and cells, on the grid of spotlake.operators.proximity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.proximity import UNITS, near_pairs
from spotlake.session import cut

#: Rows up to which the queries left over in nearest_of_all() are broadcast (some 8 MB in nine cells each).
FEW = 20_000


def to_global(df: DataFrame, positions: DataFrame, pixel: float, keys: list[str]) -> DataFrame:
    """gx, gy of pixel positions: the tile's position plus pixels in micrometres. Positions have one row a tile, named by *keys*; tiles grow with the runs, so Spark chooses the join."""
    return df.join(positions, keys).withColumn("gx", F.col("fx") + F.col("x") * pixel).withColumn("gy", F.col("fy") + F.col("y") * pixel)


def to_pixels(df: DataFrame, positions: DataFrame, pixel: float, keys: list[str]) -> DataFrame:
    """px, py: the inverse, cut toward zero."""
    inverse = lambda g, o: ((F.col(g) - F.col(o)) / pixel).cast("int")
    return df.join(positions, keys).withColumn("px", inverse("gx", "fx")).withColumn("py", inverse("gy", "fy"))


def z_of_plane(plane: Column, planes: list[float]) -> Column:
    """The z of a fractional plane number, by linear interpolation between the planes, held at the ends."""
    low = F.greatest(F.lit(0), F.least(F.lit(len(planes) - 2), F.floor(plane).cast("int")))
    at = F.greatest(F.lit(0.0), F.least(F.lit(float(len(planes) - 1)), plane)) - low
    z = F.array(*[F.lit(float(p)) for p in planes])
    a, b = F.element_at(z, low + 1), F.element_at(z, low + 2)
    return a + (b - a) * at


def boxes(positions: DataFrame, width: float, height: float, keep: list[str] | None = None) -> DataFrame:
    """The columns to keep and fov, x0, y0, x1, y1 of each tile."""
    return positions.select(*(keep or []), "fov", F.col("fx").alias("x0"), F.col("fy").alias("y0"), (F.col("fx") + width).alias("x1"), (F.col("fy") + height).alias("y1"))


def overlapping_boxes(tiles: DataFrame, key: str, cell: float, within: list[str] | None = None) -> DataFrame:
    """Ordered pairs (a, b), a != b, of boxes that meet (touching counts), of equal *within* columns: each box stands in every grid cell it meets, and the equi-join is on those and the cell."""
    same = within or []
    spread = tiles.select(*same, F.col(key).alias("k"), "x0", "y0", "x1", "y1", F.explode(F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))).alias("cx")).select(
        "*", F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))).alias("cy")
    )
    on = [*same, "cx", "cy"]
    other = spread.select(*[F.col(c).alias(f"o_{c}") if c not in on else F.col(c) for c in spread.columns])
    meets = (F.col("x0") <= F.col("o_x1")) & (F.col("o_x0") <= F.col("x1")) & (F.col("y0") <= F.col("o_y1")) & (F.col("o_y0") <= F.col("y1"))
    return spread.join(other, on).filter((F.col("k") != F.col("o_k")) & meets).select(*same, F.col("k").alias("a"), F.col("o_k").alias("b")).distinct()


def neighbour_counts(points: DataFrame, radius: float) -> DataFrame:
    """id, n: the number of other points within *radius* (inclusive) of each that has any."""
    pairs = near_pairs(points, radius)
    return pairs.select(F.explode(F.array("id", "other_id")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def isolated(points: DataFrame, radius: float) -> DataFrame:
    """Points without another one within *radius*."""
    return points.join(neighbour_counts(points, radius).select("id"), "id", "left_anti")


def contact_counts(points: DataFrame, types: DataFrame, radius: float) -> DataFrame:
    """Directed contacts between types: type_a, type_b, n, over pairs of points within *radius*. types: id, type."""
    typed = points.select("id", "px", "py").join(types.select("id", F.col("type").alias("t")).distinct(), "id")
    both = near_pairs(typed, radius, keep="t").groupBy(F.col("t").alias("ta"), F.col("other_t").alias("tb")).agg(F.count(F.lit(1)).alias("n"))
    return both.unionByName(both.select(F.col("tb").alias("ta"), F.col("ta").alias("tb"), "n")).groupBy(F.col("ta").alias("type_a"), F.col("tb").alias("type_b")).agg(F.sum("n").alias("n"))


def nearest(queries: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """For each query the nearest point within *radius*: id, other_id (the least of ties), d2 (squared, in whole units); queries without one are left out.

    The grid cell is the radius wide, so a query joins 9 cells, and the nearest is a map-side combined minimum. For points farther
    away call it again with a larger radius for the queries that are left.
    """
    r = round(radius * UNITS)
    cell = lambda c: F.floor(F.col(c) / F.lit(r)).cast("bigint")
    around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    own = queries.select("id", "px", "py", around("px").alias("cx")).select("*", around("py").alias("cy"))
    other = points.select(F.col("id").alias("other_id"), F.col("px").alias("ox"), F.col("py").alias("oy"), cell("px").alias("cx"), cell("py").alias("cy"))
    dx, dy = F.col("px") - F.col("ox"), F.col("py") - F.col("oy")
    d2 = dx * dx + dy * dy
    best = own.join(other, ["cx", "cy"]).filter(d2 <= r * r).groupBy("id").agg(F.min(F.struct(d2.alias("d2"), "other_id")).alias("m"))
    return best.select("id", "m.other_id", "m.d2")


def mutual_nearest(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Pairs that are each other's nearest within *radius*: id (of a), other_id (of b), d2."""
    forth = nearest(a, b, radius)
    back = nearest(b, a, radius).select(F.col("id").alias("other_id"), F.col("other_id").alias("id"))
    return forth.join(back, ["id", "other_id"])


def nearest_of_all(queries: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """For each query the nearest point of another id, however far: id, other_id (the least of ties), d2 (squared, in whole units, decimal).

    Starts with *radius* and doubles it for the queries that are left until none is, or until it spans all places, so only queries without
    any other id get no row. Grid cells are the radius wide; each round's result and what is left are cut.
    """
    points = cut(points.select(F.col("id").alias("other_id"), F.col("px").alias("ox"), F.col("py").alias("oy")))
    left = cut(queries.select("id", "px", "py"))
    ends = lambda a, b: [F.min(a), F.max(a), F.min(b), F.max(b)]
    (x0, x1, y0, y1), (u0, u1, v0, v1) = left.agg(*ends("px", "py")).first(), points.agg(*ends("ox", "oy")).first()
    found = left.select("id", F.col("id").alias("other_id"), F.lit(0).cast("decimal(38,0)").alias("d2")).limit(0)
    if x0 is None or u0 is None:
        return found
    span, r = max(x1, u1) - min(x0, u0) + max(y1, v1) - min(y0, v0), max(1, round(radius * UNITS))
    dx, dy = (F.col(a) - F.col(b) for a, b in (("px", "ox"), ("py", "oy")))
    while n := left.count():
        cell = lambda c: F.floor(F.col(c) / F.lit(r)).cast("bigint")  # noqa: B023, E731
        around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))  # noqa: B023, E731
        own = left.select("id", "px", "py", around("px").alias("cx")).select("*", around("py").alias("cy"))
        other = points.select("*", cell("ox").alias("cx"), cell("oy").alias("cy"))
        wide = (lambda c: c.cast("decimal(19,0)")) if r > 1_000_000_000 else (lambda c: c)  # squares of farther places don't fit 64 bits
        d2 = wide(dx) * wide(dx) + wide(dy) * wide(dy)
        close = other.join(F.broadcast(own) if n <= FEW else own, ["cx", "cy"]).filter((F.col("id") != F.col("other_id")) & (d2 <= F.lit(str(r * r)).cast("decimal(38,0)")))
        best = cut(close.groupBy("id").agg(F.min(F.struct(d2.cast("decimal(38,0)").alias("d2"), "other_id")).alias("m")).select("id", "m.other_id", "m.d2"))
        found = found.unionByName(best)
        if r > span:
            break
        left, r = cut(left.join(best.select("id"), "id", "left_anti")), 2 * r
    return found


def plane_links(points: DataFrame, reach: float, radius: float, by: str) -> DataFrame:
    """Edges (a, b) between points of one *by* value in planes at most *reach* micrometres apart: each point to its nearest within *radius* in every other plane.

    points: id, px, py, z, and *by*. A plane is any z there is; points without z have no links. Grid cells are the radius wide, so all
    candidates come from one equi-join.
    """
    placed = points.withColumn("_p", F.col("z")).filter("_p IS NOT NULL AND NOT isnan(_p)")
    r = round(radius * UNITS)
    cell = lambda c: F.floor(F.col(c) / F.lit(r)).cast("bigint")
    around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    own = placed.select("id", "px", "py", "_p", by, around("px").alias("cx")).select("*", around("py").alias("cy"))
    other = placed.select(F.col("id").alias("oid"), F.col("px").alias("ox"), F.col("py").alias("oy"), F.col("_p").alias("op"), by, cell("px").alias("cx"), cell("py").alias("cy"))
    dx, dy = F.col("px") - F.col("ox"), F.col("py") - F.col("oy")
    d2 = dx * dx + dy * dy
    close = own.join(other, [by, "cx", "cy"]).filter((F.col("_p") != F.col("op")) & (F.round(F.abs(F.col("_p") - F.col("op")), 6) <= reach) & (d2 <= r * r))
    best = close.groupBy("id", "op").agg(F.min(F.struct(d2.alias("d2"), "oid")).alias("m"))
    return best.select(F.least("id", "m.oid").alias("a"), F.greatest("id", "m.oid").alias("b")).distinct()


def region_measures(parts: DataFrame) -> DataFrame:
    """region_id, z, area (square micrometres, holes off) and box of the polygons of region_parts() on each plane."""
    scaled = lambda f, c: (f(c) / F.lit(float(UNITS))).alias(c)
    return parts.groupBy("region_id", "z").agg(F.sum("area").alias("area"), scaled(F.min, "min_x"), scaled(F.max, "max_x"), scaled(F.min, "min_y"), scaled(F.max, "max_y"))


def region_volume(measures: DataFrame) -> DataFrame:
    """region_id, planes, volume: trapezoids over z of the areas; the area itself for a single plane."""
    w = Window.partitionBy("region_id").orderBy("z")
    slab = (F.lead("z").over(w) - F.col("z")) * (F.lead("area").over(w) + F.col("area")) / 2
    return measures.withColumn("slab", slab).groupBy("region_id").agg(F.count(F.lit(1)).alias("planes"), F.when(F.count(F.lit(1)) == 1, F.first("area")).otherwise(F.sum("slab")).alias("volume"))
