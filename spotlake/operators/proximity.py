"""Points near other points, and regions that contain points (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions are whole numbers of 1/UNITS micrometre, so that distances and edges are compared exactly.
UNITS = 10_000
#: Beyond this many micrometres a coordinate is no place (keeps products within 64 bits).
FARTHEST = 1e8


def _units(c: Column) -> Column:
    return F.when(F.abs(c) <= FARTHEST, F.round(c * UNITS).cast("bigint"))  # NaN compares as larger than any number


def _cell(c: Column, size: int) -> Column:
    return F.floor(c / F.lit(size)).cast("bigint")


def places(df: DataFrame, id_column: str, x: str, y: str, *keep: str) -> DataFrame:
    """id, px, py and the kept columns of the rows that have both coordinates."""
    out = df.select(F.col(id_column).alias("id"), _units(F.col(x)).alias("px"), _units(F.col(y)).alias("py"), *keep)
    return out.filter(F.col("px").isNotNull() & F.col("py").isNotNull() & F.col("id").isNotNull())


def near_pairs(points: DataFrame, radius: float, cells_per_radius: int = 4, keep: str | None = None) -> DataFrame:
    """Pairs (id, other_id), id < other_id, of *points* (of places()) at most *radius* apart, each once.

    With *keep*, a column that each id has one value of, the pairs have it of both (keep, other_keep).

    Points are hashed to square grid cells of cells_per_radius radii. One side stands in its own cell, the other in every
    cell within the radius (about (1 + 2/cells_per_radius)^2 copies), so each pair meets in the cell of the smaller id only; the
    exact distance is verified in whole units inside the join. Repeated rows of a point are merged before the join. The
    join is a plain equi-join on the cell, so AQE splits a cell that holds many of the points. An id with several
    places counts with each of them. Points at one place are 0 apart. Empty input gives no rows.
    """
    r = round(radius * UNITS)
    size = r * cells_per_radius
    mine, theirs = ([keep], [f"other_{keep}"]) if keep else ([], [])
    once = points.select("id", "px", "py", *mine).distinct()
    own = once.select("id", "px", "py", *mine, _cell(F.col("px"), size).alias("cx"), _cell(F.col("py"), size).alias("cy"))

    def reach(c: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(c) - r, size), _cell(F.col(c) + r, size)))

    other = once.select(F.col("id").alias("other_id"), *[F.col(m).alias(t) for m, t in zip(mine, theirs)], F.col("px").alias("ox"), F.col("py").alias("oy"), reach("px").alias("cx"), "py").select(
        "other_id", *theirs, "ox", "oy", "cx", reach("py").alias("cy")
    )
    dx, dy = F.col("px") - F.col("ox"), F.col("py") - F.col("oy")
    return (
        own.join(other, ["cx", "cy"])
        .filter((F.col("id") < F.col("other_id")) & (dx * dx + dy * dy <= r * r))
        .select("id", "other_id", *mine, *theirs)
        .distinct()
    )


#: The polygons of a well-known text, each with its rings: two or three levels of brackets, numbers in any notation.
PART_PATTERN = r"\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)"
RINGS_EXPR = rf"""
transform(regexp_extract_all(part, '\\(([^()]*)\\)', 1), r ->
  transform(split(trim(r), '\\s*,\\s*'), p -> named_struct(
    'x', cast(round(try_cast(split(trim(p), '\\s+')[0] as double) * {UNITS}) as bigint),
    'y', cast(round(try_cast(try_element_at(split(trim(p), '\\s+'), 2) as double) * {UNITS}) as bigint))))
"""
_EDGES = """
flatten(transform(rings, r -> transform(sequence(0, size(r) - 1), i -> named_struct(
  'ax', r[i].x, 'ay', r[i].y, 'bx', r[(i + 1) % size(r)].x, 'by', r[(i + 1) % size(r)].y))))
"""
#: The outer ring's area less the holes', whatever the rings' directions, in square micrometres.
AREA_EXPR = f"""
aggregate(transform(rings, r -> abs(aggregate(sequence(0, size(r) - 1), cast(0 as bigint), (s, i) -> s
    + (r[i].x - r[0].x) * (r[(i + 1) % size(r)].y - r[0].y) - (r[(i + 1) % size(r)].x - r[0].x) * (r[i].y - r[0].y)))
  / (2.0D * {UNITS} * {UNITS})), struct(0 AS k, 0.0D AS a), (t, x) -> struct(t.k + 1 AS k, t.a + IF(t.k = 0, x, -x) AS a), t -> t.a)
"""
#: 1 inside, 0 outside, -1 on an edge or corner: the parity of crossings, in whole numbers.
_SIDE = """
aggregate(edges, 0, (side, e) -> CASE
  WHEN side < 0 THEN side
  WHEN py < least(e.ay, e.by) OR py > greatest(e.ay, e.by) THEN side
  WHEN (e.bx - e.ax) * (py - e.ay) = (e.by - e.ay) * (px - e.ax)
       AND px BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) THEN -1
  WHEN (e.ay > py) != (e.by > py)
       AND (e.by > e.ay) = ((e.bx - e.ax) * (py - e.ay) > (e.by - e.ay) * (px - e.ax)) THEN 1 - side
  ELSE side END)
"""


def region_parts(df: DataFrame, id_column: str, wkt: str, *keep: str) -> DataFrame:
    """One row for each polygon of a well-known text: id, edges (holes included), area, its box, and the kept columns.

    Case, spacing and an SRID prefix don't matter, nor does a ring's direction or whether it repeats its first point. Null, empty and
    unreadable geometries give no rows; nor do rings of fewer than three points count.
    """
    return (
        df.filter(F.col(id_column).isNotNull() & F.col(wkt).isNotNull())
        .select(F.col(id_column).alias("region_id"), *keep, F.explode(F.regexp_extract_all(F.col(wkt), F.lit(PART_PATTERN), F.lit(0))).alias("part"))
        .distinct()
        .select("region_id", *keep, F.expr(f"filter({RINGS_EXPR}, r -> size(r) > 2)").alias("rings"))
        .filter("size(rings) > 0 AND NOT exists(rings, r -> exists(r, p -> p.x IS NULL OR p.y IS NULL))")
        .select("region_id", *keep, F.expr(_EDGES).alias("edges"), F.expr(AREA_EXPR).alias("area"))
        .select(
            "*",
            *(F.expr(f"array_{f}(transform(edges, e -> e.a{c}))").alias(f"{f}_{c}") for f in ("min", "max") for c in "xy"),
        )
    )


def containing_regions(points: DataFrame, regions: DataFrame, plane: str, tile: float = 32.0) -> DataFrame:
    """Pairs (id, region_id) of points strictly inside a region on the same *plane*, each once.

    Regions (of region_parts()) are put into every tile of *tile* micrometres that their box meets, with the edges that meet the tile's
    rows (others can't cross a point's row), points into one tile; the equi-join is on plane and tile, so AQE can split a hot tile. The box, then exact point-in-polygon arithmetic in
    whole units decide: points on an edge or corner or in a hole are outside. A null plane matches nothing.
    """
    size = round(tile * UNITS)
    spread = (
        regions.select("*", F.explode(F.sequence(_cell(F.col("min_x"), size), _cell(F.col("max_x"), size))).alias("cx"))
        .select("*", F.explode(F.sequence(_cell(F.col("min_y"), size), _cell(F.col("max_y"), size))).alias("cy"))
        .withColumn("edges", F.filter("edges", lambda e: (F.least(e["ay"], e["by"]) < (F.col("cy") + 1) * size) & (F.greatest(e["ay"], e["by"]) >= F.col("cy") * size)))
    )
    own = points.select("id", "px", "py", plane, _cell(F.col("px"), size).alias("cx"), _cell(F.col("py"), size).alias("cy"))
    return (
        own.join(spread, [plane, "cx", "cy"])
        .filter(F.col("px").between(F.col("min_x"), F.col("max_x")) & F.col("py").between(F.col("min_y"), F.col("max_y")))
        .filter(F.expr(_SIDE) == 1)
        .select("id", "region_id")
        .distinct()
    )


def overlapping_regions(regions: DataFrame, plane: str, tile: float = 32.0) -> DataFrame:
    """Pairs (a, b), a < b, of regions of different ids whose insides meet on a plane: edges cross, a corner or the middle of a piece of an edge of one lies strictly inside the other, or both have the same border.

    Edges stand in every tile that their box meets, so crossings are an equi-join on plane and tile with an exact test. An edge's pieces are
    those between the other's corners on it, so borders along a common line are told apart. Polygons with the same border are one class, by their
    corners where the border turns.
    """
    size = round(tile * UNITS)
    edges = regions.select("region_id", plane, F.explode("edges").alias("e")).select("region_id", plane, "e.*")
    low = lambda c: _cell(F.least(f"a{c}", f"b{c}"), size)
    high = lambda c: _cell(F.greatest(f"a{c}", f"b{c}"), size)
    spread = edges.select("*", F.explode(F.sequence(low("x"), high("x"))).alias("cx")).select("*", F.explode(F.sequence(low("y"), high("y"))).alias("cy"))
    other = spread.select(plane, "cx", "cy", F.col("region_id").alias("other"), *[F.col(c).alias(n) for c, n in (("ax", "px"), ("ay", "py"), ("bx", "qx"), ("by", "qy"))])

    def side(x: str, y: str, ox: str, oy: str, tx: str, ty: str) -> Column:
        cross = (F.col(tx) - F.col(ox)) * (F.col(y) - F.col(oy)) - (F.col(ty) - F.col(oy)) * (F.col(x) - F.col(ox))
        return F.signum(cross.cast("double"))

    apart = (side("px", "py", "ax", "ay", "bx", "by") * side("qx", "qy", "ax", "ay", "bx", "by") < 0) & (side("ax", "ay", "px", "py", "qx", "qy") * side("bx", "by", "px", "py", "qx", "qy") < 0)
    crossing = spread.join(other, [plane, "cx", "cy"]).filter((F.col("region_id") < F.col("other")) & apart).select(F.col("region_id").alias("a"), F.col("other").alias("b"))
    corners = edges.select(F.col("region_id").alias("id"), F.col("ax").alias("px"), F.col("ay").alias("py"), plane)
    # middles have halves: all coordinates are doubled for them
    twice = regions.select("region_id", plane, F.transform("edges", lambda e: F.struct(*[(2 * e[c]).alias(c) for c in ("ax", "ay", "bx", "by")])).alias("edges"), *[(2 * F.col(c)).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])
    on = (side("px", "py", "ax", "ay", "bx", "by") == 0) & F.col("px").between(F.least("ax", "bx"), F.greatest("ax", "bx")) & F.col("py").between(F.least("ay", "by"), F.greatest("ay", "by"))
    edge = ["region_id", plane, "ax", "ay", "bx", "by"]
    touching = spread.join(other, [plane, "cx", "cy"]).filter((F.col("region_id") != F.col("other")) & on).select(*edge, "other", F.struct(F.col("px").alias("x"), F.col("py").alias("y")).alias("p"))
    ends = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    cuts = F.array_sort(F.array_union("ps", ends))  # along a straight edge the order by x, then y, is the order of the points
    pieces = touching.groupBy(*edge, "other").agg(F.collect_set("p").alias("ps")).select(F.col("region_id").alias("id"), plane, F.explode(F.arrays_zip(F.slice(cuts, 1, F.size(cuts) - 1).alias("s"), F.slice(cuts, 2, F.size(cuts)).alias("t"))).alias("m"))
    middles = pieces.select("id", plane, (F.col("m.s.x") + F.col("m.t.x")).alias("px"), (F.col("m.s.y") + F.col("m.t.y")).alias("py")).unionByName(
        edges.select(F.col("region_id").alias("id"), plane, (F.col("ax") + F.col("bx")).alias("px"), (F.col("ay") + F.col("by")).alias("py"))
    )
    within = containing_regions(corners, regions, plane, tile).unionByName(containing_regions(middles.distinct(), twice, plane, 2 * tile)).filter(F.col("id") != F.col("region_id"))
    inside = within.select(F.least("id", "region_id").alias("a"), F.greatest("id", "region_id").alias("b"))
    real = F.filter("edges", lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))
    turns = F.expr("""array_sort(array_distinct(transform(filter(es, e -> NOT exists(es, f -> f.bx = e.ax AND f.by = e.ay
        AND (f.bx - f.ax) * (e.by - e.ay) = (f.by - f.ay) * (e.bx - e.ax))), e -> struct(e.ax, e.ay))))""")
    classes = regions.select("region_id", plane, "area", real.alias("es")).select("region_id", plane, "area", turns.alias("turns"))
    same = classes.join(classes.withColumnRenamed("region_id", "other"), [plane, "area", "turns"]).filter(F.col("region_id") < F.col("other")).select(F.col("region_id").alias("a"), F.col("other").alias("b"))
    return crossing.unionByName(inside).unionByName(same).distinct()
