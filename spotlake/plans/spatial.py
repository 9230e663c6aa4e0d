"""Queries: positions, tiles, neighbours, cells and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import graphs, spatial as sp
from spotlake.operators.proximity import containing_regions, near_pairs, overlapping_regions, places, region_parts
from spotlake.plans import query
from spotlake.plans.problems import PLACES_SQL
from spotlake.plans.quality import PIXEL, WIDTH
from spotlake.session import table
from spotlake.sources.views import MOLS_SQL, cells, molecules

#: Micrometres between planes.
PLANE_STEP = 1.5

_GOOD = f"WITH {MOLS_SQL}, good AS (SELECT * FROM mols WHERE fov IS NOT NULL AND global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL)"

def _good(spark: SparkSession, d: str) -> DataFrame:
    return molecules(spark, d).filter("fov IS NOT NULL AND global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL")


@query("z_interpolated", f"WITH {MOLS_SQL} SELECT molecule_id, round(1.5 * greatest(0.0, least(4.0, area / 5.0)), 6) AS zi FROM mols")
def z_interpolated(spark: SparkSession, d: str) -> DataFrame:
    return molecules(spark, d).select("molecule_id", F.round(sp.z_of_plane(F.col("area") / 5.0, [k * PLANE_STEP for k in range(5)]), 6).alias("zi"))


_RUN_POS = f"{_GOOD}, pos AS (SELECT run_id, fov, min(global_x) AS fx, min(global_y) AS fy FROM good GROUP BY run_id, fov)"
_RUN_BOX = f"{_RUN_POS}, box AS (SELECT run_id, fov, fx AS x0, fy AS y0, fx + {WIDTH * PIXEL} AS x1, fy + {WIDTH * PIXEL} AS y1 FROM pos)"
_TILE = ["run_id", "fov"]


def _run_positions(spark: SparkSession, d: str) -> DataFrame:
    """The corner of each tile of every run, as far as its own molecules show it."""
    return _good(spark, d).groupBy(*_TILE).agg(F.min("global_x").alias("fx"), F.min("global_y").alias("fy"))


@query("fov_positions", _RUN_POS + " SELECT run_id, fov, fx, fy FROM pos")
@query("run_fov_positions", _RUN_POS + " SELECT run_id, fov, fx, fy FROM pos")
def fov_positions(spark: SparkSession, d: str) -> DataFrame:
    return _run_positions(spark, d)


@query("to_global", _RUN_POS + f" SELECT run_id, molecule_id, round(fx + x * {PIXEL}, 6) AS gx, round(fy + y * {PIXEL}, 6) AS gy FROM good JOIN pos USING (run_id, fov)")
@query("run_to_global", _RUN_POS + f" SELECT run_id, molecule_id, round(fx + x * {PIXEL}, 6) AS gx, round(fy + y * {PIXEL}, 6) AS gy FROM good JOIN pos USING (run_id, fov)")
def to_global(spark: SparkSession, d: str) -> DataFrame:
    return sp.to_global(_good(spark, d), _run_positions(spark, d), PIXEL, _TILE).select("run_id", "molecule_id", F.round("gx", 6).alias("gx"), F.round("gy", 6).alias("gy"))


@query("to_pixels", _RUN_POS + f" SELECT run_id, molecule_id, CAST(trunc((global_x - fx) / {PIXEL}) AS INTEGER) AS px, CAST(trunc((global_y - fy) / {PIXEL}) AS INTEGER) AS py FROM good JOIN pos USING (run_id, fov)")
@query("run_to_pixels", _RUN_POS + f" SELECT run_id, molecule_id, CAST(trunc((global_x - fx) / {PIXEL}) AS INTEGER) AS px, CAST(trunc((global_y - fy) / {PIXEL}) AS INTEGER) AS py FROM good JOIN pos USING (run_id, fov)")
def to_pixels(spark: SparkSession, d: str) -> DataFrame:
    renamed = _good(spark, d).withColumnRenamed("global_x", "gx").withColumnRenamed("global_y", "gy")
    return sp.to_pixels(renamed, _run_positions(spark, d), PIXEL, _TILE).select("run_id", "molecule_id", "px", "py")


@query("fov_overlaps", _RUN_BOX + " SELECT a.run_id AS run_a, a.fov AS fov_a, b.run_id AS run_b, b.fov AS fov_b FROM box a JOIN box b ON (a.run_id <> b.run_id OR a.fov <> b.fov) AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1")
def fov_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of tiles of all runs, which share one frame."""
    made = sp.boxes(_run_positions(spark, d), WIDTH * PIXEL, WIDTH * PIXEL, ["run_id"]).withColumn("tile", F.struct("run_id", "fov"))
    return sp.overlapping_boxes(made, "tile", 250.0).select(F.col("a.run_id").alias("run_a"), F.col("a.fov").alias("fov_a"), F.col("b.run_id").alias("run_b"), F.col("b.fov").alias("fov_b"))


@query("run_fov_overlaps", _RUN_BOX + " SELECT a.run_id, a.fov AS a, b.fov AS b FROM box a JOIN box b ON a.run_id = b.run_id AND a.fov <> b.fov AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1")
def run_fov_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return sp.overlapping_boxes(sp.boxes(_run_positions(spark, d), WIDTH * PIXEL, WIDTH * PIXEL, ["run_id"]), "fov", 250.0, ["run_id"])


@query("global_extent", _RUN_BOX + " SELECT round(min(x0), 6) AS x0, round(min(y0), 6) AS y0, round(max(x1), 6) AS x1, round(max(y1), 6) AS y1 FROM box")
def global_extent(spark: SparkSession, d: str) -> DataFrame:
    b = sp.boxes(_run_positions(spark, d), WIDTH * PIXEL, WIDTH * PIXEL, ["run_id"])
    return b.agg(*[F.round(f(c), 6).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])


@query("run_global_extent", _RUN_BOX + " SELECT run_id, round(min(x0), 6) AS x0, round(min(y0), 6) AS y0, round(max(x1), 6) AS x1, round(max(y1), 6) AS y1 FROM box GROUP BY run_id")
def run_global_extent(spark: SparkSession, d: str) -> DataFrame:
    b = sp.boxes(_run_positions(spark, d), WIDTH * PIXEL, WIDTH * PIXEL, ["run_id"])
    return b.groupBy("run_id").agg(*[F.round(f(c), 6).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])


def _points(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    return places(molecules(spark, d), "molecule_id", "global_x", "global_y", *keep)


_PTS = f"WITH {MOLS_SQL}, pt AS (SELECT molecule_id AS id, CAST(round(global_x * 10000) AS BIGINT) AS px, CAST(round(global_y * 10000) AS BIGINT) AS py, z, barcode_id, magnitude, run_id FROM mols WHERE global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL)"


def _near(r: float) -> str:
    u = round(r * 10000)
    return f"""{_PTS}, c AS (SELECT *, CAST(floor(px / {u}.0) AS BIGINT) AS cx, CAST(floor(py / {u}.0) AS BIGINT) AS cy FROM pt),
w1 AS (SELECT id, px, py, cx + unnest([-1, 0, 1]) AS cx, cy FROM c), w AS (SELECT id, px, py, cx, cy + unnest([-1, 0, 1]) AS cy FROM w1),
n AS (SELECT w.id AS a, c.id AS b FROM w JOIN c USING (cx, cy) WHERE w.id <> c.id AND (w.px - c.px) * (w.px - c.px) + (w.py - c.py) * (w.py - c.py) <= {u * u})"""


@query("neighbour_counts", _near(3.0) + " SELECT a AS id, CAST(count(*) AS BIGINT) AS n FROM n GROUP BY a")
def neighbour_counts(spark: SparkSession, d: str) -> DataFrame:
    return sp.neighbour_counts(_points(spark, d), 3.0)


@query("isolated_molecules", _near(3.0) + " SELECT id FROM pt WHERE id NOT IN (SELECT a FROM n)")
def isolated_molecules(spark: SparkSession, d: str) -> DataFrame:
    return sp.isolated(_points(spark, d), 3.0).select("id")


@query("contact_matrix", _near(3.0) + " SELECT p.barcode_id AS type_a, q.barcode_id AS type_b, CAST(count(*) AS BIGINT) AS n FROM n JOIN pt p ON p.id = a JOIN pt q ON q.id = b GROUP BY 1, 2")
def contact_matrix(spark: SparkSession, d: str) -> DataFrame:
    pts = _points(spark, d, "barcode_id")
    return sp.contact_counts(pts, pts.select("id", F.col("barcode_id").alias("type")), 3.0)


_EACH = f"""{_PTS}, d AS (SELECT a.id, b.id AS other_id, (a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py) AS d2 FROM pt a JOIN pt b ON a.id <> b.id),
f AS (SELECT id, min({{'d2': d2, 'other_id': other_id}}) AS m FROM d GROUP BY id), n AS (SELECT id, m.other_id AS other_id, round(sqrt(CAST(m.d2 AS DOUBLE)) / 10000, 4) AS distance FROM f)"""


def _nearest_each(spark: SparkSession, d: str) -> DataFrame:
    pts = _points(spark, d)
    return sp.nearest_of_all(pts, pts, 5.0).select("id", "other_id", F.round(F.sqrt(F.col("d2").cast("double")) / 10000, 4).alias("distance"))


@query("nearest_odd", _EACH + " SELECT id, other_id, distance FROM n")
@query("nearest_each", _EACH + " SELECT id, other_id, distance FROM n")
def nearest_each(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other molecule of every molecule, however far."""
    return _nearest_each(spark, d)


@query("mutual_nearest", _EACH + " SELECT a.id, a.other_id, a.distance FROM n a JOIN n b ON b.id = a.other_id AND b.other_id = a.id WHERE a.id < a.other_id")
@query("mutual_nearest_each", _EACH + " SELECT a.id, a.other_id, a.distance FROM n a JOIN n b ON b.id = a.other_id AND b.other_id = a.id WHERE a.id < a.other_id")
def mutual_nearest_each(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of molecules that are each other's nearest."""
    forth = _nearest_each(spark, d)
    back = forth.select(F.col("id").alias("other_id"), F.col("other_id").alias("id"))
    return forth.filter("id < other_id").join(back, ["id", "other_id"])


_LINK = (
    _near(1.5)
    + """, l AS (SELECT p.id AS a, q.id AS b, (p.px - q.px) * (p.px - q.px) + (p.py - q.py) * (p.py - q.py) AS d2, q.z AS oz FROM n JOIN pt p ON p.id = n.a JOIN pt q ON q.id = n.b
WHERE p.barcode_id = q.barcode_id AND p.z <> q.z AND abs(p.z - q.z) <= 1.5),
best AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT *, row_number() OVER (PARTITION BY a, oz ORDER BY d2, b) AS k FROM l) WHERE k = 1)"""
)


def _links(spark: SparkSession, d: str) -> DataFrame:
    return sp.plane_links(_points(spark, d, "z", "barcode_id"), PLANE_STEP, 1.5, "barcode_id")


@query("zplane_links", _LINK + " SELECT a, b FROM best")
def zplane_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


_CC = """, both_ways AS (SELECT a, b FROM best UNION SELECT b, a FROM best),
cc AS (WITH RECURSIVE r(node, root) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT e.b, r.root FROM r JOIN both_ways e ON e.a = r.node) SELECT node, min(root) AS component FROM r GROUP BY node)"""


@query("zplane_components", _LINK + _CC + " SELECT node, component FROM cc")
def zplane_components(spark: SparkSession, d: str) -> DataFrame:
    return graphs.components(_links(spark, d))


@query(
    "zplane_deduplicated",
    _LINK + _CC + """ SELECT id FROM (SELECT pt.id, row_number() OVER (PARTITION BY coalesce(component, -id) ORDER BY CASE WHEN isnan(magnitude) THEN 1e308 ELSE coalesce(magnitude, -1) END DESC, pt.id) AS k FROM pt LEFT JOIN cc ON cc.node = pt.id) WHERE k = 1""",
)
def zplane_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    pts = _points(spark, d, "magnitude").withColumn("rank", F.when(F.isnan("magnitude"), 1e308).otherwise(F.coalesce("magnitude", F.lit(-1.0))))
    return graphs.brightest_of_components(pts.select("id", "rank"), _links(spark, d), "id", "rank").select("id")


@query("dense_molecules_dropped")
def dense_molecules_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Molecules to drop so that no two are within 1 micrometre, the most crowded first (rounds of local maxima)."""
    return graphs.drop_most_overlapping(near_pairs(_points(spark, d), 1.0).select(F.col("id").alias("a"), F.col("other_id").alias("b")))


#: Areas of polygons (of their outer rings less the holes), in square micrometres, by cell and plane.
_AREAS = f"""{PLACES_SQL}, ring_area AS (SELECT id, z, part, k, abs(sum(list_reduce([(p[i][1] - p[1][1]) * (p[i % len(p) + 1][2] - p[1][2]) - (p[i % len(p) + 1][1] - p[1][1]) * (p[i][2] - p[1][2])], lambda u, v: u + v))) / 2000000.0 AS a
 FROM (SELECT id, z, part, k, p, unnest(range(1, len(p) + 1)) AS i FROM pts WHERE len(p) > 2) GROUP BY 1, 2, 3, 4),
measure AS (SELECT r.id AS region_id, r.z, r.area, b.x0 / 1000.0 AS min_x, b.x1 / 1000.0 AS max_x, b.y0 / 1000.0 AS min_y, b.y1 / 1000.0 AS max_y
 FROM (SELECT id, z, sum(CASE WHEN k = 1 THEN a ELSE -a END) AS area FROM ring_area GROUP BY 1, 2) r JOIN (SELECT id, z, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM box GROUP BY 1, 2) b ON b.id = r.id AND b.z IS NOT DISTINCT FROM r.z)"""
_VOLUME = """, vol AS (SELECT region_id, count(*) AS planes, CASE WHEN count(*) = 1 THEN max(area) ELSE sum(slab) END AS volume
 FROM (SELECT region_id, area, (lead(z) OVER w - z) * (lead(area) OVER w + area) / 2 AS slab FROM measure WINDOW w AS (PARTITION BY region_id ORDER BY z)) GROUP BY 1)"""
_ASSIGNED = f"{PLACES_SQL}, {MOLS_SQL}, assigned AS (SELECT m AS molecule_id, min(id) AS cell FROM side WHERE on_edge = 0 AND crossings % 2 = 1 GROUP BY 1)"
#: Cells whose borders cross, or of which a corner or the middle of an edge lies inside the other.
_OVERLAPS = f"""{PLACES_SQL}, pair AS (SELECT a.id AS ia, a.part AS pa, b.id AS ib, b.part AS pb, a.z FROM box a JOIN box b ON a.z = b.z AND a.id <> b.id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1),
crossed AS (SELECT DISTINCT ia, ib FROM pair JOIN edge e ON e.id = ia AND e.part = pa AND e.z = pair.z JOIN edge f ON f.id = ib AND f.part = pb AND f.z = pair.z
 WHERE sign((e.qx - e.ax) * (f.ay - e.ay) - (e.qy - e.ay) * (f.ax - e.ax)) * sign((e.qx - e.ax) * (f.qy - e.ay) - (e.qy - e.ay) * (f.qx - e.ax)) < 0
 AND sign((f.qx - f.ax) * (e.ay - f.ay) - (f.qy - f.ay) * (e.ax - f.ax)) * sign((f.qx - f.ax) * (e.qy - f.ay) - (f.qy - f.ay) * (e.qx - f.ax)) < 0),
corner AS (SELECT DISTINCT ia, ib, pb, pair.z, 2 * e.ax AS x, 2 * e.ay AS y FROM pair JOIN edge e ON e.id = ia AND e.part = pa AND e.z = pair.z UNION SELECT ia, ib, pb, pair.z, e.ax + e.qx, e.ay + e.qy FROM pair JOIN edge e ON e.id = ia AND e.part = pa AND e.z = pair.z),
held AS (SELECT ia, ib FROM corner JOIN edge e ON e.id = ib AND e.part = pb AND e.z = corner.z GROUP BY ia, ib, pb, corner.z, x, y
 HAVING count(*) FILTER (((2 * ay > y) <> (2 * qy > y)) AND ((qy > ay) = ((2 * (qx - ax) * (y - 2 * ay) - 2 * (qy - ay) * (x - 2 * ax)) > 0))) % 2 = 1
 AND count(*) FILTER (((qx - ax) * (y - 2 * ay) = (qy - ay) * (x - 2 * ax)) AND x BETWEEN 2 * least(ax, qx) AND 2 * greatest(ax, qx) AND y BETWEEN 2 * least(ay, qy) AND 2 * greatest(ay, qy)) = 0),
overlap AS (SELECT DISTINCT least(ia, ib) AS a, greatest(ia, ib) AS b FROM (SELECT ia, ib FROM crossed UNION ALL SELECT ia, ib FROM held))"""


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return region_parts(table(spark, d, "cells"), "id", "geometry", "z")


@query("cell_measures", f"{_AREAS} SELECT region_id, z, round(area, 4) AS area, min_x, max_x, min_y, max_y FROM measure")
def cell_measures(spark: SparkSession, d: str) -> DataFrame:
    """Area and box of every cell on every plane (outer ring less holes)."""
    return sp.region_measures(_parts(spark, d)).withColumn("area", F.round("area", 4))


@query("cell_volumes", f"{_AREAS}{_VOLUME} SELECT region_id, CAST(planes AS BIGINT) AS planes, round(volume, 4) AS volume FROM vol")
def cell_volumes(spark: SparkSession, d: str) -> DataFrame:
    return sp.region_volume(sp.region_measures(_parts(spark, d))).withColumn("volume", F.round("volume", 4))


@query("cell_rows", "WITH c AS (SELECT DISTINCT id, fov, x, y, z, geometry FROM cells) SELECT id, CAST(count(*) AS BIGINT) AS polygons, CAST(count(DISTINCT z) AS BIGINT) AS planes, min(fov) AS fov, min(z) AS z FROM c WHERE geometry IS NOT NULL GROUP BY id")
def cell_rows(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).filter("geometry IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("polygons"), F.count_distinct("z").alias("planes"), F.min("fov").alias("fov"), F.min("z").alias("z"))


@query("assigned_counts", f"{_ASSIGNED} SELECT cell, barcode_id AS gene, CAST(count(*) AS BIGINT) AS n FROM assigned JOIN mols USING (molecule_id) GROUP BY 1, 2")
def assigned_counts(spark: SparkSession, d: str) -> DataFrame:
    """Cell by gene counts by the cells' polygons: a molecule belongs to the least id of the cells that hold it."""
    pts = _points(spark, d, "z", "barcode_id")
    inside = containing_regions(pts.select("id", "px", "py", "z"), _parts(spark, d), "z").groupBy("id").agg(F.min("region_id").alias("cell_id"))
    named = pts.select("id", "barcode_id").join(inside, "id")
    return named.groupBy(F.col("cell_id").alias("cell"), F.col("barcode_id").alias("gene")).agg(F.count(F.lit(1)).alias("n"))


@query("cell_overlaps", f"{_OVERLAPS} SELECT a, b FROM overlap")
def cell_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of cells whose insides meet on a plane."""
    return overlapping_regions(_parts(spark, d), "z")


@query("cells_without_overlap")
def cells_without_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the cells that stay after the most overlapping ones are dropped."""
    dropped = graphs.drop_most_overlapping(overlapping_regions(_parts(spark, d), "z"))
    return table(spark, d, "cells").select("id").distinct().join(dropped.withColumnRenamed("node", "id"), "id", "left_anti")
