"""Queries: polygons of cells exchanged, compared and cleaned, and labels that follow each other through the planes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import cells as ce
from spotlake.operators import models as mo
from spotlake.operators import spatial as sp
from spotlake.operators.proximity import UNITS, containing_regions, places
from spotlake.plans import query
from spotlake.plans.models import LABELS_SQL, _label_pixels
from spotlake.plans.problems import PLACES_SQL
from spotlake.plans.spatial import _AREAS, _ASSIGNED, _VOLUME, PLANE_STEP, _parts, _points
from spotlake.session import table
from spotlake.sources.views import MOLS_SQL, cells, molecules


@query("assigned_molecules", f"{_ASSIGNED} SELECT molecule_id, cell FROM assigned JOIN mols USING (molecule_id)")
def assigned_molecules(spark: SparkSession, d: str) -> DataFrame:
    """The cell of every molecule that lies in one, the least id of several."""
    inside = containing_regions(_points(spark, d, "z"), _parts(spark, d), "z")
    return inside.groupBy(F.col("id").alias("molecule_id")).agg(F.min("region_id").alias("cell"))


@query("cells_clean", f"{_AREAS}{_VOLUME} SELECT region_id FROM vol WHERE volume > 0")
def cells_clean(spark: SparkSession, d: str) -> DataFrame:
    """Cells with a box and a volume."""
    return sp.region_volume(sp.region_measures(_parts(spark, d))).filter("volume > 0").select("region_id")


@query(
    "cell_geojson",
    f"{_AREAS} SELECT a.id, a.z, CAST(count(*) AS BIGINT) AS polygons, round(sum(a.area), 4) AS area, CAST(sum(a.n) AS BIGINT) AS corners FROM (SELECT r.id, r.z, r.part, sum(CASE WHEN r.k = 1 THEN a ELSE -a END) AS area, sum(len(p) - CASE WHEN p[1] = p[len(p)] THEN 1 ELSE 0 END) AS n FROM ring_area r JOIN pts ON pts.id = r.id AND pts.z IS NOT DISTINCT FROM r.z AND pts.part = r.part AND pts.k = r.k GROUP BY 1, 2, 3) a GROUP BY 1, 2",
)
def cell_geojson(spark: SparkSession, d: str) -> DataFrame:
    """Polygons, corners and area of every cell and plane after they were written as GeoJSON and read again."""
    back = ce.from_geojson(ce.to_geojson(table(spark, d, "cells"), "id", "geometry", "z"), "id", "z")
    return back.groupBy("id", "z").agg(F.count(F.lit(1)).alias("polygons"), F.round(F.sum("area"), 4).alias("area"), F.sum("corners").alias("corners"))


@query("cells_turned", f"{PLACES_SQL} SELECT id AS region_id, z, round(min(10 - ay / 1000.0), 4) AS min_x, round(max(10 - ay / 1000.0), 4) AS max_x, round(min(2 * (ax / 1000.0) - 5), 4) AS min_y, round(max(2 * (ax / 1000.0) - 5), 4) AS max_y FROM edge GROUP BY 1, 2")
def cells_turned(spark: SparkSession, d: str) -> DataFrame:
    """The boxes of all cells after a turn by a right angle, a stretch and a shift."""
    return ce.transformed(_parts(spark, d), "z", (0, -1, 10, 2, 0, -5))


@query(
    "cell_parts_inside",
    f"""{PLACES_SQL}, f AS (SELECT id, z, part, p[1][1] AS x, p[1][2] AS y FROM pts WHERE k = 1 AND len(p) > 2),
h AS (SELECT f.id, f.z, f.part AS a, e.part AS b FROM f JOIN edge e ON e.id = f.id AND e.z = f.z AND e.part <> f.part GROUP BY f.id, f.z, f.part, e.part, x, y
 HAVING count(*) FILTER (((ay > y) <> (qy > y)) AND ((qy > ay) = (((qx - ax) * (y - ay) - (qy - ay) * (x - ax)) > 0))) % 2 = 1
 AND count(*) FILTER (((qx - ax) * (y - ay) = (qy - ay) * (x - ax)) AND x BETWEEN least(ax, qx) AND greatest(ax, qx) AND y BETWEEN least(ay, qy) AND greatest(ay, qy)) = 0)
SELECT id AS region_id, z, CAST(count(*) AS BIGINT) AS n FROM h GROUP BY 1, 2""",
)
def cell_parts_inside(spark: SparkSession, d: str) -> DataFrame:
    """How many polygons of a cell lie inside another one of the same cell and plane."""
    return ce.interior_parts(_parts(spark, d), "z").groupBy("region_id", "z").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cell_equal_classes",
    r"""WITH t AS (SELECT DISTINCT id, z, trim(regexp_replace(regexp_replace(upper(regexp_replace(geometry, '^\s*SRID=\d+;', '', 'i')), '\s*([(),])\s*', '\1', 'g'), '\s+', ' ', 'g')) AS g FROM cells WHERE geometry IS NOT NULL AND trim(geometry) <> ''),
k AS (SELECT id, list_sort(list(z || '|' || g)) AS k FROM t GROUP BY 1) SELECT k.id, same_as FROM k JOIN (SELECT k, min(id) AS same_as FROM k GROUP BY 1) USING (k)""",
)
def cell_equal_classes(spark: SparkSession, d: str) -> DataFrame:
    return ce.equal_classes(cells(spark, d), "id", "geometry", "z")


@query(
    "cell_polygon_rows",
    f"{_AREAS} SELECT e.id, e.z, md5(e.part) AS part, CAST(count(*) AS INTEGER) AS edges, round(any_value(a.area), 4) AS area FROM edge e JOIN (SELECT id, z, part, sum(CASE WHEN k = 1 THEN a ELSE -a END) AS area FROM ring_area GROUP BY 1, 2, 3) a ON a.id = e.id AND a.z IS NOT DISTINCT FROM e.z AND a.part = e.part GROUP BY 1, 2, 3".replace("md5(e.part) AS part, ", "").replace("GROUP BY 1, 2, 3\"", "GROUP BY e.id, e.z, e.part\"").replace("e.part GROUP BY 1, 2, 3", "e.part GROUP BY e.id, e.z, e.part"),
)
def cell_polygon_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row for each polygon of a cell: edges and area."""
    return _parts(spark, d).select(F.col("region_id").alias("id"), "z", F.size("edges").alias("edges"), F.round("area", 4).alias("area"))


_MATCH = f"""WITH {MOLS_SQL}, l AS (SELECT cell_index AS id, round(avg(global_x), 3) AS x, round(avg(global_y), 3) AS y FROM mols WHERE cell_index > 0 AND global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL GROUP BY 1),
c AS (SELECT id, min(x) AS x, min(y) AS y FROM cells WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1),
m AS (SELECT l.id AS label, c.id AS cell, row_number() OVER (PARTITION BY l.id ORDER BY round((l.x - c.x) * (l.x - c.x) + (l.y - c.y) * (l.y - c.y), 6), c.id) AS k FROM l JOIN c ON (l.x - c.x) * (l.x - c.x) + (l.y - c.y) * (l.y - c.y) <= 400.0)"""


@query("mask_cell_matches", f"{_MATCH} SELECT l.id AS label, coalesce(cell, '-1') AS cell FROM l LEFT JOIN (SELECT * FROM m WHERE k = 1) m ON m.label = l.id")
def mask_cell_matches(spark: SparkSession, d: str) -> DataFrame:
    """For each mask label the cell whose middle is nearest to the label's within 20 micrometres, -1 where none is."""
    good = molecules(spark, d).filter("cell_index > 0 AND global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL")
    labels = good.groupBy("cell_index").agg(F.round(F.avg("global_x"), 3).alias("x"), F.round(F.avg("global_y"), 3).alias("y"))
    middles = table(spark, d, "cells").filter("x IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    near = sp.nearest(places(labels, "cell_index", "x", "y"), places(middles, "id", "x", "y"), 20.0)
    return labels.select(F.col("cell_index").alias("label")).join(near.select(F.col("id").alias("label"), F.col("other_id").alias("cell")), "label", "left").withColumn("cell", F.coalesce("cell", F.lit("-1")))


@query(
    "plane_label_chains",
    f"""{LABELS_SQL}, best AS (SELECT label, z, other FROM (SELECT *, row_number() OVER (PARTITION BY label, z ORDER BY round(f0 + f1, 9) DESC, other) AS k FROM f WHERE f0 > 0.2 AND f1 > 0.2) WHERE k = 1),
e AS (SELECT label || '@' || CAST(round(z / {PLANE_STEP}) AS BIGINT) AS a, other || '@' || CAST(round(z / {PLANE_STEP}) + 1 AS BIGINT) AS b FROM best), w AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
n AS (SELECT DISTINCT label, z, label || '@' || CAST(round(z / {PLANE_STEP}) AS BIGINT) AS node FROM px),
r(node, root) AS (SELECT node, node FROM n UNION SELECT w.b, r.root FROM r JOIN w ON w.a = r.node)
SELECT label, z, (SELECT min(root) FROM r WHERE r.node = n.node) AS chain FROM n""",
)
def plane_label_chains(spark: SparkSession, d: str) -> DataFrame:
    """Labels of a mask that follow each other through the planes get one name."""
    pixels = _label_pixels(spark, d)
    return ce.label_chains(pixels, mo.label_overlaps(pixels, PLANE_STEP, 0.2), PLANE_STEP)
