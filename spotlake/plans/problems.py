"""Queries of the general data-processing problems (1, 2 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators.key_profile import heavy_keys, key_profile
from spotlake.operators.packed_lists import explode_lists
from spotlake.operators.proximity import containing_regions, near_pairs, places, region_parts
from spotlake.plans import query
from spotlake.session import table

#: The share of all rows from which a key counts as heavy.
HEAVY_SHARE = 0.04
#: The distance in micrometres within which molecules are near each other.
NEAR_RADIUS = 0.4

_PROFILE_SQL = """
SELECT field, key_value, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(number) AS BIGINT) AS n_values,
       round(sum(number), 3) AS total, CAST(count(DISTINCT barcode_id) AS BIGINT) AS n_distinct
FROM (SELECT 'fov' AS field, CAST(fov AS BIGINT) AS key_value, barcode_id, CASE WHEN NOT isnan(magnitude) THEN magnitude END AS number FROM molecules
      UNION ALL
      SELECT 'cell_index', cell_index, barcode_id, CASE WHEN NOT isnan(magnitude) THEN magnitude END FROM molecules)
GROUP BY field, key_value
"""


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return key_profile(table(spark, d, "molecules"), ["fov", "cell_index"], "barcode_id", "magnitude")


@query("p1_keys", _PROFILE_SQL)
def p1_keys(spark: SparkSession, d: str) -> DataFrame:
    return _profile(spark, d).withColumn("total", F.round("total", 3))


@query(
    "p1_found",
    """
WITH k AS (SELECT 'fov' AS field, CAST(fov AS BIGINT) AS key_value FROM molecules
           UNION ALL SELECT 'cell_index', cell_index FROM molecules)
SELECT field, key_value FROM k WHERE key_value IS NOT NULL
GROUP BY field, key_value HAVING count(*) * 25 >= (SELECT count(*) FROM molecules)
""",
)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys(_profile(spark, d), HEAVY_SHARE).select("field", "key_value")


_LISTS_SQL = r"""
WITH raw AS (SELECT dorg_row, 'frame' AS field, frame AS t FROM dataorganization UNION ALL SELECT dorg_row, 'zPos', zPos FROM dataorganization),
a AS (SELECT dorg_row, field, regexp_replace(t, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') AS t FROM raw WHERE t IS NOT NULL),
b AS (SELECT dorg_row, field, CASE WHEN regexp_full_match(t, '(?s)"([^"]|"")*"') AND length(t) > 1 THEN replace(t[2:-2], '""', '"') WHEN regexp_full_match(t, '(?s)''([^'']|'''')*''') AND length(t) > 1 THEN replace(t[2:-2], '''''', '''') ELSE t END AS t FROM a),
c AS (SELECT dorg_row, field, regexp_replace(regexp_replace(t, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '^[A-Za-z_][A-Za-z0-9_.]*\s*\(', '(') AS t FROM b),
e AS (SELECT dorg_row, field, regexp_replace(c.t, '(?s)^[\[({](.*)[\])}]$', '\1') AS t FROM c),
f AS (SELECT dorg_row, field, regexp_replace(regexp_replace(t, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '(?s)^[\[({](.*)[\])}]$', '\1') AS t FROM e),
g AS (SELECT dorg_row, field, regexp_extract_all(regexp_replace(t, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'), '"[^"]*"|''[^'']*''|[\s\x{a0}]*[,;|/][\s\x{a0}]*|[\s\x{a0}]+|[^,;|/\s\x{a0}"'']+') AS k FROM f),
h AS (SELECT DISTINCT dorg_row, field, k, unnest(range(1, len(k) + 1)) AS i FROM g),
s AS (SELECT dorg_row, field, k[i] AS tok, len(list_filter(k[1:i], lambda x: regexp_full_match(x, '[\s\x{a0}]*[,;|/][\s\x{a0}]*|[\s\x{a0}]+'))) AS pos FROM h)
SELECT DISTINCT dorg_row, field, CAST(pos AS INTEGER) AS pos, CASE WHEN tok[1] IN ('"', '''') THEN tok[2:-2] ELSE tok END AS item FROM s
WHERE NOT regexp_full_match(tok, '[\s\x{a0}]*[,;|/][\s\x{a0}]*|[\s\x{a0}]+') AND tok NOT IN ('""', '''''')
"""


@query("p2_found", _LISTS_SQL)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return explode_lists(table(spark, d, "dataorganization"), "dorg_row", ["frame", "zPos"]).distinct()


#: Molecules, near pairs, and polygons with their edges, up to which molecule lies on which side.
PLACES_SQL = r"""
WITH pt AS (SELECT DISTINCT molecule_id AS id, CAST(round(global_x * 1000) AS BIGINT) AS x, CAST(round(global_y * 1000) AS BIGINT) AS y, z FROM molecules WHERE global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL AND NOT isnan(global_y)),
c AS (SELECT DISTINCT id, x, y, CAST(floor(x / 400.0) AS BIGINT) AS cx, CAST(floor(y / 400.0) AS BIGINT) AS cy FROM pt),
w1 AS (SELECT id, x, y, cx + unnest([-1, 0, 1]) AS cx, cy FROM c), w AS (SELECT id, x, y, cx, cy + unnest([-1, 0, 1]) AS cy FROM w1),
near AS (SELECT DISTINCT w.id AS a, c.id AS b FROM w JOIN c USING (cx, cy) WHERE w.id < c.id AND (w.x - c.x) * (w.x - c.x) + (w.y - c.y) * (w.y - c.y) <= 160000),
part AS (SELECT id, z, unnest(regexp_extract_all(geometry, '\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)')) AS part FROM (SELECT DISTINCT id, z, geometry FROM cells WHERE geometry IS NOT NULL)),
ring AS (SELECT id, z, part, unnest(range(1, len(r) + 1)) AS k, unnest(r) AS ring FROM (SELECT id, z, part, regexp_extract_all(part, '\(([^()]*)\)', 1) AS r FROM part)),
pts AS (SELECT id, z, part, k, list_transform(string_split(trim(ring), ','), lambda p: list_transform(regexp_split_to_array(trim(p), '\s+'), lambda v: CAST(round(CAST(v AS DOUBLE) * 1000) AS BIGINT))) AS p FROM ring),
edge AS (SELECT id, z, part, k, p[i][1] AS ax, p[i][2] AS ay, p[i % len(p) + 1][1] AS qx, p[i % len(p) + 1][2] AS qy FROM (SELECT id, z, part, k, p, unnest(range(1, len(p) + 1)) AS i FROM pts WHERE len(p) > 2)),
box AS (SELECT id, z, part, min(ax) AS x0, max(ax) AS x1, min(ay) AS y0, max(ay) AS y1 FROM edge GROUP BY 1, 2, 3),
cand AS (SELECT b.id, b.z, b.part, pt.id AS m, pt.x, pt.y FROM box b JOIN pt ON pt.z = b.z AND pt.x BETWEEN x0 AND x1 AND pt.y BETWEEN y0 AND y1),
side AS (SELECT m, id, part, count(*) FILTER (((ay > y) <> (qy > y)) AND ((qy > ay) = (((qx - ax) * (y - ay) - (qy - ay) * (x - ax)) > 0))) AS crossings,
  count(*) FILTER (((qx - ax) * (y - ay) = (qy - ay) * (x - ax)) AND x BETWEEN least(ax, qx) AND greatest(ax, qx) AND y BETWEEN least(ay, qy) AND greatest(ay, qy)) AS on_edge
  FROM cand JOIN edge USING (id, z, part) GROUP BY m, id, part, x, y, z)
"""
_FOUND_SQL = f"""{PLACES_SQL} SELECT 'near' AS relation, a AS molecule_id, CAST(b AS VARCHAR) AS other_id FROM near
UNION ALL SELECT DISTINCT 'inside', m, id FROM side WHERE on_edge = 0 AND crossings % 2 = 1"""


@query("p4_found", _FOUND_SQL)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    points = places(table(spark, d, "molecules"), "molecule_id", "global_x", "global_y", "z")
    regions = region_parts(table(spark, d, "cells"), "id", "geometry", "z")
    near = near_pairs(points, NEAR_RADIUS).select(F.lit("near").alias("relation"), F.col("id").alias("molecule_id"), F.col("other_id").cast("string"))
    inside = containing_regions(points, regions, "z").select(F.lit("inside").alias("relation"), F.col("id").alias("molecule_id"), F.col("region_id").alias("other_id"))
    return near.unionByName(inside)
