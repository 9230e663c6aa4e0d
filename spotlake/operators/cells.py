"""Cells as polygons: exchange, comparison and clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.operators.graphs import components
from spotlake.operators.proximity import AREA_EXPR, PART_PATTERN, RINGS_EXPR, UNITS, containing_regions

_JSON = "type string, coordinates array<array<array<double>>>"
_FROM_JSON = f"transform(polygon.coordinates, r -> transform(r, p -> named_struct('x', cast(round(p[0] * {UNITS}) as bigint), 'y', cast(round(p[1] * {UNITS}) as bigint))))"


def to_geojson(df: DataFrame, id_column: str, wkt: str, plane: str) -> DataFrame:
    """id, plane, geojson: one GeoJSON polygon for each polygon of a well-known text, its rings closed. Unreadable geometries and rings of fewer than three points give none."""
    part = df.filter(F.col(wkt).isNotNull()).select(F.col(id_column).alias("id"), plane, F.explode(F.regexp_extract_all(F.col(wkt), F.lit(PART_PATTERN), F.lit(0))).alias("part")).distinct()
    rings = part.select("id", plane, F.expr(f"filter({RINGS_EXPR}, r -> size(r) > 2)").alias("rings")).filter("size(rings) > 0 AND NOT exists(rings, r -> exists(r, p -> p.x IS NULL OR p.y IS NULL))")
    plain = F.transform("rings", lambda r: F.transform(F.when(r[0] == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1))), lambda p: F.array(p["x"] / float(UNITS), p["y"] / float(UNITS))))
    return rings.select("id", plane, F.to_json(F.struct(F.lit("Polygon").alias("type"), plain.alias("coordinates"))).alias("geojson"))


def from_geojson(df: DataFrame, id_column: str, plane: str, geojson: str = "geojson") -> DataFrame:
    """id, plane, corners (the rings' points but for the closing ones) and area of GeoJSON polygons; what isn't one is left out."""
    read = df.select(F.col(id_column).alias("id"), plane, F.from_json(geojson, _JSON).alias("polygon")).filter("polygon.type = 'Polygon' AND size(polygon.coordinates) > 0")
    rings = read.select("id", plane, F.expr(_FROM_JSON).alias("rings"))
    corners = F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r) - 1)
    return rings.select("id", plane, corners.alias("corners"), F.expr(AREA_EXPR).alias("area"))


def transformed(parts: DataFrame, plane: str, matrix: tuple[float, float, float, float, float, float]) -> DataFrame:
    """region_id, plane and the box, in micrometres, of polygons (of region_parts()) after x' = a x + b y + c, y' = d x + e y + f."""
    a, b, c, d, e, f = matrix
    point = F.explode(F.transform("edges", lambda s: F.struct((a * s["ax"] + b * s["ay"] + c * UNITS).alias("x"), (d * s["ax"] + e * s["ay"] + f * UNITS).alias("y")))).alias("p")
    scaled = lambda g, k: F.round(g(f"p.{k}") / UNITS, 4).alias(f"{g.__name__}_{k}")
    return parts.select("region_id", plane, point).groupBy("region_id", plane).agg(*[scaled(g, k) for k in "xy" for g in (F.min, F.max)])


def interior_parts(parts: DataFrame, plane: str) -> DataFrame:
    """region_id, plane, inside, around: polygons of a region whose first corner lies strictly inside another polygon of it on the same plane, both named by their hash."""
    named = parts.withColumn("_part", F.xxhash64(F.to_json("edges"))).withColumn("_at", F.concat_ws("@", F.col("region_id").cast("string"), F.col(plane).cast("string")))
    corners = named.select(F.col("_part").alias("id"), F.col("edges")[0]["ax"].alias("px"), F.col("edges")[0]["ay"].alias("py"), "_at")
    held = containing_regions(corners, named.withColumn("region_id", F.col("_part")), "_at").filter("id != region_id").select(F.col("id").alias("inside"), F.col("region_id").alias("around"))
    return named.select("region_id", plane, F.col("_part").alias("inside"), "_at").join(held, "inside").join(named.select(F.col("_part").alias("around"), "_at"), ["around", "_at"]).select("region_id", plane, "inside", "around").distinct()


def equal_classes(df: DataFrame, id_column: str, wkt: str, plane: str) -> DataFrame:
    """id, same_as: the least id whose polygons, written evenly, are the same on every plane. Cells without geometry are left out.

    A cell is named by the sum and number of its polygons' hashes, which are combined on the map side.
    """
    text = F.regexp_replace(F.regexp_replace(F.upper(F.regexp_replace(wkt, r"(?i)^\s*SRID=\d+;", "")), r"\s*([(),])\s*", "$1"), r"\s+", " ")
    each = df.filter(F.col(wkt).isNotNull() & (F.trim(wkt) != "")).select(F.col(id_column).alias("id"), F.xxhash64(plane, F.trim(text)).alias("h")).distinct()
    named = each.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))
    return named.join(named.groupBy("n", "s").agg(F.min("id").alias("same_as")), ["n", "s"]).select("id", "same_as")


def label_chains(labels: DataFrame, links: DataFrame, step: float) -> DataFrame:
    """label, z, chain: labels of planes that follow each other through z by *links* (label, z, other in the plane above) are one chain, named by its least 'label@plane'."""
    name = lambda label, z: F.concat_ws("@", F.col(label).cast("string"), F.round(z / step).cast("bigint").cast("string"))
    edges = links.select(name("label", F.col("z")).alias("a"), name("other", F.col("z") + step).alias("b"))
    nodes = labels.select("label", "z").distinct().withColumn("node", name("label", F.col("z")))
    return nodes.join(components(edges), "node", "left").select("label", "z", F.coalesce("component", "node").alias("chain"))
