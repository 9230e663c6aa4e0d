"""Queries: layouts, catalogs, image planes and time windows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators.proximity import region_parts
from spotlake.operators.spatial import region_measures
from spotlake.plans import query
from spotlake.plans.problems import _LISTS_SQL
from spotlake.plans.spatial import _AREAS
from spotlake.session import shared_checkpoints, table
from spotlake.sources import layout as lo
from spotlake.sources.views import MOLS_SQL, codebook, molecules
from spotlake.streaming.molecules import molecule_stream, once_each, sessions, window_counts, write_batches



#: Frames and z of the layout's channels by slot, from the lists that problem 2 states.
_LAYOUT = f"""WITH items AS ({_LISTS_SQL}), num AS (SELECT dorg_row, field, pos, TRY_CAST(replace(trim(item), ',', '.') AS DOUBLE) AS number FROM items),
pl AS (SELECT dorg_row, pos AS plane, CAST(trunc(max(number) FILTER (field = 'frame')) AS INTEGER) AS frame, max(number) FILTER (field = 'zPos') AS z FROM num GROUP BY 1, 2)"""


def _planes(spark: SparkSession, d: str) -> DataFrame:
    return lo.channel_planes(table(spark, d, "dataorganization"))


@query("layout_planes", f"{_LAYOUT} SELECT dorg_row, plane, frame, z FROM pl")
def layout_planes(spark: SparkSession, d: str) -> DataFrame:
    return _planes(spark, d)


@query("layout_frame_at_3", f"{_LAYOUT} SELECT dorg_row, arg_min(frame, plane) AS frame FROM pl WHERE z = 3.0 AND frame IS NOT NULL GROUP BY 1")
def layout_frame_at_3(spark: SparkSession, d: str) -> DataFrame:
    return lo.frame_at(_planes(spark, d), "dorg_row", 3.0)


@query("layout_z_positions", f"{_LAYOUT} SELECT DISTINCT z FROM pl WHERE z IS NOT NULL AND NOT isnan(z)")
def layout_z_positions(spark: SparkSession, d: str) -> DataFrame:
    return lo.z_positions(_planes(spark, d))


@query("layout_fiducials", "SELECT fiducialImageType, fiducialImagingRound, min(dorg_row) AS dorg_row, CAST(count(*) AS BIGINT) AS channels FROM dataorganization GROUP BY 1, 2")
def layout_fiducials(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dataorganization").groupBy("fiducialImageType", "fiducialImagingRound").agg(F.min("dorg_row").alias("dorg_row"), F.count(F.lit(1)).alias("channels"))


@query("layout_channel_index", "SELECT lower(trim(channelName)) AS channel, min(dorg_row) AS dorg_row, CAST(count(DISTINCT imagingRound) AS BIGINT) AS rounds FROM dataorganization WHERE channelName IS NOT NULL GROUP BY 1")
def layout_channel_index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dataorganization").filter("channelName IS NOT NULL").groupBy(F.lower(F.trim("channelName")).alias("channel")).agg(F.min("dorg_row").alias("dorg_row"), F.count_distinct("imagingRound").alias("rounds"))


@query("layout_three_colors", "SELECT barcode_id AS bit, CASE barcode_id % 3 WHEN 0 THEN '560' WHEN 1 THEN '650' ELSE '750' END AS color, CAST(barcode_id // 3 AS INTEGER) AS round FROM codebook")
def layout_three_colors(spark: SparkSession, d: str) -> DataFrame:
    return lo.three_color_layout(codebook(spark, d), "barcode_id")


_NAMES = "names AS (SELECT DISTINCT run_id || '_' || fov || '_' || CAST(z * 2 AS INTEGER) || '.tif' AS path FROM molecules WHERE fov IS NOT NULL)"


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    """The image files that the molecules come from, by name."""
    name = F.concat("run_id", F.lit("_"), F.col("fov").cast("string"), F.lit("_"), (F.col("z") * 2).cast("int").cast("string"), F.lit(".tif"))
    return lo.parse_image_names(table(spark, d, "molecules").filter("fov IS NOT NULL").select(name.alias("path")).distinct(), "path")


_CATALOG = f"WITH {_NAMES}, cat AS (SELECT regexp_extract(path, '^([^.]*)_([0-9]+)_([0-9]+)', 1) AS prefix, CAST(regexp_extract(path, '^([^.]*)_([0-9]+)_([0-9]+)', 2) AS INTEGER) AS fov, CAST(regexp_extract(path, '^([^.]*)_([0-9]+)_([0-9]+)', 3) AS INTEGER) AS round, path FROM names)"


@query("catalog_files", f"{_CATALOG} SELECT prefix, fov, round, path FROM cat")
def catalog_files(spark: SparkSession, d: str) -> DataFrame:
    return _catalog(spark, d)


@query("catalog_incomplete", f"{_CATALOG} SELECT prefix, fov_gap, round_gap, pair_missing FROM (SELECT prefix, count(DISTINCT fov) <> max(fov) - min(fov) + 1 AS fov_gap, count(DISTINCT round) <> max(round) - min(round) + 1 AS round_gap, count(DISTINCT fov * 1000 + round) <> count(DISTINCT fov) * count(DISTINCT round) AS pair_missing FROM cat GROUP BY prefix) WHERE fov_gap OR round_gap OR pair_missing")
def catalog_incomplete(spark: SparkSession, d: str) -> DataFrame:
    return lo.incomplete_prefixes(_catalog(spark, d))


@query("catalog_rounds", f"{_CATALOG} SELECT prefix, fov, list(DISTINCT round ORDER BY round) AS rounds FROM cat GROUP BY 1, 2".replace("list(DISTINCT round ORDER BY round)", "array_to_string(list_sort(list(DISTINCT round)), ' ')"))
def catalog_rounds(spark: SparkSession, d: str) -> DataFrame:
    return lo.rounds_of_tiles(_catalog(spark, d)).withColumn("rounds", F.array_join("rounds", " "))


_GOODM = f"WITH {MOLS_SQL}"


@query("hourly_counts", f"{_GOODM} SELECT fov, date_trunc('hour', decoded_at) AS window_start, CAST(count(*) AS BIGINT) AS n, round(sum(CASE WHEN NOT isnan(magnitude) THEN magnitude END), 3) AS total FROM mols GROUP BY 1, 2")
def hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by tile and hour; the stream version adds a watermark."""
    return window_counts(molecules(spark, d), "decoded_at", "fov", "1 hour").withColumn("total", F.round("total", 3))


@query("session_counts", "WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, k")
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    return sessions(table(spark, d, "events"), "ts", "user_id", "1 hour")


_STREAMED = """WITH m AS (SELECT DISTINCT molecule_id, fov, decoded_at FROM molecules WHERE fov IS NOT NULL)
SELECT fov, date_trunc('hour', decoded_at) AS window_start, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY 1, 2"""


@query("stream_hourly_counts", _STREAMED)
def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """The table read as a stream of files, each molecule kept once, written batch by batch to the shared folder, then counted by hour.

    The table is finite, so all its ids are remembered and no row is too late.
    """
    shared_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    rows = table(spark, d, "molecules")
    stream = once_each(molecule_stream(spark, f"{d}/molecules.parque[t]", rows.schema), "molecule_id", "decoded_at")  # a pattern, so one file will do as well as a folder
    write_batches(stream, f"{folder}/out", f"{folder}/state", lambda df: df.select("molecule_id", "fov", "decoded_at", "magnitude")).awaitTermination()
    kept = spark.read.parquet(f"{folder}/out").filter("fov IS NOT NULL").withColumn("decoded_at", F.col("decoded_at").cast("timestamp_ntz"))
    return window_counts(kept, "decoded_at", "fov", "1 hour").drop("total")


@query("cell_metadata", f"{_AREAS} SELECT m.region_id AS id, round(avg(m.area), 4) AS area, CAST(count(*) AS BIGINT) AS planes, f.z, f.fov, f.x, f.y FROM measure m JOIN (SELECT id, min(struct_pack(z := z, fov := fov, x := x, y := y)) AS s FROM cells GROUP BY 1) c ON c.id = m.region_id CROSS JOIN LATERAL (SELECT s.z AS z, s.fov AS fov, s.x AS x, s.y AS y) f GROUP BY ALL")
def cell_metadata(spark: SparkSession, d: str) -> DataFrame:
    """One row for each cell: mean area over its planes, planes, and its tile, place and lowest plane."""
    measures = region_measures(region_parts(table(spark, d, "cells"), "id", "geometry", "z")).groupBy(F.col("region_id").alias("id")).agg(F.round(F.avg("area"), 4).alias("area"), F.count(F.lit(1)).alias("planes"))
    first = table(spark, d, "cells").groupBy("id").agg(F.min(F.struct("z", "fov", "x", "y")).alias("f")).select("id", "f.*")
    return measures.join(first, "id")
