"""Queries: files and images of tiles, and what is written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import tiles as ti
from spotlake.plans import query
from spotlake.plans.pipeline import _CATALOG, _LAYOUT, _catalog, _planes
from spotlake.session import shared_checkpoints, table
from spotlake.sources import layout as lo
from spotlake.sources import sinks
from spotlake.sources.views import BITS, CODES_SQL, MOLS_SQL, PROBES_SQL, TRANSCRIPTS_SQL, codebook, molecules, probes, transcripts

_FILES = f"""{_CATALOG}, want AS (SELECT DISTINCT run_id, imagingRound AS imaging_round, lower(trim(imageType)) AS image_type FROM dataorganization WHERE run_id IS NOT NULL AND imagingRound IS NOT NULL AND imageType IS NOT NULL),
files AS (SELECT DISTINCT prefix AS run_id, fov, round AS imaging_round, image_type, path FROM cat JOIN want ON want.run_id = cat.prefix AND want.imaging_round = cat.round),
img AS (SELECT f.run_id, fov, dorg_row, lower(trim(channelName)) AS channel, trim(readoutName) AS readout, color, imaging_round AS round, path,
 CAST(row_number() OVER (PARTITION BY f.run_id, fov ORDER BY dorg_row, path) - 1 AS INTEGER) AS image_idx
 FROM (SELECT run_id, image_type, fov, imaging_round, min(path) AS path FROM files GROUP BY ALL) f JOIN dataorganization o ON o.run_id = f.run_id AND o.imagingRound = f.imaging_round AND lower(trim(o.imageType)) = f.image_type)"""
_IMG = "run_id, fov, image_idx, dorg_row, channel, readout, color, round, path"


def _files(spark: SparkSession, d: str) -> DataFrame:
    return ti.file_map(_catalog(spark, d), table(spark, d, "dataorganization"))


def _images(spark: SparkSession, d: str) -> DataFrame:
    return ti.tile_images(_files(spark, d), table(spark, d, "dataorganization"))


@query("file_map", f"{_FILES} SELECT run_id, fov, imaging_round, image_type, path FROM files")
def file_map(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d)


@query("file_map_complete_tiles", f"{_FILES} SELECT run_id, fov, imaging_round, image_type, path FROM files JOIN (SELECT run_id, max(fov) AS last FROM files GROUP BY 1) USING (run_id) WHERE fov < last")
def file_map_complete_tiles(spark: SparkSession, d: str) -> DataFrame:
    return ti.without_last_tile(_files(spark, d))


@query("file_paths", f"{_FILES} SELECT run_id, image_type, fov, imaging_round, min(path) AS path FROM files GROUP BY ALL")
def file_paths(spark: SparkSession, d: str) -> DataFrame:
    return ti.image_path(_files(spark, d))


@query("tile_images", f"{_FILES} SELECT {_IMG} FROM img")
def tile_images(spark: SparkSession, d: str) -> DataFrame:
    return _images(spark, d)


@query("tile_images_first_of_color", f"{_FILES}, w AS (SELECT DISTINCT min(image_idx) AS image_idx FROM img WHERE color IS NOT NULL GROUP BY run_id, fov, color) SELECT {_IMG} FROM img WHERE image_idx IN (SELECT image_idx FROM w)")
def tile_images_first_of_color(spark: SparkSession, d: str) -> DataFrame:
    """Images by number: the numbers at which a colour comes first in some tile."""
    images = _images(spark, d)
    return ti.subset(images, "image_idx", images.filter("color IS NOT NULL").groupBy("run_id", "fov", "color").agg(F.min("image_idx").alias("image_idx")))


@query("tile_images_of_shared_channels", f"{_FILES}, w AS (SELECT channel FROM img WHERE channel IS NOT NULL GROUP BY 1 HAVING count(DISTINCT round) > 1) SELECT {_IMG} FROM img WHERE channel IN (SELECT channel FROM w)")
def tile_images_of_shared_channels(spark: SparkSession, d: str) -> DataFrame:
    """Images by channel: the channels of more than one round."""
    images = _images(spark, d)
    return ti.subset(images, "channel", images.groupBy("channel").agg(F.count_distinct("round").alias("n")).filter("n > 1 AND channel IS NOT NULL"))


@query("tile_images_of_single_readouts", f"{_FILES}, w AS (SELECT readout FROM img WHERE readout IS NOT NULL GROUP BY 1 HAVING count(DISTINCT dorg_row) = 1) SELECT {_IMG} FROM img WHERE readout IN (SELECT readout FROM w)")
def tile_images_of_single_readouts(spark: SparkSession, d: str) -> DataFrame:
    """Images by readout: the readouts that only one row of the layout has."""
    images = _images(spark, d)
    return ti.subset(images, "readout", images.groupBy("readout").agg(F.count_distinct("dorg_row").alias("n")).filter("n = 1 AND readout IS NOT NULL"))


@query("tile_sizes", f"{_FILES} SELECT run_id, fov, CAST(count(*) AS BIGINT) AS images, CAST(count(DISTINCT channel) AS BIGINT) AS channels, CAST(count(DISTINCT round) AS BIGINT) AS rounds FROM img GROUP BY 1, 2")
def tile_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _images(spark, d).groupBy("run_id", "fov").agg(F.count(F.lit(1)).alias("images"), F.count_distinct("channel").alias("channels"), F.count_distinct("round").alias("rounds"))


_UNROLLED = f"""{_FILES}, f AS (SELECT run_id, fov, channel, row_number() OVER (PARTITION BY run_id, fov ORDER BY min(image_idx)) - 1 AS channel_no FROM img WHERE channel IS NOT NULL GROUP BY 1, 2, 3),
u AS (SELECT run_id, fov, channel_no, row_number() OVER (PARTITION BY run_id, fov, channel ORDER BY image_idx) - 1 AS plane_no, image_idx FROM img JOIN f USING (run_id, fov, channel))"""


@query("tile_unrolled", f"{_UNROLLED} SELECT run_id, fov, CAST(channel_no AS INTEGER) AS channel_no, CAST(plane_no AS INTEGER) AS plane_no, image_idx FROM u")
def tile_unrolled(spark: SparkSession, d: str) -> DataFrame:
    return ti.unrolled(_images(spark, d))


@query("tile_rolled", f"{_UNROLLED} SELECT run_id, fov, CAST(channel_no AS INTEGER) AS channel_no, CAST(plane_no AS INTEGER) AS plane_no, CAST(row_number() OVER (PARTITION BY run_id, fov ORDER BY channel_no, plane_no) - 1 AS INTEGER) AS image_idx FROM u")
def tile_rolled(spark: SparkSession, d: str) -> DataFrame:
    return ti.rolled(ti.unrolled(_images(spark, d)))


@query("tiles_concatenated", f"{_FILES} SELECT run_id, fov, image_idx, CAST(row_number() OVER (PARTITION BY run_id ORDER BY fov, image_idx) - 1 AS BIGINT) AS place FROM img")
def tiles_concatenated(spark: SparkSession, d: str) -> DataFrame:
    return ti.concatenated(_images(spark, d))


@query(
    "tile_fiducials",
    f"""{_CATALOG}, w AS (SELECT DISTINCT run_id, fiducialImagingRound AS r, lower(trim(fiducialImageType)) AS image_type, fiducialFrame AS frame, fiducialColor AS color FROM dataorganization)
SELECT w.run_id, fov, r AS round, image_type, frame, color, path FROM cat JOIN w ON w.run_id = cat.prefix AND w.r = cat.round""",
)
def tile_fiducials(spark: SparkSession, d: str) -> DataFrame:
    """The fiducial images of every tile with their file."""
    wanted = table(spark, d, "dataorganization").select("run_id", F.col("fiducialImagingRound").alias("round"), F.lower(F.trim("fiducialImageType")).alias("image_type"), F.col("fiducialFrame").alias("frame"), F.col("fiducialColor").alias("color")).distinct()
    return _catalog(spark, d).withColumnRenamed("prefix", "run_id").join(wanted, ["run_id", "round"]).select("run_id", "fov", "round", "image_type", "frame", "color", "path")


_LISTED = f"{_CATALOG}, listed AS (SELECT path FROM cat UNION ALL SELECT DISTINCT run_id || '_positions.csv' FROM molecules UNION ALL SELECT DISTINCT run_id || '_' || fov || '.dax' FROM molecules WHERE fov IS NOT NULL)"


def _listed(spark: SparkSession, d: str) -> DataFrame:
    mols = table(spark, d, "molecules")
    positions = mols.select(F.concat("run_id", F.lit("_positions.csv")).alias("path"))
    movies = mols.filter("fov IS NOT NULL").select(F.concat("run_id", F.lit("_"), F.col("fov").cast("string"), F.lit(".dax")).alias("path"))
    return _catalog(spark, d).select("path").unionByName(positions.unionByName(movies).distinct()).filter("path IS NOT NULL")


@query("files_of_even_tiles", f"{_LISTED} SELECT path FROM listed WHERE regexp_matches(path, '_[0-9]*[02468](_[0-9]+)?\\.(tif|dax)$')")
def files_of_even_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Files by extension and pattern."""
    return lo.filter_files(_listed(spark, d), "path", [".tif", ".dax"], r"_\d*[02468](_\d+)?\.")


@query("files_not_images", f"{_LISTED} SELECT path FROM listed WHERE path IS NOT NULL AND NOT regexp_matches(path, '\\.tiff?$')")
def files_not_images(spark: SparkSession, d: str) -> DataFrame:
    listed = _listed(spark, d)
    return listed.join(lo.filter_files(listed, "path", [".tif", ".tiff"]), "path", "left_anti")


@query("channel_turns", f"{_LAYOUT} SELECT dorg_row, plane, CAST(((frame % 5) + 5) % 5 AS INTEGER) AS channel, CAST(floor(frame / 5.0) AS INTEGER) AS turn FROM pl WHERE frame IS NOT NULL")
def channel_turns(spark: SparkSession, d: str) -> DataFrame:
    """The channel and turn of every frame when five channels take turns."""
    channel, turn = lo.channel_of_frame(F.col("frame"), 5)
    return _planes(spark, d).filter("frame IS NOT NULL").select("dorg_row", "plane", channel, turn.alias("turn"))


@query("channel_resolutions", "SELECT DISTINCT color, round(CAST(color AS DOUBLE) / (2 * 1.4), 6) AS lateral, round(2 * CAST(color AS DOUBLE) / (1.4 * 1.4), 6) AS axial FROM dataorganization WHERE TRY_CAST(color AS DOUBLE) IS NOT NULL")
def channel_resolutions(spark: SparkSession, d: str) -> DataFrame:
    """Theoretical resolution of every colour in nanometres at an aperture of 1.4."""
    wave = F.col("color").try_cast("double")
    return table(spark, d, "dataorganization").select("color").distinct().filter(wave.isNotNull()).select("color", F.round(wave / (2 * 1.4), 6).alias("lateral"), F.round(2 * wave / (1.4 * 1.4), 6).alias("axial"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints."""
    shared_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("stored_tiles", f"WITH {MOLS_SQL} SELECT molecule_id, fov, barcode_id FROM mols WHERE fov IS NOT NULL")
def stored_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Molecules written tile by tile, one tile written again, and all read."""
    path, good = _scratch(spark, "tiles"), molecules(spark, d).filter("fov IS NOT NULL").select("molecule_id", "fov", "barcode_id")
    sinks.write_tiles(good, path)
    again = good.join(good.agg(F.min("fov").alias("fov")), "fov", "left_semi")
    sinks.write_tiles(again, path)
    return spark.read.parquet(path).select("molecule_id", F.col("fov").cast("int").alias("fov"), "barcode_id")


@query("stored_codebook", f"WITH {CODES_SQL} SELECT CAST(row_number() OVER (ORDER BY barcode_id) - 1 AS INTEGER) AS barcode_id, name, id, array_to_string(bits, '') AS bits FROM codes")
def stored_codebook(spark: SparkSession, d: str) -> DataFrame:
    """The codebook written as a file and read again."""
    path = _scratch(spark, "codebook")
    sinks.write_codebook(codebook(spark, d), BITS, path)
    back = lo.read_codebook(spark, f"{path}/*.csv")
    return back.select("barcode_id", "name", F.regexp_replace("id", '^""$', "").alias("id"), F.array_join("bits", "").alias("bits"))


@query("stored_fasta", f"WITH {TRANSCRIPTS_SQL} SELECT DISTINCT transcript_id AS id, gene_id AS gene, md5(seq) AS digest FROM tx WHERE seq <> '' AND gene_id IS NOT NULL")
def stored_fasta(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts written as FASTA with cDNA headers, read and parsed again."""
    path = _scratch(spark, "fasta")
    named = transcripts(spark, d).filter("seq <> '' AND gene_id IS NOT NULL").select(F.concat("transcript_id", F.lit(" cdna chromosome:1 gene:"), "gene_id").alias("header"), "seq").distinct()
    sinks.write_fasta(named, "header", "seq", path)
    return lo.parse_cdna_header(lo.read_fasta(spark, path)).select("id", F.col("fields")["gene"].alias("gene"), F.md5("seq").alias("digest"))


@query("stored_probe_report", f"WITH {PROBES_SQL} SELECT probe_id, gene_id, seq, length(seq) AS letters FROM probe".replace("length(seq) AS letters", "CAST(length(seq) AS INTEGER) AS letters"))
def stored_probe_report(spark: SparkSession, d: str) -> DataFrame:
    """A probe report written as CSV and read again."""
    path = _scratch(spark, "report")
    sinks.write_probe_report(probes(spark, d).select("probe_id", "gene_id", "seq", F.length("seq").alias("letters")), path)
    return spark.read.csv(path, header=True, schema="probe_id bigint, gene_id string, seq string, letters int")


@query("stored_frame_infos", f"WITH {MOLS_SQL} SELECT run_id || '_' || fov || '.inf' AS path, 2048 AS width, 2048 AS height, CAST(count(DISTINCT z) AS INTEGER) AS frames, 'big' AS endian, floor(min(global_x)) AS stage_x, -floor(min(global_y)) AS stage_y FROM mols WHERE fov IS NOT NULL AND global_x IS NOT NULL AND NOT isnan(global_x) GROUP BY run_id, fov")
def stored_frame_infos(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions of frame files for every tile, as lines of text, parsed again."""
    good = molecules(spark, d).filter("fov IS NOT NULL AND global_x IS NOT NULL AND NOT isnan(global_x)").groupBy("run_id", "fov").agg(F.count_distinct("z").alias("n"), F.floor(F.min("global_x")).alias("x"), (-F.floor(F.min("global_y"))).alias("y"))
    lines = ["information file for", "data type = 16 bit integers (binary, big endian)", "frame dimensions = 2048 x 2048"]
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    made = F.array(*[F.lit(t) for t in lines], F.concat(F.lit("number of frames = "), F.col("n").cast("string")), F.concat(F.lit("Stage X = "), number("x")), F.concat(F.lit("Stage Y = "), number("y")))
    text = good.select(F.concat("run_id", F.lit("_"), F.col("fov").cast("string"), F.lit(".inf")).alias("path"), F.explode(made).alias("value"))
    return lo.parse_frame_info(text).select("path", "width", "height", "frames", "endian", "stage_x", "stage_y")


@query("stored_microscope", "SELECT CAST(max(fov) AS DOUBLE) AS mag, 1.4 AS na, true AS flip_horizontal, 1.5 AS z_step FROM molecules".replace("1.4 AS na", "CAST(1.4 AS DOUBLE) AS na").replace("1.5 AS z_step", "CAST(1.5 AS DOUBLE) AS z_step"))
def stored_microscope(spark: SparkSession, d: str) -> DataFrame:
    """A microscope's description with one field of its own, written as JSON and read with defaults."""
    path = _scratch(spark, "microscope")
    sinks.write_microscope(table(spark, d, "molecules").agg(F.max("fov").cast("double").alias("mag")), path)
    return lo.read_microscope(spark, f"{path}/*.json").select("mag", "na", "flip_horizontal", "z_step")


@query("covering_code_rows", f"WITH {CODES_SQL} SELECT barcode_id, array_to_string(bits, '') AS bits FROM codes")
def covering_code_rows(spark: SparkSession, d: str) -> DataFrame:
    """The codebook as rows of one-based on-bits, as covering tables list them, read again."""
    on = F.filter(F.transform("bits", lambda b, i: F.when(b == 1, i + 1)), lambda i: i.isNotNull())
    lines = codebook(spark, d).select("barcode_id", F.array_join(F.transform(on, lambda i: i.cast("string")), " ").alias("line"))
    return lo.covering_codes(lines, "line", 16, "barcode_id").select("barcode_id", F.array_join("bits", "").alias("bits"))
