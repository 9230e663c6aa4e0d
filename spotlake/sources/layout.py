"""Channel layouts, image catalogs, and text formats read into tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spotlake.operators.packed_lists import explode_lists

#: Name of an image file: prefix, tile, round and extension.
IMAGE_NAME = r"^([^.]*)_(\d+)_(\d+)(\..*)?$"
#: The fields of a microscope and their defaults.
MICROSCOPE = {
    "flip_horizontal": True, "flip_vertical": False, "transpose": True, "microns_per_pixel": 0.108,
    "image_dimensions": [2048, 2048], "mag": 60.0, "tubelens": 200.0, "na": 1.4, "ni": 1.515, "wd": 150.0, "z_step": 1.5,
}


def channel_planes(df: DataFrame, id_column: str = "dorg_row", frame: str = "frame", z: str = "zPos") -> DataFrame:
    """id, plane (slot), frame, z: the frames of each channel with the z of the same slot, from lists packed as text.

    A slot that only one of the lists has comes out with null for the other. Items that aren't numbers are null.
    """
    items = explode_lists(df, id_column, [frame, z]).withColumn("number", F.expr("try_cast(replace(trim(item), ',', '.') as double)"))
    pick = lambda f: F.max(F.when(F.col("field") == f, F.col("number")))
    return items.groupBy(id_column, F.col("pos").alias("plane")).agg(pick(frame).cast("int").alias("frame"), pick(z).alias("z"))


def frame_at(planes: DataFrame, id_column: str, z: float) -> DataFrame:
    """The frame of each channel at exactly *z* (the first slot of several)."""
    return planes.filter((F.col("z") == z) & F.col("frame").isNotNull()).groupBy(id_column).agg(F.min_by("frame", "plane").alias("frame"))


def z_positions(planes: DataFrame) -> DataFrame:
    """The distinct z of all channels."""
    return planes.filter("z IS NOT NULL AND NOT isnan(z)").select("z").distinct()


def list_text(c: Column) -> Column:
    """An array as '[a b c]'."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), " "), F.lit("]"))


def three_color_layout(df: DataFrame, id_column: str) -> DataFrame:
    """bit (the id), color (560, 650, 750 in turn) and round (three bits each)."""
    bit = F.col(id_column)
    return df.select(bit.alias("bit"), F.element_at(F.array(F.lit("560"), F.lit("650"), F.lit("750")), (bit % 3).cast("int") + 1).alias("color"), F.floor(bit / 3).cast("int").alias("round"))


def parse_image_names(df: DataFrame, path: str) -> DataFrame:
    """prefix, fov, round and path of image files whose name fits IMAGE_NAME; others are left out."""
    name = F.element_at(F.split(path, "/"), -1)
    part = lambda k: F.regexp_extract(name, IMAGE_NAME, k)
    return df.filter(name.rlike(IMAGE_NAME)).select(part(1).alias("prefix"), part(2).cast("int").alias("fov"), part(3).cast("int").alias("round"), F.col(path).alias("path"))


def incomplete_prefixes(catalog: DataFrame) -> DataFrame:
    """prefix and what is wrong: tiles or rounds that don't run through without a gap, or a tile without some round."""
    gap = lambda c: F.count_distinct(c) != F.max(c) - F.min(c) + 1
    per = catalog.groupBy("prefix").agg(gap("fov").alias("fov_gap"), gap("round").alias("round_gap"), (F.count_distinct("fov", "round") != F.count_distinct("fov") * F.count_distinct("round")).alias("pair_missing"))
    return per.filter("fov_gap OR round_gap OR pair_missing")


def rounds_of_tiles(catalog: DataFrame) -> DataFrame:
    """prefix, fov and the sorted rounds of each tile (bounded by the rounds of an experiment)."""
    return catalog.groupBy("prefix", "fov").agg(F.sort_array(F.collect_set("round")).alias("rounds"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """header, seq of FASTA files, one record a row; records are split by Spark's text source, so large files are read in parallel."""
    raw = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    cut = F.locate("\n", "value")
    return raw.select(F.rtrim(F.expr("substring(value, 1, if(locate('\n', value) > 0, locate('\n', value) - 1, length(value)))")).alias("header"), F.when(cut > 0, F.regexp_replace(F.expr("substring(value, locate('\n', value) + 1)"), r"\s+", "")).otherwise("").alias("seq"))


def parse_cdna_header(df: DataFrame, header: str = "header") -> DataFrame:
    """id, seq_type and the key:value fields of cDNA headers as a map; other columns stay."""
    parts = F.split(header, r"\s+")
    pairs = F.filter(F.slice(parts, 3, F.size(parts)), lambda p: p.contains(":"))
    fields = F.map_from_entries(F.array_distinct(F.transform(pairs, lambda p: F.struct(F.split(p, ":", 2)[0], F.split(p, ":", 2)[1]))))
    return df.withColumn("id", parts[0]).withColumn("seq_type", F.try_element_at(parts, F.lit(2))).withColumn("fields", fields)


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """barcode_id (row from 0), name, id, bits of a codebook file with a header line; files are small by nature and their line order counts."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "text")).filter("trim(text) != ''")
    fields = F.transform(F.split("text", ","), lambda x: F.trim(x))
    return lines.filter("line > 0").select((F.col("line") - 1).alias("barcode_id"), fields[0].alias("name"), fields[1].alias("id"), F.transform(F.slice(fields, 3, F.size(fields)), lambda b: b.cast("int")).alias("bits"))


def bits_of_text(c: Column) -> Column:
    """'0110' as an array of numbers."""
    return F.transform(F.filter(F.split(c, ""), lambda b: b != ""), lambda b: b.cast("int"))


def read_microscope(spark: SparkSession, path: str) -> DataFrame:
    """The microscope's fields from JSON, defaults for those that are missing."""
    kinds = {bool: T.BooleanType(), float: T.DoubleType(), list: T.ArrayType(T.IntegerType())}
    schema = T.StructType([T.StructField(k, kinds[type(v)]) for k, v in MICROSCOPE.items()])
    return spark.read.schema(schema).json(path, multiLine=True).select(*[F.coalesce(F.col(k), F.lit(v)).alias(k) for k, v in MICROSCOPE.items()])


def filter_files(df: DataFrame, path: str, extensions: list[str], pattern: str | None = None) -> DataFrame:
    """Rows whose path ends with one of the extensions, in any case, and holds the pattern."""
    name = F.lower(F.col(path))
    ends = F.lit(False)
    for e in extensions:
        ends |= F.endswith(name, F.lit(e.lower()))
    return df.filter(ends if pattern is None else ends & F.col(path).rlike(pattern))


def covering_codes(df: DataFrame, text: str, bits: int, *keep: str) -> DataFrame:
    """bits (array) and the kept columns of rows of one-based on-bits separated by white space; lines with marks of a web page or without numbers are left out."""
    on = F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.cast("int"))
    rows = df.filter(~F.contains(text, F.lit("<")) & F.col(text).rlike(r"^\s*\d+(\s+\d+)*\s*$"))
    return rows.select(*keep, F.transform(F.sequence(F.lit(1), F.lit(bits)), lambda i: F.array_contains(on, i).cast("int")).alias("bits"))


def parse_frame_info(lines: DataFrame, path: str = "path", text: str = "value") -> DataFrame:
    """path, width, height (256 where they aren't given), frames, endian, stage_x, stage_y, lock_target, scale_max and scale_min of the `key = value` lines that describe a frame file; the others are null where a line is missing."""
    number = lambda p: F.max(F.when(F.regexp_extract(text, p, 1) != "", F.regexp_extract(text, p, 1)))
    return lines.groupBy(path).agg(
        F.coalesce(number(r"frame dimensions\s*=\s*(\d+)\s*x").cast("int"), F.lit(256)).alias("width"),
        F.coalesce(number(r"frame dimensions\s*=\s*\d+\s*x\s*(\d+)").cast("int"), F.lit(256)).alias("height"),
        number(r"number of frames\s*=\s*(\d+)").cast("int").alias("frames"),
        number(r"[ (](big|little) endian").alias("endian"),
        *[number(rf"^{key} = (-?\d+(?:\.\d+)?)").cast("double").alias(name) for key, name in (("Stage X", "stage_x"), ("Stage Y", "stage_y"), ("Lock Target", "lock_target"), ("scalemax", "scale_max"), ("scalemin", "scale_min"))],
    )


def channel_of_frame(c: Column, channels: int) -> tuple[Column, Column]:
    """(channel, z) of a frame number when channels take turns."""
    return F.pmod(c, F.lit(channels)).alias("channel"), F.floor(c / channels).cast("int").alias("z")
