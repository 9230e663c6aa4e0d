"""Images of tiles as rows: which file holds which channel, and parts, order and unions of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.ranking import row_numbers


def file_map(catalog: DataFrame, layout: DataFrame) -> DataFrame:
    """run_id, fov, imaging_round, image_type, path: the files of a catalog that some row of the layout asks for, each once for each type."""
    wanted = layout.select("run_id", F.col("imagingRound").alias("imaging_round"), F.lower(F.trim("imageType")).alias("image_type")).dropna().distinct()
    files = catalog.select(F.col("prefix").alias("run_id"), "fov", F.col("round").alias("imaging_round"), "path")
    return files.join(wanted, ["run_id", "imaging_round"]).select("run_id", "fov", "imaging_round", "image_type", "path").distinct()


def without_last_tile(files: DataFrame) -> DataFrame:
    """Files of all tiles but the last one of their run, which may still be written."""
    last = files.groupBy("run_id").agg(F.max("fov").alias("_last"))
    return files.join(last, "run_id").filter(F.col("fov") < F.col("_last")).drop("_last")


def image_path(files: DataFrame) -> DataFrame:
    """The file of each type, tile and round (the first by name of several)."""
    return files.groupBy("run_id", "image_type", "fov", "imaging_round").agg(F.min("path").alias("path"))


def tile_images(files: DataFrame, layout: DataFrame) -> DataFrame:
    """The images of every tile: run_id, fov, image_idx (from 0, by layout row and file), dorg_row, channel, readout, color, round, path.

    The number of an image runs over its own tile, which the layout bounds.
    """
    rows = layout.select("dorg_row", "run_id", F.lower(F.trim("channelName")).alias("channel"), F.trim("readoutName").alias("readout"), "color", F.col("imagingRound").alias("imaging_round"), F.lower(F.trim("imageType")).alias("image_type"))
    made = image_path(files).join(rows, ["run_id", "imaging_round", "image_type"])
    order = Window.partitionBy("run_id", "fov").orderBy("dorg_row", "path")
    return made.select("run_id", "fov", (F.row_number().over(order) - 1).alias("image_idx"), "dorg_row", "channel", "readout", "color", F.col("imaging_round").alias("round"), "path")


def subset(images: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The images whose *column* is one of the values in *wanted* (a column of that name)."""
    return images.join(wanted.select(column).distinct(), column, "left_semi").select(images.columns)


def unrolled(images: DataFrame) -> DataFrame:
    """run_id, fov, channel_no, plane_no, image_idx: channels numbered as they first appear in a tile, images of a channel in their order."""
    first = images.filter("channel IS NOT NULL").groupBy("run_id", "fov", "channel").agg(F.min("image_idx").alias("_first"))
    number = (F.row_number().over(Window.partitionBy("run_id", "fov").orderBy("_first")) - 1).alias("channel_no")
    plane = (F.row_number().over(Window.partitionBy("run_id", "fov", "channel").orderBy("image_idx")) - 1).alias("plane_no")
    named = first.select("run_id", "fov", "channel", number)
    return images.filter("channel IS NOT NULL").select("run_id", "fov", "channel", "image_idx", plane).join(named, ["run_id", "fov", "channel"]).select("run_id", "fov", "channel_no", "plane_no", "image_idx")


def rolled(parts: DataFrame) -> DataFrame:
    """The inverse of unrolled() up to gaps: images numbered along channels, then planes."""
    order = Window.partitionBy("run_id", "fov").orderBy("channel_no", "plane_no")
    return parts.select("run_id", "fov", "channel_no", "plane_no", (F.row_number().over(order) - 1).alias("image_idx"))


def concatenated(images: DataFrame) -> DataFrame:
    """The images of all tiles of a run in one row of numbers, tile after tile; the numbers are distributed running sums."""
    return row_numbers(images.select("run_id", "fov", "image_idx"), ["run_id"], ["fov", "image_idx"], "place")
