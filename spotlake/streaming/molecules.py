"""Molecules that arrive as files: counted by time window, decoded once each, and written without doubling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def molecule_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 8) -> DataFrame:
    """New files of a folder, or of all folders and files that fit a pattern, as a stream; the number of files bounds a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timed(df: DataFrame, time: str, late: str) -> DataFrame:
    """*df* with a watermark on *time*; event times must have a zone, so those without one are taken in the session's."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def once_each(stream: DataFrame, id_column: str, time: str, late: str | None = None) -> DataFrame:
    """Each id once. State is kept as long as rows may be *late*, and later rows are dropped; without *late* all ids are kept and no row is dropped."""
    return timed(stream, time, late).dropDuplicatesWithinWatermark([id_column]) if late else stream.dropDuplicates([id_column])


def window_counts(df: DataFrame, time: str, by: str, window: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """by, window_start, n, total: counts and summed magnitude in (sliding) windows; the same for tables and streams."""
    rows = timed(df, time, late) if late else df
    span = F.window(time, window, slide) if slide else F.window(time, window)
    good = F.when(~F.isnan("magnitude"), F.col("magnitude"))
    return rows.groupBy(span.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(good).alias("total")).select(by, F.col("w.start").alias("window_start"), "n", "total")


def sessions(df: DataFrame, time: str, by: str, gap: str, late: str | None = None) -> DataFrame:
    """by, session_start, session_end, n: runs of rows no more than *gap* apart."""
    rows = timed(df, time, late) if late else df
    return rows.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def write_batches(stream: DataFrame, path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]):
    """Process every micro-batch and write it to a folder of its number: a batch that is run again replaces its own rows."""

    def batch(df: DataFrame, number: int) -> None:
        process(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
