"""Results written for other tools, and written again without doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.functions.sequences import wrap


def write_fasta(df: DataFrame, name: str, sequence: str, path: str) -> None:
    """FASTA files, sequences wrapped at 80 letters."""
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrap(F.col(sequence))).alias("value")).write.mode("overwrite").text(path)


def write_tiles(molecules: DataFrame, path: str) -> None:
    """Molecules without sentinels, a folder for each tile; only the tiles that are written are replaced."""
    good = molecules.filter((F.col("barcode_id") != 65535) & (F.col("barcode_id") != -1))
    good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fov").parquet(path)


def write_codebook(codebook: DataFrame, bits: list[str], path: str) -> None:
    """A codebook file with a header line, rows in the order of barcode_id; small by nature, so one file."""
    rows = codebook.orderBy("barcode_id").select("name", "id", *[F.col("bits")[i].alias(b) for i, b in enumerate(bits)])
    rows.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_microscope(fields: DataFrame, path: str) -> None:
    """One row of fields as a JSON file."""
    fields.coalesce(1).write.mode("overwrite").json(path)


def write_probe_report(report: DataFrame, path: str) -> None:
    """A CSV report sorted by probe and region, commas in text as semicolons."""
    text = [F.regexp_replace(c, ",", ";").alias(c) if t == "string" else F.col(c) for c, t in report.dtypes]
    report.select(*text).write.mode("overwrite").csv(path, header=True)


def not_done(tiles: DataFrame, done: DataFrame, keys: list[str], rerun: bool = False) -> DataFrame:
    """The tiles that have no result yet, or all of them to run again."""
    return tiles if rerun else tiles.join(done.select(*keys).distinct(), keys, "left_anti")
