"""Domain views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.session import table

BITS = [f"bit{i}" for i in range(1, 17)]
#: barcode_id of a molecule that wasn't decoded.
UNDECODED = 65535

MOLECULE_COLUMNS = ["molecule_id", "run_id", "fov", "barcode_id", "x", "y", "z", "global_x", "global_y", "magnitude", "distance", "area", "cell_index", "decoded_at"]


def molecules(spark: SparkSession, d: str) -> DataFrame:
    """Each molecule once (rows sent again differ in loaded_at only), decoded ones only."""
    return table(spark, d, "molecules").select(*MOLECULE_COLUMNS).filter(F.col("barcode_id") != UNDECODED).distinct()


def codebook(spark: SparkSession, d: str) -> DataFrame:
    """barcode_id, name, id, bits (array), code (packed, the first bit lowest), is_blank."""
    bits = F.array(*[F.col(b) for b in BITS])
    code = F.aggregate(F.reverse(bits), F.lit(0).cast("bigint"), lambda a, b: a * 2 + b)
    return table(spark, d, "codebook").select("barcode_id", "name", "id", bits.alias("bits"), code.alias("code"), F.lower("name").contains("blank").alias("is_blank"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Rows of cells without repeats: id, fov, x, y, z, geometry."""
    return table(spark, d, "cells").select("id", "fov", "x", "y", "z", "geometry").distinct()


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Each transcript once, its sequence in capital DNA letters without white space."""
    letters = F.translate(F.upper(F.regexp_replace("sequence", r"\s+", "")), "U", "T")
    fpkm = F.when(F.isnan("FPKM") | (F.col("FPKM") < 0), None).otherwise(F.col("FPKM"))
    return table(spark, d, "transcriptome").select("transcript_id", "gene_id", "gene_short_name", letters.alias("seq"), fpkm.alias("fpkm")).distinct()


def probes(spark: SparkSession, d: str) -> DataFrame:
    """Probes with a target of plain letters, in capitals."""
    seq = F.upper("target_sequence")
    return table(spark, d, "probe_dict").select("probe_id", "gene_id", "transcript_id", seq.alias("seq"), "shift", "barcode").filter(F.col("seq").rlike("^[ACGT]+$"))


#: The same views as common table expressions.
MOLS_SQL = f"mols AS (SELECT DISTINCT {', '.join(MOLECULE_COLUMNS)} FROM molecules WHERE barcode_id <> {UNDECODED})"
CODES_SQL = f"""codes AS (SELECT barcode_id, name, id, [{', '.join(BITS)}] AS bits,
 CAST({' + '.join(f'{b} * {1 << i}' for i, b in enumerate(BITS))} AS BIGINT) AS code, contains(lower(name), 'blank') AS is_blank FROM codebook)"""
CELLS_SQL = "cell AS (SELECT DISTINCT id, fov, x, y, z, geometry FROM cells)"
TRANSCRIPTS_SQL = r"""tx AS (SELECT DISTINCT transcript_id, gene_id, gene_short_name, replace(upper(regexp_replace(sequence, '\s+', '', 'g')), 'U', 'T') AS seq,
 CASE WHEN isnan(FPKM) OR FPKM < 0 THEN NULL ELSE FPKM END AS fpkm FROM transcriptome)"""
PROBES_SQL = "probe AS (SELECT probe_id, gene_id, transcript_id, upper(target_sequence) AS seq, shift, barcode FROM probe_dict WHERE regexp_full_match(upper(target_sequence), '[ACGT]+'))"
