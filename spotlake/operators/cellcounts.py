"""Counts of molecules in cells, and statistics of the cell by gene matrix in long form (zeros are not stored)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_per_cell(molecules: DataFrame, cell: str, gene: str) -> DataFrame:
    """n for each cell and gene; molecules without cell (null or -1) or gene don't count. Combined on the map side, so a large cell is no skew."""
    return molecules.filter((F.col(cell) != -1) & F.col(gene).isNotNull()).groupBy(F.col(cell).alias("cell"), F.col(gene).alias("gene")).agg(F.count(F.lit(1)).alias("n"))


def molecules_of_counts(counts: DataFrame) -> DataFrame:
    """One row for each counted molecule: cell, gene, ordinal from 0."""
    return counts.filter("n > 0").select("cell", "gene", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("ordinal"))


def cell_totals(counts: DataFrame) -> DataFrame:
    """cell, total, n_genes (with a count)."""
    return counts.groupBy("cell").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_genes"))


def normalize_counts(counts: DataFrame) -> DataFrame:
    """counts with the share of its cell's total."""
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("cell")))


def zscore_counts(counts: DataFrame, n_genes: int) -> DataFrame:
    """z-score of each stored count within its cell, over *n_genes* genes, zeros included (population deviation).

    Zeros enter algebraically (mean = sum/n, mean square likewise), so the dense matrix is never built.
    """
    w = Window.partitionBy("cell")
    mean = F.sum("n").over(w) / n_genes
    var = F.sum(F.col("n") * F.col("n")).over(w) / n_genes - mean * mean
    return counts.withColumn("z", F.try_divide(F.col("n") - mean, F.sqrt(F.greatest(var, F.lit(0.0)))))


def wide_counts(counts: DataFrame, genes: list) -> DataFrame:
    """One row for each cell, one column for each of the given genes, zeros filled in."""
    return counts.groupBy("cell").pivot("gene", genes).agg(F.sum("n")).na.fill(0)


def filter_cells_genes(counts: DataFrame, min_total: int, max_total: int, min_cells: int) -> DataFrame:
    """Counts of cells with a total in [min_total, max_total], then of genes in at least *min_cells* of them."""
    total = F.sum("n").over(Window.partitionBy("cell"))
    kept = counts.withColumn("total", total).filter(F.col("total").between(min_total, max_total))
    enough = kept.groupBy("gene").agg(F.count_distinct("cell").alias("cells")).filter(F.col("cells") >= min_cells)
    return kept.join(enough.select("gene"), "gene", "left_semi")


def log_normalize(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """log1p of counts scaled to *scale* a cell."""
    return counts.withColumn("value", F.log1p(F.col("n") * scale / F.sum("n").over(Window.partitionBy("cell"))))


def gene_zscores(values: DataFrame, cells: DataFrame, clip: float = 10.0) -> DataFrame:
    """z-score of each stored value over all cells of its gene, zeros included (sample deviation), clipped above.

    cells: one row with the number of cells, ``k``. The two sums of a gene are combined on the map side and joined
    back, so a gene found in all cells isn't gathered.
    """
    sums = values.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q")).join(F.broadcast(cells))
    mean = F.col("s") / F.col("k")
    deviation = F.sqrt(F.greatest((F.col("q") - F.col("s") * mean) / (F.col("k") - 1), F.lit(0.0)))
    return values.join(sums, "gene").withColumn("z", F.least(F.lit(clip), F.try_divide(F.col("value") - mean, deviation))).drop("s", "q", "k")


def group_means(counts: DataFrame, groups: DataFrame, min_cells: int) -> DataFrame:
    """Mean count of each gene over all cells of a group with more than *min_cells* cells, zeros included.

    groups: cell, grp; a null grp and -1 belong to no group.
    """
    named = groups.filter(F.col("grp").isNotNull() & (F.col("grp") != -1))
    sizes = named.groupBy("grp").agg(F.count(F.lit(1)).alias("cells")).filter(F.col("cells") > min_cells)
    sums = counts.join(named, "cell").groupBy("grp", "gene").agg(F.sum("n").alias("total"))
    return sums.join(sizes, "grp").select("grp", "gene", "cells", (F.col("total") / F.col("cells")).alias("mean"))


def by_controls(df: DataFrame, keys: list[str], value: str, is_control: Column, center_only: bool = False) -> DataFrame:
    """*value* minus the controls' mean of its keys, over their population deviation; null without spread among the controls."""
    control = df.filter(is_control).groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    centered = F.col(value) - F.col("_m")
    return df.join(control, keys).withColumn("z", centered if center_only else F.try_divide(centered, F.col("_s"))).drop("_m", "_s")


def cell_info(molecules: DataFrame) -> DataFrame:
    """Per cell and plane: area (molecules), centroid and bounding box."""
    return molecules.filter("cell_index != -1").groupBy(F.col("cell_index").alias("cell"), "z").agg(
        F.count(F.lit(1)).alias("area"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )


def largest_plane(info: DataFrame) -> DataFrame:
    """The plane of largest area of each cell, the lowest of ties."""
    return info.groupBy("cell").agg(F.max_by(F.struct("z", "area"), F.struct("area", -F.col("z"))).alias("m")).select("cell", "m.z", "m.area")


def dense_labels(df: DataFrame, label: str) -> DataFrame:
    """Labels as whole numbers from 0, in the order of their text. The window goes over the distinct labels only."""
    ranked = df.select(label).distinct().withColumn("label_id", (F.dense_rank().over(Window.orderBy(F.col(label).cast("string"))) - 1).cast("int"))
    return df.join(ranked, label)
