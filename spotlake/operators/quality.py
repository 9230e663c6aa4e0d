"""Quality of decoded molecules, judged by the codes that are not in use (blanks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_code(molecules: DataFrame, codebook: DataFrame, *columns: str) -> DataFrame:
    """Molecules with columns of their code. The codebook has one row a code and is fixed by the chemistry, so it is broadcast."""
    return molecules.join(codebook.select("barcode_id", *columns), "barcode_id")


def crop(molecules: DataFrame, width: int, height: int, margin: float) -> DataFrame:
    """Molecules strictly inside a tile without *margin* (a share of its size) on every side; null positions are outside."""
    mx, my = int(margin * width), int(margin * height)
    return molecules.filter((F.col("x") > mx) & (F.col("x") < width - mx) & (F.col("y") > my) & (F.col("y") < height - my))


def filter_molecules(molecules: DataFrame, codebook: DataFrame, min_area: int, coding_only: bool = True, min_score: float | None = None, score: str = "magnitude") -> DataFrame:
    """Molecules of at least *min_area*, optionally of a least score and of coding barcodes only."""
    out = molecules.filter(F.col("area") >= min_area)
    if min_score is not None:
        out = out.filter((F.col(score) >= min_score) & ~F.isnan(score))
    if coding_only:
        out = out.join(codebook.filter(~F.col("is_blank")).select("barcode_id"), "barcode_id", "left_semi")
    return out


def code_sizes(codebook: DataFrame) -> DataFrame:
    """One row: n_codes, n_blank, n_coding."""
    blank = F.count_if("is_blank")
    return codebook.agg(F.count(F.lit(1)).alias("n_codes"), blank.alias("n_blank"), (F.count(F.lit(1)) - blank).alias("n_coding"))


def _fdr(blank: Column, total: Column) -> Column:
    return F.try_divide(blank / F.col("n_blank"), (total + 1) / F.col("n_codes"))


def blank_fdr(molecules: DataFrame, codebook: DataFrame, by: str) -> DataFrame:
    """Share of blanks per blank code, over molecules (and one) per code, for each value of *by*."""
    counted = with_code(molecules, codebook, "is_blank").groupBy(by).agg(F.count(F.lit(1)).alias("n_total"), F.count_if("is_blank").alias("n_blank_found"))
    sized = counted.join(F.broadcast(code_sizes(codebook)))
    return sized.select(by, "n_total", "n_blank_found", _fdr(F.col("n_blank_found"), F.col("n_total")).alias("fdr"))


def score_fdr_table(molecules: DataFrame, codebook: DataFrame, score: Column, top: float = 10.0, steps: int = 100) -> DataFrame:
    """False discovery rate among molecules with a score of at least s, for *steps* evenly spaced s from 0 to *top*.

    Molecules are counted by step first, so the running sums from above go over *steps* rows, however many molecules there are.
    """
    width = top / (steps - 1)
    step = F.least(F.floor(score / width).cast("int"), F.lit(steps - 1))
    counted = with_code(molecules.select("barcode_id", step.alias("step")), codebook, "is_blank").filter("step >= 0").groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_blank").alias("b"))
    grid = molecules.sparkSession.range(steps).select(F.col("id").cast("int").alias("step"))
    above = Window.orderBy(F.desc("step"))
    run = grid.join(counted, "step", "left").select("step", F.sum(F.coalesce("n", F.lit(0))).over(above).alias("n_total"), F.sum(F.coalesce("b", F.lit(0))).over(above).alias("n_blank_found"))
    return run.join(F.broadcast(code_sizes(codebook))).select("step", (F.col("step") * width).alias("score"), "n_total", "n_blank_found", _fdr(F.col("n_blank_found"), F.col("n_total")).alias("fdr"))


def bins(log_step: float = 0.25, distance_step: float = 0.05, area_top: int = 35) -> dict[str, Column]:
    """Bin numbers of molecules: intensity on a log scale, distance, and area."""
    return {
        "b_int": F.floor(F.log10("magnitude") / log_step).cast("int"),
        "b_dist": F.floor(F.col("distance") / distance_step).cast("int"),
        "b_area": F.when((F.col("area") >= 1) & (F.col("area") < area_top), F.col("area")),
    }


def histogram(molecules: DataFrame, codebook: DataFrame, axes: dict[str, Column]) -> DataFrame:
    """Sparse histogram over *axes* of coding and of blank molecules; values out of range, null and NaN don't count."""
    good = molecules.filter((F.col("magnitude") > 0) & ~F.isnan("magnitude") & ~F.isnan("distance"))
    binned = with_code(good.select("barcode_id", *[c.alias(n) for n, c in axes.items()]), codebook, "is_blank").dropna(subset=list(axes))
    return binned.groupBy(*axes).agg((F.count(F.lit(1)) - F.count_if("is_blank")).alias("coding"), F.count_if("is_blank").alias("blank"))


#: The fraction of a bin that only blanks are in.
NO_CODING = 1.7976931348623157e308


def blank_fractions(hist: DataFrame, codebook: DataFrame) -> DataFrame:
    """hist with ``fraction``: blanks over coding molecules, relative to the share of blank codes; NO_CODING without coding ones."""
    fraction = F.try_divide(F.col("blank") / F.col("n_blank"), F.col("coding") / F.col("n_coding"))
    return hist.join(F.broadcast(code_sizes(codebook))).withColumn("fraction", F.when(F.col("coding") == 0, F.lit(NO_CODING)).otherwise(fraction)).drop("n_codes")


def misidentification(fractions: DataFrame, thresholds: list[float]) -> DataFrame:
    """For each threshold, over bins under it: coding and blank molecules, and the rate of blanks per code over coding ones per code."""
    under = fractions.select("*", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    kept = under.filter(F.col("fraction") < F.col("threshold"))
    return kept.groupBy("threshold").agg(F.sum("coding").alias("n_coding_kept"), F.sum("blank").alias("n_blank_kept"), F.try_divide(F.sum("blank") / F.first("n_blank"), F.sum("coding") / F.first("n_coding")).alias("rate"))


def best_threshold(fractions: DataFrame, target: float) -> DataFrame:
    """One row: the largest fraction up to which the misidentification rate stays within *target*, found exactly by running sums.

    The window goes over the distinct fractions of the bins, a number that the bin layout bounds.
    """
    summed = fractions.groupBy("fraction").agg(F.sum("blank").alias("b"), F.sum("coding").alias("c"), F.first("n_blank").alias("n_blank"), F.first("n_coding").alias("n_coding"))
    up = Window.orderBy("fraction")
    run = summed.select("fraction", F.try_divide(F.sum("b").over(up) / F.col("n_blank"), F.sum("c").over(up) / F.col("n_coding")).alias("rate"))
    return run.filter(F.col("rate") <= target).agg(F.max("fraction").alias("threshold"))


def keep_good_bins(molecules: DataFrame, fractions: DataFrame, axes: dict[str, Column], threshold: float) -> DataFrame:
    """Molecules whose bin has a blank fraction under *threshold*. The bins are bounded by their layout."""
    good = fractions.filter(F.col("fraction") < threshold).select(*axes)
    made = molecules.filter((F.col("magnitude") > 0) & ~F.isnan("magnitude") & ~F.isnan("distance")).select("*", *[c.alias(n) for n, c in axes.items()])
    return made.join(good, list(axes), "left_semi").drop(*axes)
