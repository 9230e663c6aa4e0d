"""Queries: codebook, molecule quality and filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import quality as q
from spotlake.plans import query
from spotlake.sources.views import CODES_SQL, MOLS_SQL, codebook, molecules

#: Fixed values of the imaging set-up: pixels of a tile, micrometres of a pixel.
WIDTH, PIXEL = 2048, 0.108
THRESHOLDS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.0]

_BOTH = f"WITH {MOLS_SQL}, {CODES_SQL}"
_SIZES = "sizes AS (SELECT count(*) AS n_codes, count(*) FILTER (is_blank) AS n_blank, count(*) FILTER (NOT is_blank) AS n_coding FROM codes)"
_BINS = {
    "b_int": "TRY_CAST(floor(log10(magnitude) / 0.25) AS INTEGER)",
    "b_dist": "TRY_CAST(floor(distance / 0.05) AS INTEGER)",
    "b_area": "CASE WHEN area >= 1 AND area < 35 THEN area END",
}


def _hist_sql(*axes: str) -> str:
    cols = ", ".join(f"{_BINS[a]} AS {a}" for a in axes)
    names = ", ".join(axes)
    return f"""{_BOTH}, {_SIZES}, binned AS (SELECT {cols}, is_blank FROM mols JOIN codes USING (barcode_id) WHERE magnitude > 0 AND NOT isnan(magnitude) AND NOT isnan(distance)),
hist AS (SELECT {names}, count(*) FILTER (NOT is_blank) AS coding, count(*) FILTER (is_blank) AS blank FROM binned WHERE {' AND '.join(f'{a} IS NOT NULL' for a in axes)} GROUP BY {names}),
frac AS (SELECT hist.*, n_blank, n_coding, CASE WHEN coding = 0 THEN 1.7976931348623157e308 ELSE (blank / n_blank) / (coding / n_coding) END AS fraction FROM hist, sizes)"""


@query("codebook_view", f"WITH {CODES_SQL} SELECT barcode_id, name, id, code, is_blank, array_to_string(bits, '') AS bit_text FROM codes")
def codebook_view(spark: SparkSession, d: str) -> DataFrame:
    return codebook(spark, d).select("barcode_id", "name", "id", "code", "is_blank", F.array_join("bits", "").alias("bit_text"))


@query("codebook_indexes", f"WITH {CODES_SQL} SELECT is_blank, array_to_string(list(barcode_id ORDER BY barcode_id), ',') AS members, CAST(count(*) AS BIGINT) AS n FROM codes GROUP BY is_blank")
def codebook_indexes(spark: SparkSession, d: str) -> DataFrame:
    return codebook(spark, d).groupBy("is_blank").agg(F.array_join(F.sort_array(F.collect_list("barcode_id")), ",").alias("members"), F.count(F.lit(1)).alias("n"))


@query("codebook_index_for_name", f"WITH {CODES_SQL} SELECT name, min(barcode_id) AS barcode_id FROM codes GROUP BY name")
def codebook_index_for_name(spark: SparkSession, d: str) -> DataFrame:
    return codebook(spark, d).groupBy("name").agg(F.min("barcode_id").alias("barcode_id"))


@query("codebook_bit_columns", f"WITH {CODES_SQL} SELECT barcode_id, unnest(range(1, 17)) AS bit, unnest(bits) AS value FROM codes".replace("unnest(range(1, 17)) AS bit", "CAST(unnest(range(1, 17)) AS INTEGER) AS bit"))
def codebook_bit_columns(spark: SparkSession, d: str) -> DataFrame:
    return codebook(spark, d).select("barcode_id", F.posexplode("bits").alias("bit", "value")).withColumn("bit", F.col("bit") + 1)


@query("mol_gene_symbols", f"{_BOTH} SELECT name AS gene, CAST(count(*) AS BIGINT) AS n FROM mols JOIN codes USING (barcode_id) GROUP BY name")
def mol_gene_symbols(spark: SparkSession, d: str) -> DataFrame:
    return q.with_code(molecules(spark, d), codebook(spark, d), "name").groupBy(F.col("name").alias("gene")).agg(F.count(F.lit(1)).alias("n"))


@query("mol_crop", f"WITH {MOLS_SQL} SELECT molecule_id, x, y FROM mols WHERE x > 102 AND x < 1946 AND y > 102 AND y < 1946")
def mol_crop(spark: SparkSession, d: str) -> DataFrame:
    return q.crop(molecules(spark, d), WIDTH, WIDTH, 0.05).select("molecule_id", "x", "y")


@query("mol_filter", f"{_BOTH} SELECT molecule_id, barcode_id, area FROM mols WHERE area >= 8 AND magnitude >= 20 AND NOT isnan(magnitude) AND barcode_id IN (SELECT barcode_id FROM codes WHERE NOT is_blank)")
def mol_filter(spark: SparkSession, d: str) -> DataFrame:
    return q.filter_molecules(molecules(spark, d), codebook(spark, d), 8, True, 20.0).select("molecule_id", "barcode_id", "area")


@query(
    "qc_fov_fdr",
    f"""{_BOTH}, {_SIZES}, t AS (SELECT fov, count(*) AS n_total, count(*) FILTER (is_blank) AS b FROM mols JOIN codes USING (barcode_id) GROUP BY fov)
SELECT fov, CAST(n_total AS BIGINT) AS n_total, CAST(b AS BIGINT) AS n_blank_found, round((b / n_blank) / ((n_total + 1) / n_codes), 9) AS fdr FROM t, sizes""",
)
def qc_fov_fdr(spark: SparkSession, d: str) -> DataFrame:
    return q.blank_fdr(molecules(spark, d), codebook(spark, d), "fov").withColumn("fdr", F.round("fdr", 9))


@query(
    "qc_score_fdr_table",
    f"""{_BOTH}, {_SIZES}, s AS (SELECT least(CAST(floor(log10(magnitude) * 2 / (10.0 / 99)) AS INTEGER), 99) AS step, is_blank FROM mols JOIN codes USING (barcode_id) WHERE magnitude > 0 AND NOT isnan(magnitude)),
c AS (SELECT step, count(*) AS n, count(*) FILTER (is_blank) AS b FROM s WHERE step >= 0 GROUP BY step),
r AS (SELECT g.step, coalesce(sum(n) OVER (ORDER BY g.step DESC), 0) AS nt, coalesce(sum(b) OVER (ORDER BY g.step DESC), 0) AS nb FROM (SELECT CAST(range AS INTEGER) AS step FROM range(100)) g LEFT JOIN c USING (step))
SELECT step, round(step * (10.0 / 99), 9) AS score, CAST(nt AS BIGINT) AS n_total, CAST(nb AS BIGINT) AS n_blank_found, round((nb / n_blank) / ((nt + 1) / n_codes), 9) AS fdr FROM r, sizes""",
)
def qc_score_fdr_table(spark: SparkSession, d: str) -> DataFrame:
    mols = molecules(spark, d).filter((F.col("magnitude") > 0) & ~F.isnan("magnitude"))
    return q.score_fdr_table(mols, codebook(spark, d), F.log10("magnitude") * 2).withColumn("fdr", F.round("fdr", 9)).withColumn("score", F.round("score", 9))


@query(
    "qc_score_threshold",
    f"""{_BOTH}, {_SIZES}, s AS (SELECT least(CAST(floor(log10(magnitude) * 2 / (10.0 / 99)) AS INTEGER), 99) AS step, is_blank FROM mols JOIN codes USING (barcode_id) WHERE magnitude > 0 AND NOT isnan(magnitude)),
c AS (SELECT step, count(*) AS n, count(*) FILTER (is_blank) AS b FROM s WHERE step >= 0 GROUP BY step),
r AS (SELECT g.step, coalesce(sum(n) OVER (ORDER BY g.step DESC), 0) AS nt, coalesce(sum(b) OVER (ORDER BY g.step DESC), 0) AS nb FROM (SELECT CAST(range AS INTEGER) AS step FROM range(100)) g LEFT JOIN c USING (step))
SELECT round(min(step * (10.0 / 99)), 9) AS threshold FROM r, sizes WHERE (nb / n_blank) / ((nt + 1) / n_codes) < 0.3""",
)
def qc_score_threshold(spark: SparkSession, d: str) -> DataFrame:
    mols = molecules(spark, d).filter((F.col("magnitude") > 0) & ~F.isnan("magnitude"))
    found = q.score_fdr_table(mols, codebook(spark, d), F.log10("magnitude") * 2)
    return found.filter("fdr < 0.3").agg(F.round(F.min("score"), 9).alias("threshold"))


_HIST_OUT = "SELECT {a}, CAST(coding AS BIGINT) AS coding, CAST(blank AS BIGINT) AS blank FROM hist"


@query("qc_histogram_3d", _hist_sql("b_int", "b_dist", "b_area") + _HIST_OUT.format(a="b_int, b_dist, b_area"))
def qc_histogram_3d(spark: SparkSession, d: str) -> DataFrame:
    return q.histogram(molecules(spark, d), codebook(spark, d), q.bins())


def _flat() -> dict:
    return {k: v for k, v in q.bins().items() if k != "b_area"}


@query("qc_histogram_2d", _hist_sql("b_int", "b_dist") + _HIST_OUT.format(a="b_int, b_dist"))
def qc_histogram_2d(spark: SparkSession, d: str) -> DataFrame:
    return q.histogram(molecules(spark, d), codebook(spark, d), _flat())


def _fractions(spark: SparkSession, d: str, axes: dict) -> DataFrame:
    return q.blank_fractions(q.histogram(molecules(spark, d), codebook(spark, d), axes), codebook(spark, d))


@query("qc_blank_fractions", _hist_sql("b_int", "b_dist", "b_area") + " SELECT b_int, b_dist, b_area, CASE WHEN coding = 0 THEN fraction ELSE round(fraction, 9) END AS fraction FROM frac")
def qc_blank_fractions(spark: SparkSession, d: str) -> DataFrame:
    return _fractions(spark, d, q.bins()).select("b_int", "b_dist", "b_area", F.when(F.col("coding") == 0, F.col("fraction")).otherwise(F.round("fraction", 9)).alias("fraction"))


@query(
    "qc_misidentification",
    _hist_sql("b_int", "b_dist", "b_area")
    + """ SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(sum(coding) AS BIGINT) AS n_coding_kept, CAST(sum(blank) AS BIGINT) AS n_blank_kept,
round((sum(blank) / max(n_blank)) / (sum(coding) / max(n_coding)), 9) AS rate FROM frac, (SELECT unnest([0.05, 0.1, 0.25, 0.5, 1.0, 2.0]) AS threshold) WHERE fraction < threshold GROUP BY threshold""",
)
def qc_misidentification(spark: SparkSession, d: str) -> DataFrame:
    return q.misidentification(_fractions(spark, d, q.bins()), THRESHOLDS).withColumn("rate", F.round("rate", 9))


_BEST = """, u AS (SELECT round(fraction, 12) AS fraction, sum(blank) AS b, sum(coding) AS c, max(n_blank) AS nb, max(n_coding) AS nc FROM frac GROUP BY 1),
run AS (SELECT fraction, (sum(b) OVER (ORDER BY fraction) / nb) / nullif(sum(c) OVER (ORDER BY fraction) / nc, 0) AS rate FROM u)"""


@query("qc_best_threshold", _hist_sql("b_int", "b_dist", "b_area") + _BEST + " SELECT round(max(fraction), 9) AS threshold FROM run WHERE rate <= 0.2")
def qc_best_threshold(spark: SparkSession, d: str) -> DataFrame:
    rounded = _fractions(spark, d, q.bins()).withColumn("fraction", F.round("fraction", 12))
    return q.best_threshold(rounded, 0.2).select(F.round("threshold", 9).alias("threshold"))


def _kept_sql(*axes: str) -> str:
    same = " AND ".join(f"{_BINS[a]} = g.{a}" for a in axes)
    return _hist_sql(*axes) + f" SELECT molecule_id, barcode_id FROM mols WHERE magnitude > 0 AND NOT isnan(magnitude) AND NOT isnan(distance) AND EXISTS (SELECT 1 FROM frac g WHERE fraction < 0.5 AND {same})"


@query("qc_dynamic_filter", _kept_sql("b_int", "b_dist", "b_area"))
def qc_dynamic_filter(spark: SparkSession, d: str) -> DataFrame:
    return q.keep_good_bins(molecules(spark, d), _fractions(spark, d, q.bins()), q.bins(), 0.5).select("molecule_id", "barcode_id")


@query("qc_dynamic_filter_spots", _kept_sql("b_int", "b_dist"))
def qc_dynamic_filter_spots(spark: SparkSession, d: str) -> DataFrame:
    return q.keep_good_bins(molecules(spark, d), _fractions(spark, d, _flat()), _flat(), 0.5).select("molecule_id", "barcode_id")
