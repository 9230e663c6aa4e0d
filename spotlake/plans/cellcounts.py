"""Queries: cell by gene counts and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import cellcounts as c
from spotlake.plans import query
from spotlake.session import table
from spotlake.sources.views import MOLS_SQL, molecules

_COUNTS = f"WITH {MOLS_SQL}, counts AS (SELECT cell_index AS cell, barcode_id AS gene, count(*) AS n FROM mols WHERE cell_index <> -1 GROUP BY 1, 2)"
_GENES = 140


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return c.count_per_cell(molecules(spark, d), "cell_index", "barcode_id")


@query("cell_counts", f"{_COUNTS} SELECT cell, gene, CAST(n AS BIGINT) AS n FROM counts")
def cell_counts(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d)


@query("cell_counts_exploded", f"{_COUNTS} SELECT cell, gene, CAST(unnest(range(n)) AS BIGINT) AS ordinal FROM counts")
def cell_counts_exploded(spark: SparkSession, d: str) -> DataFrame:
    return c.molecules_of_counts(_counts(spark, d))


@query("cell_totals", f"{_COUNTS} SELECT cell, CAST(sum(n) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS n_genes FROM counts GROUP BY cell")
def cell_totals(spark: SparkSession, d: str) -> DataFrame:
    return c.cell_totals(_counts(spark, d))


@query("cell_shares", f"{_COUNTS} SELECT cell, gene, round(n / sum(n) OVER (PARTITION BY cell), 9) AS share FROM counts")
def cell_shares(spark: SparkSession, d: str) -> DataFrame:
    return c.normalize_counts(_counts(spark, d)).select("cell", "gene", F.round("share", 9).alias("share"))


@query(
    "cell_zscores",
    f"""{_COUNTS}, m AS (SELECT *, sum(n) OVER w / {_GENES} AS mean, sum(n * n) OVER w / {_GENES} AS sq FROM counts WINDOW w AS (PARTITION BY cell))
SELECT cell, gene, round((n - mean) / sqrt(sq - mean * mean), 6) AS z FROM m""",
)
def cell_zscores(spark: SparkSession, d: str) -> DataFrame:
    return c.zscore_counts(_counts(spark, d), _GENES).select("cell", "gene", F.round("z", 6).alias("z"))


@query("cell_wide", f"{_COUNTS} SELECT cell, " + ", ".join(f'CAST(coalesce(sum(n) FILTER (gene = {g}), 0) AS BIGINT) AS "{g}"' for g in range(_GENES)) + " FROM counts GROUP BY cell")
def cell_wide(spark: SparkSession, d: str) -> DataFrame:
    return c.wide_counts(_counts(spark, d), list(range(_GENES)))


_KEPT = f"""{_COUNTS}, kept AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY cell) AS total FROM counts) WHERE total BETWEEN 5 AND 500),
good AS (SELECT * FROM kept WHERE gene IN (SELECT gene FROM kept GROUP BY gene HAVING count(DISTINCT cell) >= 3)),
logged AS (SELECT cell, gene, ln(1 + n * 10000 / sum(n) OVER (PARTITION BY cell)) AS value FROM good)"""


def _logged(spark: SparkSession, d: str) -> DataFrame:
    return c.log_normalize(c.filter_cells_genes(_counts(spark, d), 5, 500, 3))


@query("cell_log_normalized", f"{_KEPT} SELECT cell, gene, round(value, 6) AS value FROM logged")
def cell_log_normalized(spark: SparkSession, d: str) -> DataFrame:
    return _logged(spark, d).select("cell", "gene", F.round("value", 6).alias("value"))


@query(
    "gene_scaled",
    f"""{_KEPT}, nc AS (SELECT count(DISTINCT cell) AS k FROM counts), s AS (SELECT gene, sum(value) AS s, sum(value * value) AS q FROM logged GROUP BY gene)
SELECT cell, gene, round(least(10, (value - s / k) / sqrt((q - s * s / k) / (k - 1))), 5) AS z FROM logged JOIN s USING (gene), nc""",
)
def gene_scaled(spark: SparkSession, d: str) -> DataFrame:
    cells = _counts(spark, d).agg(F.count_distinct("cell").alias("k"))
    return c.gene_zscores(_logged(spark, d), cells).select("cell", "gene", F.round("z", 5).alias("z"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return molecules(spark, d).filter("cell_index != -1").groupBy(F.col("cell_index").alias("cell")).agg((F.min("fov") % 12 - 1).alias("grp"))


_GROUPS = "groups AS (SELECT cell_index AS cell, min(fov) % 12 - 1 AS grp FROM mols WHERE cell_index <> -1 GROUP BY 1)"


@query(
    "group_means",
    f"""{_COUNTS}, {_GROUPS}, sizes AS (SELECT grp, count(*) AS cells FROM groups WHERE grp IS NOT NULL AND grp <> -1 GROUP BY grp HAVING count(*) > 10)
SELECT grp, gene, CAST(max(cells) AS BIGINT) AS cells, round(sum(n) / max(cells), 9) AS mean FROM counts JOIN groups USING (cell) JOIN sizes USING (grp) GROUP BY grp, gene""",
)
def group_means(spark: SparkSession, d: str) -> DataFrame:
    return c.group_means(_counts(spark, d), _groups(spark, d), 10).withColumn("mean", F.round("mean", 9))


@query(
    "cell_info",
    f"""WITH {MOLS_SQL} SELECT cell_index AS cell, z, CAST(count(*) AS BIGINT) AS area, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1
FROM mols WHERE cell_index <> -1 GROUP BY 1, 2""",
)
def cell_info(spark: SparkSession, d: str) -> DataFrame:
    return c.cell_info(molecules(spark, d)).withColumns({"cx": F.round("cx", 6), "cy": F.round("cy", 6)})


@query(
    "cell_largest_plane",
    f"""WITH {MOLS_SQL}, i AS (SELECT cell_index AS cell, z, count(*) AS area FROM mols WHERE cell_index <> -1 GROUP BY 1, 2)
SELECT cell, z, CAST(area AS BIGINT) AS area FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY area DESC, z) AS k FROM i) WHERE k = 1""",
)
def cell_largest_plane(spark: SparkSession, d: str) -> DataFrame:
    return c.largest_plane(c.cell_info(molecules(spark, d)))


@query("cell_bounding_sizes", f"WITH {MOLS_SQL} SELECT cell_index AS cell, round(max(x) - min(x), 6) AS width, round(max(y) - min(y), 6) AS height FROM mols WHERE cell_index <> -1 GROUP BY 1 HAVING min(x) > 10 AND min(y) > 10 AND max(x) < 2038 AND max(y) < 2038")
def cell_bounding_sizes(spark: SparkSession, d: str) -> DataFrame:
    info = c.cell_info(molecules(spark, d)).groupBy("cell").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    inner = info.filter("x0 > 10 AND y0 > 10 AND x1 < 2038 AND y1 < 2038")
    return inner.select("cell", F.round(F.col("x1") - F.col("x0"), 6).alias("width"), F.round(F.col("y1") - F.col("y0"), 6).alias("height"))


@query("run_labels", "SELECT run_id, CAST(dense_rank() OVER (ORDER BY run_id) - 1 AS INTEGER) AS label_id FROM (SELECT DISTINCT run_id FROM molecules)")
def run_labels(spark: SparkSession, d: str) -> DataFrame:
    return c.dense_labels(table(spark, d, "molecules").select("run_id"), "run_id").distinct()


_READS = """reads AS (SELECT event_id, event_type AS channel, user_id % 20 AS perturbation, CAST(day(ts) % 3 AS INTEGER) AS batch, value FROM events),
ctl AS (SELECT batch, channel, avg(value) AS m, stddev_pop(value) AS s FROM reads WHERE perturbation = 0 GROUP BY 1, 2)"""


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Screen intensities: perturbation 0 is the control."""
    return table(spark, d, "events").select("event_id", F.col("event_type").alias("channel"), (F.col("user_id") % 20).alias("perturbation"), (F.day("ts") % 3).cast("int").alias("batch"), "value")


def screen_z(spark: SparkSession, d: str) -> DataFrame:
    return c.by_controls(reads(spark, d), ["batch", "channel"], "value", F.col("perturbation") == 0)


@query("screen_control_z", f"WITH {_READS} SELECT event_id, batch, channel, round((value - m) / nullif(s, 0), 6) AS z FROM reads JOIN ctl USING (batch, channel)")
def screen_control_z(spark: SparkSession, d: str) -> DataFrame:
    return screen_z(spark, d).select("event_id", "batch", "channel", F.round("z", 6).alias("z"))


@query("screen_centered", f"WITH {_READS} SELECT event_id, round(value - m, 6) AS z FROM reads JOIN ctl USING (batch, channel)")
def screen_centered(spark: SparkSession, d: str) -> DataFrame:
    return c.by_controls(reads(spark, d), ["batch", "channel"], "value", F.col("perturbation") == 0, True).select("event_id", F.round("z", 6).alias("z"))


@query(
    "screen_means",
    f"""WITH {_READS}, z AS (SELECT *, (value - m) / nullif(s, 0) AS z FROM reads JOIN ctl USING (batch, channel))
SELECT channel, perturbation, CAST(count(*) AS BIGINT) AS n, round(avg(z), 6) AS mean_z FROM z GROUP BY 1, 2 HAVING count(*) > 30""",
)
def screen_means(spark: SparkSession, d: str) -> DataFrame:
    grouped = screen_z(spark, d).groupBy("channel", "perturbation").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("z"), 6).alias("mean_z"))
    return grouped.filter("n > 30")
