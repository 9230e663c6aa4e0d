"""Queries: groups of cells compared, and counts put together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import groups as gr
from spotlake.operators import stats as st
from spotlake.operators.proximity import UNITS, region_parts
from spotlake.plans import query
from spotlake.plans.cellcounts import _COUNTS, _GROUPS, _counts, _groups
from spotlake.plans.problems import PLACES_SQL
from spotlake.plans.spatial import _ASSIGNED, assigned_counts
from spotlake.session import table
from spotlake.sources.views import CODES_SQL, MOLS_SQL, codebook, molecules

_A, _B, _C = gr.DRAW_STEPS
_REPEATS, _SIZE = 10, 250


@query(
    "group_differential",
    f"""{_COUNTS}, {_GROUPS}, num AS (SELECT cell, grp, row_number() OVER (PARTITION BY grp ORDER BY cell) - 1 AS r, count(*) OVER (PARTITION BY grp) AS size FROM groups WHERE grp IS NOT NULL),
draw AS (SELECT DISTINCT ON (grp, rep, i) grp, rep, i, ((i * {_A} + rep * {_B} + grp * {_C}) % size + size) % size AS r FROM num CROSS JOIN (SELECT unnest(range({_REPEATS})) AS rep) CROSS JOIN (SELECT unnest(range({_SIZE})) AS i)),
drawn AS (SELECT d.grp, rep, i, cell FROM draw d JOIN num ON num.grp = d.grp AND num.r = d.r),
side AS (SELECT grp, rep, i, cell, true AS mine FROM drawn WHERE grp <> 0 UNION ALL SELECT o.grp, rep, i, cell, false FROM drawn d CROSS JOIN (SELECT DISTINCT grp FROM drawn WHERE grp <> 0) o WHERE d.grp = 0),
met AS (SELECT DISTINCT grp, rep, gene FROM side JOIN counts USING (cell)),
dense AS (SELECT m.grp, m.rep, m.gene, mine, coalesce(k.n, 0) AS n FROM met m JOIN side s ON s.grp = m.grp AND s.rep = m.rep LEFT JOIN counts k ON k.cell = s.cell AND k.gene = m.gene),
hist AS (SELECT grp, rep, gene, n, count(*) FILTER (mine) AS k1, count(*) AS k FROM dense GROUP BY 1, 2, 3, 4),
rk AS (SELECT *, coalesce(sum(k) OVER (PARTITION BY grp, rep, gene ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (k + 1) / 2.0 AS rank FROM hist),
s AS (SELECT grp, rep, gene, (sum(k1 * rank) - {_SIZE * (2 * _SIZE + 1) / 2}) / sqrt({_SIZE * _SIZE * (2 * _SIZE + 1) / 12}) AS z, sum(n * k1) / nullif(sum(n * (k - k1)), 0) AS ratio FROM rk GROUP BY 1, 2, 3),
f AS (SELECT grp, gene, avg(ratio) AS ratio, sum(z) / {_REPEATS} AS z, sum({st.two_sided_p_sql('z')}) / {_REPEATS} AS p FROM s GROUP BY 1, 2) SELECT grp, gene, round(ratio, 6) AS ratio, round(z, 6) AS z, round(p, 7) AS p FROM f""",
)
def group_differential(spark: SparkSession, d: str) -> DataFrame:
    """Genes of every group against group 0, over ten samples of 250 cells."""
    made = gr.bootstrap_differential(_counts(spark, d), _groups(spark, d), 0, _REPEATS, _SIZE)
    return made.select("grp", "gene", F.round("ratio", 6).alias("ratio"), F.round("z", 6).alias("z"), F.round("p", 7).alias("p"))


_SHUFFLES = 100
_CORR = "round(CASE WHEN stddev_pop(a.mean) * stddev_pop(b.mean) > 1e-15 THEN covar_pop(a.mean, b.mean) / (stddev_pop(a.mean) * stddev_pop(b.mean)) END, 9) AS corr"


@query(
    "group_correlation_pvalues",
    f"""{_COUNTS}, {_GROUPS}, g AS (SELECT * FROM groups WHERE grp IS NOT NULL), size AS (SELECT grp, count(*) AS cells FROM g GROUP BY 1),
prof AS (SELECT grp, gene, sum(n) / max(cells) AS mean FROM counts JOIN g USING (cell) JOIN size USING (grp) GROUP BY 1, 2),
obs AS (SELECT a.grp AS a, b.grp AS b, {_CORR} FROM prof a JOIN prof b USING (gene) WHERE a.grp < b.grp GROUP BY 1, 2),
r AS (SELECT cell, row_number() OVER (ORDER BY cell) AS r FROM g), m AS (SELECT seed, grp, row_number() OVER (PARTITION BY seed ORDER BY md5(seed || '-' || cell)) AS r FROM g CROSS JOIN (SELECT unnest(range({_SHUFFLES})) AS seed)),
sp AS (SELECT seed, grp, gene, sum(n) / max(cells) AS mean FROM m JOIN r USING (r) JOIN counts USING (cell) JOIN size USING (grp) GROUP BY 1, 2, 3),
sc AS (SELECT a.seed, a.grp AS a, b.grp AS b, {_CORR} FROM sp a JOIN sp b ON a.seed = b.seed AND a.gene = b.gene WHERE a.grp < b.grp GROUP BY 1, 2, 3),
p AS (SELECT o.a, o.b, o.corr, (SELECT count(*) FROM sc WHERE sc.a = o.a AND sc.b = o.b AND sc.corr > o.corr) / {_SHUFFLES}.0 AS p FROM obs o),
mat AS (SELECT a, b, p FROM p UNION ALL SELECT b, a, p FROM p UNION ALL SELECT grp, grp, 1 FROM size),
k AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM mat), q AS (SELECT a, b, p, least(1.0, min(p * m / k) OVER (ORDER BY k DESC)) AS q FROM k), t AS (SELECT p, min(q) AS q FROM q GROUP BY 1)
SELECT p.a, p.b, round(corr, 6) AS corr, round(CAST(p.p AS DOUBLE), 6) AS p, round(CAST(t.q AS DOUBLE), 6) AS q FROM p JOIN t ON t.p = p.p""",
)
def group_correlation_pvalues(spark: SparkSession, d: str) -> DataFrame:
    """Correlations of the groups' profiles with their share of 100 shuffles and its correction."""
    made = gr.correlation_p(_counts(spark, d), _groups(spark, d), _SHUFFLES)
    return made.select("a", "b", F.round("corr", 6).alias("corr"), F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


_COV = """covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, y) AS yy, covar_pop(y, z) AS yz, covar_pop(z, z) AS zz"""
_DET = "xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz)"
_INVERSE = "(yy * zz - yz * yz) / det AS ixx, (xz * yz - xy * zz) / det AS ixy, (xy * yz - xz * yy) / det AS ixz, (xx * zz - xz * xz) / det AS iyy, (xy * xz - xx * yz) / det AS iyz, (xx * yy - xy * xy) / det AS izz"
_SHAPES = f"""WITH {MOLS_SQL}, g AS (SELECT * FROM mols WHERE fov IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL AND NOT isnan(x) AND NOT isnan(y) AND NOT isnan(z)),
t AS (SELECT *, {_INVERSE} FROM (SELECT *, {_DET} AS det FROM (SELECT run_id, fov, count(*) AS n, {_COV} FROM g GROUP BY 1, 2))),
r AS (SELECT *, {_INVERSE} FROM (SELECT *, {_DET} AS det FROM (SELECT run_id, {_COV} FROM g GROUP BY 1)))"""


@query(
    "tile_shapes",
    f"""{_SHAPES} SELECT t.run_id, t.fov, CAST(t.n AS BIGINT) AS n, round(t.xx, 1) AS xx, round(t.yy, 1) AS yy, round(t.zz, 4) AS zz, round(CASE WHEN abs(t.det) > 1e-15 THEN t.izz END, 6) AS izz,
round(CASE WHEN t.det > 1e-15 AND r.det > 1e-15 THEN (t.xx * r.ixx + 2 * t.xy * r.ixy + 2 * t.xz * r.ixz + t.yy * r.iyy + 2 * t.yz * r.iyz + t.zz * r.izz - 3 + ln(r.det / t.det)) / 2 END, 6) AS kl FROM t JOIN r USING (run_id)""",
)
def tile_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The spread of the molecules of every tile, its inverse, and how far it is from that of the whole run."""
    good = molecules(spark, d).filter("fov IS NOT NULL")
    tile, run = gr.covariances(good, ["run_id", "fov"], ["x", "y", "z"]).alias("t"), gr.covariances(good, ["run_id"], ["x", "y", "z"]).alias("r")
    both = tile.join(run, F.col("t.run_id") == F.col("r.run_id"))
    return both.select("t.run_id", "t.fov", "t.n", F.round("t.xx", 1).alias("xx"), F.round("t.yy", 1).alias("yy"), F.round("t.zz", 4).alias("zz"), F.round("t.izz", 6).alias("izz"), F.round(gr.divergence("t", "r"), 6).alias("kl"))


@query("counts_without_blanks", f"{_COUNTS}, {CODES_SQL} SELECT cell, gene, CAST(n AS BIGINT) AS n FROM counts JOIN codes ON codes.barcode_id = gene WHERE NOT starts_with(name, 'Blank')")
def counts_without_blanks(spark: SparkSession, d: str) -> DataFrame:
    genes = codebook(spark, d).filter(~F.startswith("name", F.lit("Blank"))).select(F.col("barcode_id").alias("gene"))
    return _counts(spark, d).join(genes, "gene", "left_semi").select("cell", "gene", "n")


@query("counts_appended", f"{_ASSIGNED}, appended AS (SELECT 'mask' AS source, CAST(cell_index AS VARCHAR) AS cell, barcode_id AS gene, count(*) AS n FROM mols WHERE cell_index <> -1 GROUP BY 1, 2, 3 UNION ALL SELECT 'polygons', cell, barcode_id, count(*) FROM assigned JOIN mols USING (molecule_id) GROUP BY 1, 2, 3) SELECT source, cell, gene, CAST(n AS BIGINT) AS n FROM appended")
def counts_appended(spark: SparkSession, d: str) -> DataFrame:
    """The counts by mask labels and by polygons, one under the other."""
    mask = _counts(spark, d).select(F.lit("mask").alias("source"), F.col("cell").cast("string").alias("cell"), "gene", "n")
    return mask.unionByName(assigned_counts(spark, d).select(F.lit("polygons").alias("source"), "cell", "gene", "n"))


@query("mol_bit_means", f"WITH {MOLS_SQL}, {CODES_SQL}, m AS (SELECT barcode_id, magnitude FROM mols WHERE distance < 0.5 AND NOT isnan(distance) AND area > 4 AND NOT isnan(magnitude)), e AS (SELECT barcode_id, CAST(unnest(range(16)) AS INTEGER) AS bit, unnest(bits) AS lit FROM codes), p AS (SELECT bit, avg(mm) AS mm FROM (SELECT barcode_id, bit, avg(magnitude) AS mm FROM m JOIN e USING (barcode_id) WHERE lit = 1 GROUP BY 1, 2) GROUP BY 1) SELECT bit, round(mm / (SELECT avg(mm) FROM p), 6) AS refactor FROM p")
def mol_bit_means(spark: SparkSession, d: str) -> DataFrame:
    """What each bit's scale is off by, from the magnitudes of close and large molecules whose code has it on."""
    good = molecules(spark, d).filter("distance < 0.5 AND NOT isnan(distance) AND area > 4 AND NOT isnan(magnitude)")
    lit = codebook(spark, d).select("barcode_id", F.posexplode("bits").alias("bit", "lit")).filter("lit = 1").select("barcode_id", "bit")
    per = good.groupBy("barcode_id").agg(F.avg("magnitude").alias("m")).filter("m IS NOT NULL").join(lit, "barcode_id").groupBy("bit").agg(F.avg("m").alias("m"))
    return per.join(F.broadcast(per.agg(F.avg("m").alias("all")))).select("bit", F.round(F.try_divide("m", "all"), 6).alias("refactor"))  # one row


@query("mol_area_counts", f"WITH {MOLS_SQL} SELECT area, CAST(count(*) AS BIGINT) AS n FROM mols GROUP BY 1")
def mol_area_counts(spark: SparkSession, d: str) -> DataFrame:
    return molecules(spark, d).groupBy("area").agg(F.count(F.lit(1)).alias("n"))


@query("cell_view_limits", f"{PLACES_SQL} SELECT z, round(min(x0) / 1000.0, 3) AS min_x, round(max(x1) / 1000.0, 3) AS max_x, round(min(y0) / 1000.0, 3) AS min_y, round(max(y1) / 1000.0, 3) AS max_y FROM box GROUP BY 1")
def cell_view_limits(spark: SparkSession, d: str) -> DataFrame:
    """The box around all polygons of every plane."""
    parts = region_parts(table(spark, d, "cells"), "id", "geometry", "z")
    return parts.groupBy("z").agg(*[F.round(f(c) / UNITS, 3).alias(c) for f, c in ((F.min, "min_x"), (F.max, "max_x"), (F.min, "min_y"), (F.max, "max_y"))])
