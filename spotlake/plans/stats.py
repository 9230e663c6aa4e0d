"""Queries: tests, corrections, correlations and permutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import stats as st
from spotlake.operators.cellcounts import group_means
from spotlake.operators.ranking import exact_quantiles, row_numbers
from spotlake.plans import query
from spotlake.plans.cellcounts import _COUNTS, _GROUPS, _READS, _counts, _groups, reads, screen_z
from spotlake.session import table
from spotlake.sources.views import MOLS_SQL, molecules

_MWU = f"""WITH {_READS}, v AS (SELECT channel, perturbation, value FROM reads WHERE value IS NOT NULL),
pairs AS (SELECT p.channel, p.perturbation AS grp, v.value, v.perturbation = 0 AS is_control FROM (SELECT DISTINCT channel, perturbation FROM v WHERE perturbation <> 0) p JOIN v ON v.channel = p.channel AND (v.perturbation = 0 OR v.perturbation = p.perturbation)),
r AS (SELECT *, rank() OVER (PARTITION BY channel, grp ORDER BY value) + (count(*) OVER (PARTITION BY channel, grp, value) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY channel, grp, value) AS t FROM pairs),
s AS (SELECT channel, grp, count(*) FILTER (NOT is_control) AS n1, count(*) FILTER (is_control) AS n0, sum(rk) FILTER (NOT is_control) AS r1, sum(t * t - 1.0) AS ties FROM r GROUP BY 1, 2),
u AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u, n1 + n0 AS n FROM s),
z AS (SELECT *, (greatest(u, n1 * n0 - u) - n1 * n0 / 2.0 - 0.5) / sqrt(n1 * n0 / 12.0 * (n + 1 - ties / (n * (n - 1.0)))) AS z FROM u),
p AS (SELECT channel, grp AS perturbation, n1 AS n, n0 AS n_control, u, z * CASE WHEN u < n1 * n0 / 2.0 THEN -1 ELSE 1 END AS z, {st.two_sided_p_sql('greatest(z, 0.0)')} AS p FROM z)"""


def _mwu(spark: SparkSession, d: str) -> DataFrame:
    return st.rank_sum_against_controls(reads(spark, d), "channel", "perturbation", "value", 0)


@query("screen_mwu", _MWU + " SELECT channel, perturbation, CAST(n AS BIGINT) AS n, CAST(n_control AS BIGINT) AS n_control, round(u, 3) AS u, round(z, 6) AS z, round(p, 8) AS p FROM p")
def screen_mwu(spark: SparkSession, d: str) -> DataFrame:
    return _mwu(spark, d).withColumns({"u": F.round("u", 3), "z": F.round("z", 6), "p": F.round("p", 8)})


_STEP = """, k AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY p) AS k, count(*) OVER (PARTITION BY channel) AS m FROM p),
h AS (SELECT *, {h} AS h FROM k) SELECT channel, perturbation, round(least(1.0, min(p * m * h / k) OVER (PARTITION BY channel ORDER BY k DESC)), 7) AS q FROM h"""


@query("screen_fdr_by", _MWU + _STEP.format(h="list_sum(list_transform(range(1, m + 1), lambda i: 1.0 / i))"))
def screen_fdr_by(spark: SparkSession, d: str) -> DataFrame:
    return st.adjust(_mwu(spark, d), ["channel"], "p", "by").select("channel", "perturbation", F.round("q", 7).alias("q"))


@query("screen_fdr_bh", _MWU + _STEP.format(h="1.0"))
def screen_fdr_bh(spark: SparkSession, d: str) -> DataFrame:
    return st.adjust(_mwu(spark, d), ["channel"], "p", "bh").select("channel", "perturbation", F.round("q", 7).alias("q"))


@query(
    "screen_rank_plot",
    f"""WITH {_READS}, z AS (SELECT *, (value - m) / nullif(s, 0) AS z FROM reads JOIN ctl USING (batch, channel)), g AS (SELECT channel, perturbation, round(avg(z), 9) AS mean_z FROM z GROUP BY 1, 2)
SELECT channel, perturbation, mean_z, CAST(row_number() OVER (PARTITION BY channel ORDER BY mean_z, perturbation) - 1 AS BIGINT) AS place FROM g""",
)
def screen_rank_plot(spark: SparkSession, d: str) -> DataFrame:
    means = screen_z(spark, d).groupBy("channel", "perturbation").agg(F.round(F.avg("z"), 9).alias("mean_z"))
    return row_numbers(means, ["channel"], ["mean_z", "perturbation"], "place")


@query(
    "screen_welch",
    f"""WITH {_READS}, a AS (SELECT channel, batch, avg(value) FILTER (perturbation <> 0) AS m1, avg(value) FILTER (perturbation = 0) AS m0, var_samp(value) FILTER (perturbation <> 0) AS v1, var_samp(value) FILTER (perturbation = 0) AS v0,
count(value) FILTER (perturbation <> 0) AS n1, count(value) FILTER (perturbation = 0) AS n0 FROM reads GROUP BY 1, 2)
SELECT channel, batch, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS t FROM a""",
)
def screen_welch(spark: SparkSession, d: str) -> DataFrame:
    return st.welch_t(reads(spark, d), ["channel", "batch"], "value", F.col("perturbation") != 0).withColumn("t", F.round("t", 6))


_DE = f"""{_COUNTS}, {_GROUPS}, cells AS (SELECT cell, coalesce(grp < 5, false) AS in_group FROM groups),
dense AS (SELECT c.cell, c.in_group, g.gene, coalesce(k.n, 0) AS n FROM cells c CROSS JOIN (SELECT DISTINCT gene FROM counts) g LEFT JOIN counts k ON k.cell = c.cell AND k.gene = g.gene),
r AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY n) + (count(*) OVER (PARTITION BY gene, n) - 1) / 2.0 AS rk FROM dense),
s AS (SELECT gene, sum(rk) FILTER (in_group) AS r1, count(*) FILTER (in_group) AS n1, count(*) AS n, avg(n) FILTER (in_group) AS m1, avg(n) FILTER (NOT in_group) AS m0 FROM r GROUP BY gene),
z AS (SELECT gene, m1 / nullif(m0, 0) AS ratio, (r1 - n1 * (n + 1) / 2.0) / sqrt(n1 * (n - n1) * (n + 1) / 12.0) AS z FROM s),
p AS (SELECT *, {st.two_sided_p_sql('z')} AS p FROM z), k AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS m FROM p)
SELECT gene, round(ratio, 6) AS ratio, round(z, 6) AS z, round(p, 8) AS p, round(least(1.0, min(p * m / k) OVER (ORDER BY k DESC)), 7) AS q FROM k"""


@query("differential_genes", _DE)
def differential_genes(spark: SparkSession, d: str) -> DataFrame:
    cells = _groups(spark, d).select("cell", F.coalesce(F.col("grp") < 5, F.lit(False)).alias("in_group"))
    size = cells.agg(F.count_if("in_group").alias("n_in"), F.count(F.lit(1)).alias("n_all"))
    sized = cells.join(F.broadcast(size))
    counts = _counts(spark, d)
    n_in, n_all = size.select("n_in").scalar(), size.select("n_all").scalar()
    found = st.differential(counts, sized.select("cell", "in_group"), n_in, n_all)
    return st.adjust(found, [], "p").select("gene", F.round("ratio", 6).alias("ratio"), F.round("z", 6).alias("z"), F.round("p", 8).alias("p"), F.round("q", 7).alias("q"))


_PROFILES = f"""{_COUNTS}, {_GROUPS}, sizes AS (SELECT grp, count(*) AS cells FROM groups WHERE grp IS NOT NULL AND grp <> -1 GROUP BY grp),
prof AS (SELECT grp, gene, sum(n) / max(cells) AS mean FROM counts JOIN groups USING (cell) JOIN sizes USING (grp) GROUP BY grp, gene)"""


@query("group_correlations", f"{_PROFILES} SELECT a.grp AS a, b.grp AS b, CAST(count(*) AS BIGINT) AS n, round(CASE WHEN stddev_pop(a.mean) * stddev_pop(b.mean) > 1e-15 THEN covar_pop(a.mean, b.mean) / (stddev_pop(a.mean) * stddev_pop(b.mean)) END, 6) AS corr FROM prof a JOIN prof b USING (gene) WHERE a.grp < b.grp GROUP BY 1, 2")
def group_correlations(spark: SparkSession, d: str) -> DataFrame:
    return st.correlations(group_means(_counts(spark, d), _groups(spark, d), 0), "grp", "gene", "mean").withColumn("corr", F.round("corr", 6))


_PLACED = f"WITH {MOLS_SQL}, placed AS (SELECT molecule_id, cell_index, barcode_id FROM mols WHERE cell_index <> -1)"


def _placed(spark: SparkSession, d: str) -> DataFrame:
    return molecules(spark, d).filter("cell_index != -1").select("molecule_id", "cell_index", "barcode_id")


def _perm_sql(seed: str) -> str:
    return f"SELECT a.molecule_id, b.barcode_id FROM (SELECT molecule_id, row_number() OVER (ORDER BY molecule_id) AS r FROM placed) a JOIN (SELECT barcode_id, row_number() OVER (ORDER BY md5('{seed}-' || molecule_id)) AS r FROM placed) b USING (r)"


@query("permuted_labels", f"{_PLACED} {_perm_sql('7')}")
def permuted_labels(spark: SparkSession, d: str) -> DataFrame:
    return st.permuted(_placed(spark, d), "molecule_id", "barcode_id", 7)


_SHUFFLES = 100


@query(
    "permutation_pvalues",
    f"""{_PLACED}, o AS (SELECT cell_index, barcode_id, count(*) AS n FROM placed GROUP BY 1, 2),
r AS (SELECT cell_index, row_number() OVER (ORDER BY molecule_id) AS r FROM placed), i AS (SELECT unnest(range({_SHUFFLES})) AS seed),
s AS (SELECT seed, barcode_id, row_number() OVER (PARTITION BY seed ORDER BY md5(seed || '-' || molecule_id)) AS r FROM placed CROSS JOIN i),
c AS (SELECT seed, cell_index, barcode_id, count(*) AS m FROM s JOIN r USING (r) GROUP BY 1, 2, 3),
b AS (SELECT cell_index, barcode_id, count(*) AS t FROM c JOIN o USING (cell_index, barcode_id) WHERE m > n GROUP BY 1, 2),
p AS (SELECT o.cell_index, o.barcode_id, n, coalesce(b.t, 0) / {_SHUFFLES}.0 AS p FROM o LEFT JOIN b USING (cell_index, barcode_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY cell_index ORDER BY p, barcode_id) AS k, count(*) OVER (PARTITION BY cell_index) AS m FROM p),
q AS (SELECT *, min(p * m / k) OVER (PARTITION BY cell_index ORDER BY k DESC) AS q FROM k)
SELECT cell_index, barcode_id, CAST(n AS BIGINT) AS n, round(CAST(p AS DOUBLE), 6) AS p, round(CAST(least(1.0, min(q) OVER (PARTITION BY cell_index, p)) AS DOUBLE), 6) AS q FROM q""",
)
def permutation_pvalues(spark: SparkSession, d: str) -> DataFrame:
    found = st.permutation_p(_placed(spark, d), "molecule_id", "cell_index", "barcode_id", _SHUFFLES)
    return found.select("cell_index", "barcode_id", "n", F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


@query("bit_quantiles", "SELECT event_type AS bit, round(quantile_cont(value, 0.95), 6) AS high, round(quantile_cont(value, 0.05), 6) AS low, round(median(CASE WHEN value > 0 THEN value END), 6) AS middle FROM events GROUP BY 1")
def bit_quantiles(spark: SparkSession, d: str) -> DataFrame:
    values = table(spark, d, "events").select(F.col("event_type").alias("bit"), "value")
    ends = exact_quantiles(values, ["bit"], "value", {"high": 0.95, "low": 0.05})
    middle = exact_quantiles(values.filter("value > 0"), ["bit"], "value", {"middle": 0.5})
    return ends.join(middle, "bit", "left").select("bit", *[F.round(c, 6).alias(c) for c in ("high", "low", "middle")])
