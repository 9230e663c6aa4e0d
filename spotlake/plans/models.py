"""Queries: models, assignments, fits and small sequence tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.functions import sequences as sq
from spotlake.operators import designs as de
from spotlake.operators import models as mo
from spotlake.operators import probes as pb
from spotlake.operators.quality import with_code
from spotlake.operators.ranking import exact_quantiles
from spotlake.operators.spatial import contact_counts
from spotlake.operators.stats import permuted
from spotlake.plans import query
from spotlake.plans.decoding import _CODES as _TRACES_SQL
from spotlake.plans.decoding import _traces
from spotlake.plans.probes import FORWARD, REVERSE, _rc, _tm
from spotlake.plans.spatial import _LINK, PLANE_STEP, _links, _near, _points
from spotlake.session import table
from spotlake.sources.views import CODES_SQL, MOLS_SQL, PROBES_SQL, TRANSCRIPTS_SQL, codebook, molecules, probes, transcripts

_M, _C, _T, _P = (f"WITH {x}" for x in (MOLS_SQL, CODES_SQL, TRANSCRIPTS_SQL, PROBES_SQL))


@query("molecule_quality")
def molecule_quality(spark: SparkSession, d: str) -> DataFrame:
    """The probability of each molecule to be a blank, by boosted trees."""
    rated = with_code(molecules(spark, d), codebook(spark, d), "is_blank")
    return mo.predict_quality(rated, "molecule_id", "is_blank", ["magnitude", "distance", "area"]).withColumn("quality", F.round("quality", 4))


@query("trace_components")
def trace_components(spark: SparkSession, d: str) -> DataFrame:
    """Five principal components of the traces."""
    made = mo.reduce_dimensions(_traces(spark, d), "vec_id", "trace", 5)
    return made.select("vec_id", F.transform("components", lambda x: F.round(x, 6)).alias("components"))


@query(
    "code_clusters",
    f"""{_C}, p AS (SELECT a.barcode_id AS a, b.barcode_id AS b FROM codes a JOIN codes b ON a.barcode_id <> b.barcode_id AND bit_count(xor(a.code, b.code)) <= 2),
r AS (WITH RECURSIVE r(node, root) AS (SELECT barcode_id, barcode_id FROM codes UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.node) SELECT node, min(root) AS cluster FROM r GROUP BY node) SELECT node AS item, cluster FROM r""",
)
def code_clusters(spark: SparkSession, d: str) -> DataFrame:
    codes = codebook(spark, d)
    return mo.single_linkage(pb.hamming_pairs(codes), codes.select(F.col("barcode_id").alias("item")), "distance", 2)


def _voted(rounds: int) -> str:
    made = _LINK + ", ways AS (SELECT a, b FROM best UNION SELECT b, a FROM best), l0 AS (SELECT DISTINCT a AS node, a AS label FROM ways)"
    for i in range(rounds):
        made += f""", l{i + 1} AS (SELECT node, label FROM (SELECT node, label, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) AS k
 FROM (SELECT ways.a AS node, label FROM ways JOIN l{i} ON l{i}.node = ways.b UNION ALL SELECT node, label FROM l{i}) GROUP BY 1, 2) WHERE k = 1)"""
    return f"{made} SELECT node, label FROM l{rounds}"


@query("propagated_labels", _voted(4))
def propagated_labels(spark: SparkSession, d: str) -> DataFrame:
    """Communities of the links between planes."""
    return mo.propagate_labels(_links(spark, d))


@query(
    "codes_kept",
    f"""{_C}, k AS (SELECT list_reduce(list([code] ORDER BY barcode_id), lambda kept, c: CASE WHEN len(list_filter(kept, lambda x: bit_count(xor(x, c[1])) < 4)) = 0 THEN list_concat(kept, c) ELSE kept END) AS kept FROM codes)
SELECT min(barcode_id) AS barcode_id, arg_min(name, barcode_id) AS name, code FROM codes WHERE code IN (SELECT unnest(kept) FROM k) GROUP BY code""",
)
def codes_kept(spark: SparkSession, d: str) -> DataFrame:
    """Codes that differ from all kept before them in at least 4 bits."""
    return mo.choose_codes(codebook(spark, d), 4)


_ASSIGNED = f"""{_C}, {PROBES_SQL}, g AS (SELECT gene, row_number() OVER (ORDER BY gene) AS n FROM (SELECT DISTINCT id AS gene FROM codes WHERE id <> '')),
c AS (SELECT barcode_id, row_number() OVER (ORDER BY md5('5-' || barcode_id)) AS n FROM codes)
SELECT barcode_id, coalesce(gene, 'Blank-' || row_number() OVER (PARTITION BY gene IS NULL ORDER BY c.n)) AS gene FROM c LEFT JOIN g USING (n)"""


@query("codes_assigned", _ASSIGNED)
@query("codes_assigned_all", _ASSIGNED)
def codes_assigned(spark: SparkSession, d: str) -> DataFrame:
    codes = codebook(spark, d)
    return mo.assign_codes(codes.filter("id != ''"), "id", codes, 5)


@query("code_bit_errors", f"{_C} SELECT barcode_id, CAST(bit AS INTEGER) AS bit, CASE WHEN bit < 0 THEN code ELSE xor(code, 1::BIGINT << greatest(bit, 0)) END AS code FROM (SELECT barcode_id, code, unnest(range(-1, 16)) AS bit FROM codes)")
def code_bit_errors(spark: SparkSession, d: str) -> DataFrame:
    return mo.single_bit_errors(codebook(spark, d), 16)


_TILE_ROTATION = (
    f"""{_M}, g AS (SELECT * FROM mols WHERE global_x IS NOT NULL AND NOT isnan(global_x) AND global_y IS NOT NULL AND NOT isnan(global_y) AND x IS NOT NULL AND y IS NOT NULL),
s AS (SELECT run_id, fov, count(*) AS n, atan2(covar_pop(x, global_y) - covar_pop(y, global_x), covar_pop(x, global_x) + covar_pop(y, global_y)) AS a, avg(x) AS mx, avg(y) AS my, avg(global_x) AS mu, avg(global_y) AS mv FROM g GROUP BY run_id, fov)
SELECT run_id, fov, CAST(n AS BIGINT) AS n, round(a, 6) AS angle, round(mu - cos(a) * mx + sin(a) * my, 3) AS tx, round(mv - sin(a) * mx - cos(a) * my, 3) AS ty FROM s"""
)


@query("tile_rotation", _TILE_ROTATION)
@query("run_tile_rotation", _TILE_ROTATION)
def tile_rotation(spark: SparkSession, d: str) -> DataFrame:
    made = mo.fit_rotation(molecules(spark, d), ["run_id", "fov"], "x", "y", "global_x", "global_y")
    return made.select("run_id", "fov", "n", F.round("angle", 6).alias("angle"), F.round("tx", 3).alias("tx"), F.round("ty", 3).alias("ty"))


_TILE_SCALE_FIT = (
    f"{_M} SELECT run_id, fov, round(regr_slope(global_x, x), 8) AS slope, round(regr_intercept(global_x, x), 4) AS origin, round(regr_r2(global_x, x), 8) AS r2 FROM mols WHERE NOT isnan(global_x) AND global_x IS NOT NULL AND x IS NOT NULL GROUP BY run_id, fov"
)


@query("tile_scale_fit", _TILE_SCALE_FIT)
@query("run_tile_scale_fit", _TILE_SCALE_FIT)
def tile_scale_fit(spark: SparkSession, d: str) -> DataFrame:
    good = molecules(spark, d).filter("global_x IS NOT NULL AND NOT isnan(global_x) AND x IS NOT NULL")
    return good.groupBy("run_id", "fov").agg(F.round(F.regr_slope("global_x", "x"), 8).alias("slope"), F.round(F.regr_intercept("global_x", "x"), 4).alias("origin"), F.round(F.regr_r2("global_x", "x"), 8).alias("r2"))


LABELS_SQL = f"""WITH RECURSIVE {MOLS_SQL}, px AS (SELECT DISTINCT cell_index AS label, z, run_id, fov, floor(x / 64) AS px, floor(y / 64) AS py FROM mols WHERE cell_index > 0 AND fov IS NOT NULL),
s AS (SELECT label, z, count(*) AS size FROM px GROUP BY 1, 2), c AS (SELECT a.label, a.z, b.label AS other, b.z AS oz, count(*) AS both_n FROM px a JOIN px b ON b.z = a.z + 1.5 AND a.run_id = b.run_id AND a.fov = b.fov AND a.px = b.px AND a.py = b.py GROUP BY 1, 2, 3, 4),
f AS (SELECT c.label, c.z, c.other, both_n / s.size AS f0, both_n / o.size AS f1 FROM c JOIN s ON s.label = c.label AND s.z = c.z JOIN s o ON o.label = c.other AND o.z = c.oz)"""


def _label_pixels(spark: SparkSession, d: str) -> DataFrame:
    """The pixels (of 64 camera pixels) of every mask label and plane."""
    place = F.struct("run_id", "fov", F.floor(F.col("x") / 64).alias("px"), F.floor(F.col("y") / 64).alias("py"))
    return molecules(spark, d).filter("cell_index > 0 AND fov IS NOT NULL").select(F.col("cell_index").alias("label"), "z", place.alias("place")).distinct()


@query("plane_label_overlaps", f"{LABELS_SQL} SELECT label, z, other FROM (SELECT *, row_number() OVER (PARTITION BY label, z ORDER BY round(f0 + f1, 9) DESC, other) AS k FROM f WHERE f0 > 0.2 AND f1 > 0.2) WHERE k = 1")
def plane_label_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return mo.label_overlaps(_label_pixels(spark, d), PLANE_STEP, 0.2)


@query(
    "bit_cdf_scale",
    """WITH h AS (SELECT event_type AS bit, CAST(floor(value) AS BIGINT) AS v, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
g AS (SELECT bit, v, round(abs(sum(n) OVER (PARTITION BY bit ORDER BY v) / sum(n) OVER (PARTITION BY bit) - 0.9), 12) AS gap FROM h)
SELECT bit, v + 2 AS scale FROM (SELECT *, row_number() OVER (PARTITION BY bit ORDER BY gap, v) AS k FROM g) WHERE k = 1""",
)
def bit_cdf_scale(spark: SparkSession, d: str) -> DataFrame:
    return mo.cdf_scale(table(spark, d, "events").withColumnRenamed("event_type", "bit"), "bit", F.col("value"))


@query(
    "tile_scale_means",
    f"WITH {_TRACES_SQL}, q AS (SELECT label, bit, quantile_cont(value, 0.95) AS s, quantile_cont(value, 0.05) AS b FROM e GROUP BY 1, 2) SELECT bit, round(avg(s), 6) AS scale, round(avg(b), 6) AS background, round(median(s), 6) AS middle FROM q GROUP BY bit",
)
def tile_scale_means(spark: SparkSession, d: str) -> DataFrame:
    """Over tiles (labels), the mean of the quantiles of each bit, and the median of the high ones."""
    values = _traces(spark, d).select("label", F.posexplode("trace").alias("bit", "value"))
    per = exact_quantiles(values, ["label", "bit"], "value", {"s": 0.95, "b": 0.05})
    return per.groupBy("bit").agg(F.round(F.avg("s"), 6).alias("scale"), F.round(F.avg("b"), 6).alias("background"), F.round(F.median("s"), 6).alias("middle"))


@query("tiles_sampled", "SELECT fov FROM (SELECT DISTINCT fov FROM molecules WHERE fov IS NOT NULL) ORDER BY md5('42-' || fov) LIMIT 10")
def tiles_sampled(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable sample of ten tiles for optimisation."""
    tiles = table(spark, d, "molecules").select("fov").filter("fov IS NOT NULL").distinct()
    return tiles.orderBy(F.md5(F.concat_ws("-", F.lit("42"), F.col("fov").cast("string")))).limit(10)


_BOTH_WAYS = _near(3.0) + ", mixed AS (SELECT a.id, b.barcode_id FROM (SELECT id, row_number() OVER (ORDER BY id) AS r FROM pt) a JOIN (SELECT barcode_id, row_number() OVER (ORDER BY md5('1-' || id)) AS r FROM pt) b USING (r))"


@query("contact_matrix_permuted", _BOTH_WAYS + " SELECT p.barcode_id AS type_a, q.barcode_id AS type_b, CAST(count(*) AS BIGINT) AS n FROM n JOIN mixed p ON p.id = a JOIN mixed q ON q.id = b GROUP BY 1, 2")
def contact_matrix_permuted(spark: SparkSession, d: str) -> DataFrame:
    pts = _points(spark, d, "barcode_id")
    return contact_counts(pts, permuted(pts, "id", "barcode_id", 1).withColumnRenamed("barcode_id", "type"), 3.0)


@query(
    "gene_names_first_seen",
    "SELECT lower(trim(gene_symbol)) AS gene, min(molecule_id) AS first_id, CAST(count(*) AS BIGINT) AS n FROM molecules WHERE gene_symbol IS NOT NULL GROUP BY 1",
)
def gene_names_first_seen(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "molecules").filter("gene_symbol IS NOT NULL").groupBy(F.lower(F.trim("gene_symbol")).alias("gene"))
    return named.agg(F.min("molecule_id").alias("first_id"), F.count(F.lit(1)).alias("n"))


@query(
    "code_gene_transcript",
    f"{_T}, {CODES_SQL}, s AS (SELECT gene_id, transcript_id, row_number() OVER (PARTITION BY gene_id ORDER BY length(seq), transcript_id) AS k FROM tx WHERE seq IS NOT NULL) SELECT barcode_id, name, coalesce(transcript_id, '') AS transcript_id FROM codes LEFT JOIN s ON s.gene_id = codes.id AND k = 1",
)
def code_gene_transcript(spark: SparkSession, d: str) -> DataFrame:
    shortest = pb.transcript_of_gene(transcripts(spark, d), "shortest").select(F.col("gene_id").alias("id"), "transcript_id")
    return codebook(spark, d).join(shortest, "id", "left").select("barcode_id", "name", F.coalesce("transcript_id", F.lit("")).alias("transcript_id"))


@query(
    "transcript_blocks",
    f"""{_T}, b AS (SELECT transcript_id, seq, length(seq) AS n, greatest(1, CAST(round_even(length(seq) / 500.0, 0) AS BIGINT)) AS k FROM tx WHERE seq <> ''), u AS (SELECT *, unnest(range(0, k)) AS i FROM b)
SELECT transcript_id, CAST(i AS INTEGER) AS block, CAST(i * n // k AS INTEGER) AS start_at, md5(substring(seq, i * n // k + 1, (i + 1) * n // k - i * n // k)) AS digest FROM u""",
)
def transcript_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Sequences cut into round(length / 500) blocks of nearly equal size."""
    n = F.length("seq").cast("bigint")
    k = F.greatest(F.lit(1), F.bround(n / 500.0, 0).cast("bigint"))
    each = transcripts(spark, d).filter("seq <> ''").select("transcript_id", "seq", n.alias("n"), k.alias("k")).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("i"))
    cut = each.withColumn("a", F.expr("i * n div k")).withColumn("b", F.expr("(i + 1) * n div k"))
    return cut.select("transcript_id", F.col("i").cast("int").alias("block"), F.col("a").cast("int").alias("start_at"), F.md5(F.expr("substring(seq, cast(a as int) + 1, cast(b - a as int))")).alias("digest"))


@query("seq_halves", f"{_P} SELECT probe_id, {_rc('left(seq, length(seq) // 2)')} AS left_rc, {_rc('substring(seq, length(seq) // 2 + 1)')} AS right_rc FROM probe")
def seq_halves(spark: SparkSession, d: str) -> DataFrame:
    half = F.floor(F.length("seq") / 2).cast("int")
    left, right = F.substring(F.col("seq"), F.lit(1), half), F.substring(F.col("seq"), half + 1, F.length("seq"))
    return probes(spark, d).select("probe_id", sq.revcomp(left).alias("left_rc"), sq.revcomp(right).alias("right_rc"))


_SITES = " OR ".join(f"contains(target, '{s}') OR contains(target, {_rc(repr(s))})" for s in ("GAATTC", "GGATCC"))


@query(
    "design_pipeline",
    f"""WITH RECURSIVE {TRANSCRIPTS_SQL}, w AS (SELECT DISTINCT gene_id, transcript_id, shift, substring(seq, shift + 1, 30) AS target FROM (SELECT gene_id, transcript_id, seq, CAST(unnest(range(0, length(seq) - 29, 10)) AS INTEGER) AS shift FROM tx WHERE length(seq) >= 30)),
t AS (SELECT *, (30 - length(regexp_replace(target, '[GC]', '', 'g'))) / 30 AS gc, {_tm('target')} AS tm FROM w WHERE regexp_full_match(target, '[ACGT]+')),
g AS (SELECT *, transcript_id || ':' || shift AS key FROM t WHERE gc BETWEEN 0.4 AND 0.6 AND tm BETWEEN 55 AND 75 AND NOT ({_SITES})),
km AS (SELECT kmer, count(*) AS n FROM (SELECT substring(seq, i + 1, 15) AS kmer FROM (SELECT seq, unnest(range(0, length(seq) - 14)) AS i FROM tx WHERE length(seq) >= 15)) WHERE regexp_full_match(kmer, '[ACGT]+') GROUP BY 1),
h AS (SELECT key FROM (SELECT key, substring(target, i + 1, 15) AS kmer FROM (SELECT DISTINCT key, target, unnest(range(0, 16)) AS i FROM g)) LEFT JOIN km USING (kmer) GROUP BY 1 HAVING sum(coalesce(n, 0)) <= 3 * count(*)),
l AS (SELECT gene_id, transcript_id, list(struct_pack(s := shift, k := key, e := shift + 30) ORDER BY shift, key) AS l FROM g WHERE key IN (SELECT key FROM h) GROUP BY 1, 2),
r AS (SELECT gene_id, transcript_id, l, l[1] AS now FROM l UNION ALL SELECT gene_id, transcript_id, l, list_filter(l, lambda x: x.s >= r.now.e)[1] AS now FROM r WHERE len(list_filter(l, lambda x: x.s >= r.now.e)) > 0)
SELECT g.gene_id, g.transcript_id, g.shift, round(tm, 4) AS tm, '{FORWARD}' || left(target, 5) || 'A' || {_rc('target')} || 'A' || right(target, 5) || '{REVERSE}' AS oligo FROM r JOIN g ON g.gene_id = r.gene_id AND g.key = r.now.k""",
)
def design_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Probes for all transcripts: windows, GC and melting temperature, k-mers seen elsewhere, sites, no overlap, assembly."""
    kept = de.rare_windows(transcripts(spark, d), 30, 10, 15, (0.4, 0.6), (55.0, 75.0), ["GAATTC", "GGATCC"], 3)
    bits = [F.substring("target", 1, 5), F.substring("target", -5, 5)]
    return kept.select("gene_id", "transcript_id", "shift", F.round("tm", 4).alias("tm"), pb.assemble(F.col("target"), bits, F.lit(FORWARD), F.lit(REVERSE)).alias("oligo"))
