"""Queries: image planes as rows of pixels (a pixel's value is the number of molecules in it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import pixels as px
from spotlake.plans import query
from spotlake.sources.views import MOLS_SQL, molecules

#: Camera pixels to a side of the pixels counted here, and pixels to a side of a plane.
SIZE, SIDE = 16, 128
_SITE = ["run_id", "fov"]
_PLANE = [*_SITE, "z"]
_SOFT = px.gaussian(1.0, 2)
_WIDE = px.gaussian(2.0, 4)

_ON = f"py BETWEEN 0 AND {SIDE - 1} AND px BETWEEN 0 AND {SIDE - 1}"
_PIX = f"""WITH RECURSIVE {MOLS_SQL}, pix AS (SELECT run_id, fov, z, CAST(floor(y / {SIZE}) AS INTEGER) AS py, CAST(floor(x / {SIZE}) AS INTEGER) AS px, CAST(count(*) AS DOUBLE) AS v
FROM mols WHERE run_id IS NOT NULL AND fov IS NOT NULL AND z IS NOT NULL AND x >= 0 AND x < {SIZE * SIDE} AND y >= 0 AND y < {SIZE * SIDE} GROUP BY ALL)"""
_AT = "run_id, fov, z, py, px"


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    return px.rasterize(molecules(spark, d), _PLANE, "x", "y", SIZE, SIDE)


def _offsets(kernel: list[tuple]) -> str:
    return f"(SELECT unnest([{', '.join(str(k[0]) for k in kernel)}]) AS dy, unnest([{', '.join(str(k[1]) for k in kernel)}]) AS dx, unnest([{', '.join(repr(k[2]) if len(k) > 2 else '1' for k in kernel)}]) AS w)"


def _convolved(source: str, kernel: px.Kernel) -> str:
    return f"(SELECT run_id, fov, z, y AS py, x AS px, round(sum(v * w), {px.DIGITS}) AS v FROM (SELECT run_id, fov, z, py + dy AS y, px + dx AS x, v, w FROM {source} CROSS JOIN {_offsets(kernel)}) WHERE y BETWEEN 0 AND {SIDE - 1} AND x BETWEEN 0 AND {SIDE - 1} GROUP BY 1, 2, 3, 4, 5)"


def _peaks(source: str, reach: int, least: float) -> str:
    return f"""(SELECT {_AT}, v AS h FROM {source} a WHERE v >= {least} AND NOT EXISTS (SELECT 1 FROM {source} b WHERE b.run_id = a.run_id AND b.fov = a.fov AND b.z = a.z AND b.v >= {least}
AND abs(b.py - a.py) <= {reach} AND abs(b.px - a.px) <= {reach} AND (b.v > a.v OR (b.v = a.v AND (b.py < a.py OR (b.py = a.py AND b.px < a.px))))))"""


@query("image_totals", f"WITH {MOLS_SQL} SELECT run_id, fov, z, CAST(count(*) AS DOUBLE) AS total FROM mols WHERE fov IS NOT NULL AND x >= 0 AND x < 2048 AND y >= 0 AND y < 2048 GROUP BY 1, 2, 3")
@query("run_image_totals", f"WITH {MOLS_SQL} SELECT run_id, fov, z, CAST(count(*) AS DOUBLE) AS total FROM mols WHERE fov IS NOT NULL AND x >= 0 AND x < 2048 AND y >= 0 AND y < 2048 GROUP BY 1, 2, 3")
def image_totals(spark: SparkSession, d: str) -> DataFrame:
    return _pixels(spark, d).groupBy(*_PLANE).agg(F.sum("v").alias("total"))


_HISTOGRAM = f"{_PIX} SELECT run_id, z, CAST(v AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS pixels FROM pix GROUP BY 1, 2, 3"


@query("image_pixel_histogram", _HISTOGRAM)
@query("run_image_pixel_histogram", _HISTOGRAM)
def image_pixel_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _pixels(spark, d).groupBy("run_id", "z", F.col("v").cast("bigint").alias("value")).agg(F.count(F.lit(1)).alias("pixels"))


_PROJECTION = f"{_PIX} SELECT run_id, fov, py, px, CAST(max(v) AS BIGINT) AS peak FROM pix GROUP BY 1, 2, 3, 4"


@query("image_z_projection", _PROJECTION)
@query("run_image_z_projection", _PROJECTION)
def image_z_projection(spark: SparkSession, d: str) -> DataFrame:
    """The brightest plane's count of every pixel of every run's tiles."""
    return _pixels(spark, d).groupBy(*_SITE, "py", "px").agg(F.max("v").cast("bigint").alias("peak"))


@query("image_frame_means", f"{_PIX}, n AS (SELECT run_id, fov, count(DISTINCT z) AS n FROM pix GROUP BY 1, 2) SELECT run_id, fov, py, px, round(sum(v) / max(n), 6) AS v FROM pix JOIN n USING (run_id, fov) GROUP BY 1, 2, 3, 4")
def image_frame_means(spark: SparkSession, d: str) -> DataFrame:
    return px.frame_means(_pixels(spark, d), _SITE, "z").withColumn("v", F.round("v", 6))


@query("image_blurred", f"{_PIX} SELECT run_id, fov, z, CAST(count(*) AS BIGINT) AS lit, round(sum(v * v), 5) AS energy FROM {_convolved('pix', _SOFT)} GROUP BY 1, 2, 3")
def image_blurred(spark: SparkSession, d: str) -> DataFrame:
    """Lit pixels and summed squares of the planes after a low pass."""
    soft = px.convolve(_pixels(spark, d), _PLANE, _SOFT, SIDE)
    return soft.groupBy(*_PLANE).agg(F.count(F.lit(1)).alias("lit"), F.round(F.sum(F.col("v") * F.col("v")), 5).alias("energy"))


_HIGH = f"{_PIX}, soft AS {_convolved('pix', _WIDE)}, high AS (SELECT {_AT}, round(pix.v - soft.v, {px.DIGITS}) AS v FROM pix JOIN soft USING ({_AT}) WHERE round(pix.v - soft.v, {px.DIGITS}) > 0)"


def _high(spark: SparkSession, d: str) -> DataFrame:
    return px.high_pass(_pixels(spark, d), _PLANE, _WIDE, SIDE)


@query("image_high_pass_seeds", f"{_HIGH} SELECT {_AT}, h FROM {_peaks('high', 2, 1.5)} WHERE least(py, px) >= 2 AND greatest(py, px) < {SIDE - 2}")
def image_high_pass_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Local maxima of the high-pass filtered planes, off the edges."""
    return px.maxima(_high(spark, d), _PLANE, 2, 1.5, SIDE, 2)


@query("image_seeds_without_hot", f"{_HIGH}, s AS {_peaks('high', 2, 0.5)} SELECT {_AT}, h FROM s JOIN (SELECT run_id, fov, py, px FROM s GROUP BY 1, 2, 3, 4 HAVING count(*) <= 2) USING (run_id, fov, py, px)")
def image_seeds_without_hot(spark: SparkSession, d: str) -> DataFrame:
    """Seeds without those whose place is one in more than two planes of the tile."""
    return px.without_hot(px.maxima(_high(spark, d), _PLANE, 2, 0.5, SIDE), _SITE, 2)


@query("image_bright_seeds", f"{_HIGH}, s AS {_peaks('high', 2, 0.5)}, m AS (SELECT run_id, fov, z, avg(h) AS m, stddev_pop(h) AS s FROM s GROUP BY 1, 2, 3) SELECT * FROM (SELECT {_AT}, h, round((h - m.m) / nullif(m.s, 0), 6) AS score FROM s JOIN m USING (run_id, fov, z)) WHERE score > 0.75")
def image_bright_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Seeds more than 0.75 deviations over the mean height of their plane's seeds."""
    return px.bright_scores(px.maxima(_high(spark, d), _PLANE, 2, 0.5, SIDE), _PLANE, 0.75)


_SPARSE = f"""{_PIX}, soft AS {_convolved('pix', _SOFT)}, s AS {_peaks('soft', 1, 0.3)},
k AS (SELECT run_id, fov, list_reduce(list([struct_pack(z := z, py := py, px := px, h := h)] ORDER BY h DESC, z, py, px), lambda kept, c: CASE WHEN len(list_filter(kept, lambda o: abs(o.py - c[1].py) <= 5 AND abs(o.px - c[1].px) <= 5)) = 0 THEN list_concat(kept, c) ELSE kept END) AS kept FROM s GROUP BY 1, 2)
SELECT run_id, fov, u.z AS z, u.py AS py, u.px AS px, u.h AS h FROM (SELECT run_id, fov, unnest(kept) AS u FROM k)"""


@query("image_sparse_seeds", _SPARSE)
def image_sparse_seeds(spark: SparkSession, d: str) -> DataFrame:
    """The brightest seeds of each tile that keep a distance of 5 pixels over all planes."""
    soft = px.convolve(_pixels(spark, d), _PLANE, _SOFT, SIDE)
    return px.suppress(px.maxima(soft, _PLANE, 1, 0.3, SIDE), _SITE, 5)


def _sharp_sql(rounds: int) -> str:
    made, now = _PIX, "pix"
    for i in range(rounds):
        made += f""", s{i} AS {_convolved(now, _SOFT)}, q{i} AS (SELECT {_AT}, round(pix.v / s{i}.v, {px.DIGITS}) AS v FROM pix JOIN s{i} USING ({_AT})), t{i} AS {_convolved(f'q{i}', _SOFT)},
e{i} AS (SELECT {_AT}, round({now}.v * t{i}.v, {px.DIGITS}) AS v FROM {now} JOIN t{i} USING ({_AT}))"""
        now = f"e{i}"
    return made + f", sharp AS (SELECT * FROM {now}), clip AS (SELECT {_AT}, least(v, top) AS v FROM sharp JOIN (SELECT run_id, fov, z, quantile_cont(v, 0.99) AS top FROM sharp GROUP BY 1, 2, 3) USING (run_id, fov, z))"


def _sharp(spark: SparkSession, d: str) -> DataFrame:
    return px.clip_high(px.deconvolve(_pixels(spark, d), _PLANE, _SOFT, SIDE, 2), _PLANE, 0.99)


@query("image_sharpened", f"{_sharp_sql(2)} SELECT {_AT}, round(v, 6) AS v FROM clip")
def image_sharpened(spark: SparkSession, d: str) -> DataFrame:
    """Deconvolved planes, held down to the 99th percentile of their lit pixels."""
    return _sharp(spark, d).withColumn("v", F.round("v", 6))


def _components(source: str, label: str | None) -> str:
    same = f" AND a.{label} = b.{label}" if label else ""
    return f""", lit AS (SELECT *, run_id || '/' || fov || '/' || z || '/' || py || '/' || px AS node FROM {source}),
e AS (SELECT a.node AS a, b.node AS b FROM lit a JOIN lit b ON a.run_id = b.run_id AND a.fov = b.fov AND a.z = b.z AND abs(a.py - b.py) + abs(a.px - b.px) = 1{same}),
r(node, root) AS (SELECT node, node FROM lit UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node), c AS (SELECT node, min(root) AS root FROM r GROUP BY node),
g AS (SELECT run_id, fov, z, {label + ', ' if label else ''}CAST(count(*) AS BIGINT) AS area, round(max(v), 6) AS peak, round(sum(v), 6) AS total, round(sum(py * v) / nullif(sum(v), 0), 6) AS y, round(sum(px * v) / nullif(sum(v), 0), 6) AS x,
 min(py) AS min_y, max(py) AS max_y, min(px) AS min_x, max(px) AS max_x FROM lit JOIN c USING (node) GROUP BY run_id, fov, z, {label + ', ' if label else ''}root)"""


@query("image_deconvolved_regions", f"{_sharp_sql(1)}, big AS (SELECT * FROM clip WHERE v >= 0.8){_components('big', None)} SELECT * FROM g")
def image_deconvolved_regions(spark: SparkSession, d: str) -> DataFrame:
    """Connected regions of the deconvolved, clipped planes."""
    sharp = px.clip_high(px.deconvolve(_pixels(spark, d), _PLANE, _SOFT, SIDE, 1), _PLANE, 0.99)
    return px.regions(sharp, _PLANE, 0.8)


_DECODED = f"""WITH RECURSIVE {MOLS_SQL}, n AS (SELECT run_id, fov, z, CAST(floor(y / 64) AS INTEGER) AS py, CAST(floor(x / 64) AS INTEGER) AS px, barcode_id, count(*) AS n, avg(CASE WHEN NOT isnan(magnitude) THEN magnitude END) AS v
 FROM mols WHERE fov IS NOT NULL AND x >= 0 AND x < 2048 AND y >= 0 AND y < 2048 GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(CASE WHEN NOT isnan(magnitude) THEN magnitude END) > 0),
dec AS (SELECT {_AT}, barcode_id, round(v, 6) AS v FROM (SELECT *, row_number() OVER (PARTITION BY {_AT} ORDER BY n DESC, barcode_id) AS k FROM n) WHERE k = 1)"""


@query("image_barcode_regions", f"{_DECODED}{_components('dec', 'barcode_id')} SELECT * FROM g")
def image_barcode_regions(spark: SparkSession, d: str) -> DataFrame:
    """Connected regions of pixels (of 64 camera pixels) with one barcode, the most frequent one of each pixel; v is its mean magnitude there."""
    at = lambda c: F.floor(F.col(c) / 64).cast("int")
    good = molecules(spark, d).filter("fov IS NOT NULL AND x >= 0 AND x < 2048 AND y >= 0 AND y < 2048")
    per = good.groupBy(*_PLANE, at("y").alias("py"), at("x").alias("px"), "barcode_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(~F.isnan("magnitude"), F.col("magnitude"))).alias("v")).filter("v IS NOT NULL")
    best = per.groupBy(*_PLANE, "py", "px").agg(F.max(F.struct("n", (-F.col("barcode_id")).alias("b"), "v")).alias("m"))
    decoded = best.select(*_PLANE, "py", "px", (-F.col("m.b")).alias("barcode_id"), F.round("m.v", 6).alias("v"))
    return px.regions(decoded, _PLANE, float("-inf"), "barcode_id")


_SHIFTS = f"""{_PIX}, f AS (SELECT pix.* FROM pix JOIN (SELECT run_id, fov, min(z) AS z FROM pix GROUP BY 1, 2) USING (run_id, fov, z)), k AS {_offsets(px.square(3))},
m AS (SELECT p.run_id, p.fov, p.z, k.dy, k.dx, round(sum(p.v * f.v), {px.DIGITS}) AS score FROM pix p CROSS JOIN k JOIN f ON f.run_id = p.run_id AND f.fov = p.fov AND f.py = p.py + k.dy AND f.px = p.px + k.dx GROUP BY 1, 2, 3, 4, 5),
b AS (SELECT *, row_number() OVER (PARTITION BY run_id, fov, z ORDER BY score DESC, dy * dy + dx * dx, dy, dx) AS r FROM m),
shift AS (SELECT run_id, fov, z, coalesce(dy, 0) AS dy, coalesce(dx, 0) AS dx, coalesce(score, 0.0) AS score FROM (SELECT DISTINCT run_id, fov, z FROM pix) LEFT JOIN (SELECT * FROM b WHERE r = 1) USING (run_id, fov, z)),
reg AS (SELECT run_id, fov, z, py + dy AS py, px + dx AS px, v FROM pix JOIN shift USING (run_id, fov, z) WHERE py + dy BETWEEN 0 AND {SIDE - 1} AND px + dx BETWEEN 0 AND {SIDE - 1})"""


def _shifts(spark: SparkSession, d: str) -> DataFrame:
    return px.shifts(_pixels(spark, d), _SITE, "z", 3, SIDE)


@query("image_shifts", f"{_SHIFTS} SELECT run_id, fov, z, CAST(dy AS INTEGER) AS dy, CAST(dx AS INTEGER) AS dx, score FROM shift")
def image_shifts(spark: SparkSession, d: str) -> DataFrame:
    """The shift of every plane to the lowest one of its tile, up to 3 pixels."""
    return _shifts(spark, d)


@query("image_registered", f"{_SHIFTS} SELECT run_id, fov, z, CAST(count(*) AS BIGINT) AS lit, sum(v) AS total, sum(v * py) AS y, sum(v * px) AS x FROM reg GROUP BY 1, 2, 3")
def image_registered(spark: SparkSession, d: str) -> DataFrame:
    """Lit pixels and first moments of the registered planes."""
    at = px.moved(_pixels(spark, d), _shifts(spark, d), _PLANE, SIDE)
    return at.groupBy(*_PLANE).agg(F.count(F.lit(1)).alias("lit"), F.sum("v").alias("total"), F.sum(F.col("v") * F.col("py")).alias("y"), F.sum(F.col("v") * F.col("px")).alias("x"))


def _trace_sql(name: str, window: list[tuple[int, int]]) -> str:
    n = float(len(window))
    return f"""{name} AS (SELECT s.run_id, s.fov, s.py, s.px, reg.z, round(sum(reg.v) / {n}, 6) AS mean, round(sqrt(greatest(sum(reg.v * reg.v) / {n} - sum(reg.v) / {n} * (sum(reg.v) / {n}), 0)), 6) AS sd
FROM spot s CROSS JOIN {_offsets(window)} k JOIN reg ON reg.run_id = s.run_id AND reg.fov = s.fov AND reg.py = s.py + k.dy AND reg.px = s.px + k.dx GROUP BY 1, 2, 3, 4, 5)"""


_SPOT = f"{_SHIFTS}, spot AS (SELECT run_id, fov, py, px FROM {_peaks('f', 2, 1.0)})"


def _spots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The seeds of the lowest plane of every tile, and the registered planes."""
    planes = _pixels(spark, d)
    lowest = planes.groupBy(*_SITE).agg(F.min("z").alias("z"))
    spots = px.maxima(planes.join(lowest, _PLANE), _PLANE, 2, 1.0, SIDE).select(*_SITE, "py", "px")
    return spots, px.moved(planes, px.shifts(planes, _SITE, "z", 3, SIDE), _PLANE, SIDE)


@query("image_spot_traces", f"{_SPOT}, {_trace_sql('t', px.square(1))} SELECT * FROM t")
def image_spot_traces(spark: SparkSession, d: str) -> DataFrame:
    """Mean intensities around the lowest plane's seeds in every registered plane."""
    return px.traces(*_spots(spark, d), _SITE, "z", px.square(1))


@query("image_spot_contrasts", f"{_SPOT}, {_trace_sql('t', px.ring(-1, 2))}, {_trace_sql('bg', px.ring(3, 6))} SELECT run_id, fov, py, px, z, t.mean, coalesce(bg.mean, 0) AS background, round((t.mean - coalesce(bg.mean, 0)) / nullif(bg.sd, 0), 4) AS score FROM t LEFT JOIN bg USING (run_id, fov, py, px, z)")
def image_spot_contrasts(spark: SparkSession, d: str) -> DataFrame:
    """Disc means around the seeds, the mean of the ring around them, and how many deviations of the ring lie between them."""
    spots, planes = _spots(spark, d)
    disc = px.traces(spots, planes, _SITE, "z", px.ring(-1, 2)).drop("sd")
    ring = px.traces(spots, planes, _SITE, "z", px.ring(3, 6)).withColumnRenamed("mean", "background")
    both = disc.join(ring, [*_SITE, "py", "px", "z"], "left").withColumn("background", F.coalesce("background", F.lit(0.0)))
    return both.withColumn("score", F.round(F.try_divide(F.col("mean") - F.col("background"), F.col("sd")), 4)).drop("sd")


@query("image_equalized_means", f"{_PIX}, h AS (SELECT run_id, fov, z, py // 8 AS a, px // 8 AS b, v, count(*) AS n FROM pix GROUP BY ALL), c AS (SELECT *, (64 - sum(n) OVER (PARTITION BY run_id, fov, z, a, b) + sum(n) OVER (PARTITION BY run_id, fov, z, a, b ORDER BY v)) / 64.0 AS s FROM h) SELECT run_id, fov, z, round(sum(s * n) / {SIDE * SIDE}, 6) AS mean, round(max(s), 6) AS top FROM c GROUP BY 1, 2, 3")
def image_equalized_means(spark: SparkSession, d: str) -> DataFrame:
    """The mean and the largest value of every plane after equalization by blocks of 8 x 8 pixels."""
    even = px.equalize(_pixels(spark, d), _PLANE, 8)
    return even.groupBy(*_PLANE).agg(F.round(F.sum("v") / (SIDE * SIDE), 6).alias("mean"), F.round(F.max("v"), 6).alias("top"))


@query(
    "image_spot_moments",
    f"""{_PIX}, soft AS {_convolved('pix', _SOFT)}, s AS {_peaks('soft', 2, 0.5)},
m AS (SELECT s.run_id, s.fov, s.z, s.py, s.px, sum(f.v) AS t, sum(f.py * f.v) / sum(f.v) AS y, sum(f.px * f.v) / sum(f.v) AS x, sum(f.py * f.py * f.v) / sum(f.v) AS qy, sum(f.px * f.px * f.v) / sum(f.v) AS qx
FROM s CROSS JOIN {_offsets(px.square(2))} k JOIN soft f ON f.run_id = s.run_id AND f.fov = s.fov AND f.z = s.z AND f.py = s.py + k.dy AND f.px = s.px + k.dx GROUP BY 1, 2, 3, 4, 5)
SELECT {_AT}, round(t, 6) AS total, round(y, 6) AS y, round(x, 6) AS x, round(greatest(qy - y * y, 0), 5) AS var_y, round(greatest(qx - x * x, 0), 5) AS var_x FROM m""",
)
def image_spot_moments(spark: SparkSession, d: str) -> DataFrame:
    """Moment fits of the seeds of the blurred planes."""
    soft = px.convolve(_pixels(spark, d), _PLANE, _SOFT, SIDE)
    return px.moments(soft, px.maxima(soft, _PLANE, 2, 0.5, SIDE), _PLANE, 2)


@query("image_oriented", f"{_PIX} SELECT run_id, fov, z, px AS py, {SIDE - 1} - py AS px, v FROM pix")
def image_oriented(spark: SparkSession, d: str) -> DataFrame:
    """Planes flipped up and down, then transposed."""
    return px.oriented(_pixels(spark, d), _PLANE, SIDE, True, False, True)


@query("image_scaled", f"{_PIX}, s AS (SELECT run_id, z, median(v) AS m FROM pix GROUP BY 1, 2) SELECT {_AT}, round(v / m, 6) AS v FROM pix JOIN s USING (run_id, z)")
def image_scaled(spark: SparkSession, d: str) -> DataFrame:
    """Pixels over the median lit pixel of their run and plane, counted from the values' histogram."""
    planes = _pixels(spark, d)
    factor = planes.groupBy("run_id", "z").agg(F.median("v").alias("m"))
    return planes.join(factor, ["run_id", "z"]).select(*_PLANE, "py", "px", F.round(F.try_divide("v", "m"), 6).alias("v"))
