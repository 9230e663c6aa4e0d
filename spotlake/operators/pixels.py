"""Image planes as rows of pixels: filters, maxima, regions, shifts and traces by joins and aggregates.

Pixel rows have the keys of their plane, py and px (whole numbers from 0 to side - 1) and v. A pixel without a row is 0, and so is everything outside.
Sums are rounded to DIGITS, so they don't depend on the order of addition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.graphs import components, keep_greedy

#: Decimal digits that sums keep.
DIGITS = 9

Kernel = list[tuple[int, int, float]]


def rasterize(points: DataFrame, keys: list[str], x: str, y: str, size: float, side: int) -> DataFrame:
    """keys, py, px, v: the number of points in each pixel of *size*; points off the plane and keys that are null are left out."""
    at = lambda c: F.floor(F.col(c) / size).cast("int")
    placed = points.select(*keys, at(y).alias("py"), at(x).alias("px")).dropna(subset=[*keys, "py", "px"])
    return placed.filter(f"py BETWEEN 0 AND {side - 1} AND px BETWEEN 0 AND {side - 1}").groupBy(*keys, "py", "px").agg(F.count(F.lit(1)).cast("double").alias("v"))


def square(reach: int) -> list[tuple[int, int]]:
    """Offsets (dy, dx) of a square window."""
    return [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)]


def ring(least: float, most: float) -> list[tuple[int, int]]:
    """Offsets whose distance from the middle is over *least* and at most *most*."""
    return [(dy, dx) for dy, dx in square(math.ceil(most)) if least < math.hypot(dy, dx) <= most]


def gaussian(sigma: float, reach: int) -> Kernel:
    """(dy, dx, weight) of a Gaussian over a square window, adding up to 1 (to DIGITS)."""
    raw = {(dy, dx): math.exp(-(dy * dy + dx * dx) / (2 * sigma * sigma)) for dy, dx in square(reach)}
    total = sum(raw.values())
    return [(dy, dx, round(w / total, DIGITS)) for (dy, dx), w in raw.items()]


def _offsets(kernel: list[tuple]) -> Column:
    return F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(k, ("dy", "dx", "w"))]) for k in kernel]))


def _sent(pixels: DataFrame, keys: list[str], kernel: list[tuple], side: int) -> DataFrame:
    """Each pixel once at every offset of the kernel that is on the plane: keys, py, px, _k, v and its own place _y0, _x0."""
    sent = pixels.select(*keys, F.col("py").alias("_y0"), F.col("px").alias("_x0"), "v", _offsets(kernel).alias("_k"))
    placed = sent.select(*keys, (F.col("_y0") + F.col("_k.dy")).alias("py"), (F.col("_x0") + F.col("_k.dx")).alias("px"), "_k", "v", "_y0", "_x0")
    return placed.filter(f"py BETWEEN 0 AND {side - 1} AND px BETWEEN 0 AND {side - 1}")


def convolve(pixels: DataFrame, keys: list[str], kernel: Kernel, side: int) -> DataFrame:
    """The weighted sum of the pixels around every pixel; one shuffle, combined on the map side."""
    return _sent(pixels, keys, kernel, side).groupBy(*keys, "py", "px").agg(F.round(F.sum(F.col("v") * F.col("_k.w")), DIGITS).alias("v"))


def high_pass(pixels: DataFrame, keys: list[str], kernel: Kernel, side: int) -> DataFrame:
    """What pixels have above the blurred plane; only pixels that are positive themselves can."""
    soft = convolve(pixels, keys, kernel, side).withColumnRenamed("v", "soft")
    return pixels.join(soft, [*keys, "py", "px"]).select(*keys, "py", "px", F.round(F.col("v") - F.col("soft"), DIGITS).alias("v")).filter("v > 0")


def deconvolve(pixels: DataFrame, keys: list[str], kernel: Kernel, side: int, rounds: int) -> DataFrame:
    """Richardson-Lucy rounds that start from the plane itself, so dark pixels stay dark and the rows stay as many."""
    at = [*keys, "py", "px"]
    now = pixels
    for _ in range(rounds):
        soft = convolve(now, keys, kernel, side).withColumnRenamed("v", "soft")
        ratio = pixels.join(soft, at).select(*at, F.round(F.try_divide("v", "soft"), DIGITS).alias("v"))
        turn = convolve(ratio, keys, kernel, side).withColumnRenamed("v", "turn")
        now = now.join(turn, at).select(*at, F.round(F.col("v") * F.col("turn"), DIGITS).alias("v"))
    return now


def clip_high(pixels: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Pixels held down to the quantile *share* of their plane's lit pixels."""
    top = pixels.groupBy(*keys).agg(F.percentile("v", F.lit(share)).alias("top"))
    return pixels.join(top, keys).select(*keys, "py", "px", F.least("v", "top").alias("v"))


def equalize(pixels: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Every lit pixel's share of the pixels of its block that aren't brighter, dark ones included."""
    home = [F.floor(F.col(c) / block).cast("int").alias(f"b{c}") for c in ("py", "px")]
    placed = pixels.select("*", *home)
    of = [*keys, "bpy", "bpx"]
    hist = placed.groupBy(*of, "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*of)
    share = (F.lit(block * block) - F.sum("n").over(w) + F.sum("n").over(w.orderBy("v"))) / (block * block)
    return placed.join(hist.select(*of, "v", share.alias("share")), [*of, "v"]).select(*keys, "py", "px", F.col("share").alias("v"))


def maxima(pixels: DataFrame, keys: list[str], reach: int, least: float, side: int, edge: int = 0) -> DataFrame:
    """keys, py, px, h: pixels of at least *least* with no larger one in the square window, nor an equal one above or left of them, and *edge* away from the borders."""
    sent = _sent(pixels.filter(F.col("v") >= least), keys, square(reach), side)
    own = F.max(F.when((F.col("_k.dy") == 0) & (F.col("_k.dx") == 0), F.col("v"))).alias("h")
    best = F.max(F.struct("v", (-F.col("_y0")).alias("y"), (-F.col("_x0")).alias("x"))).alias("best")
    found = sent.groupBy(*keys, "py", "px").agg(own, best).filter("h IS NOT NULL AND best.y = -py AND best.x = -px")
    return found.select(*keys, "py", "px", "h").filter(f"least(py, px) >= {edge} AND greatest(py, px) < {side - edge}")


def without_hot(seeds: DataFrame, site: list[str], most: int) -> DataFrame:
    """Seeds whose place is one in at most *most* planes of the site; more often it is a broken pixel of the camera."""
    often = seeds.groupBy(*site, "py", "px").agg(F.count(F.lit(1)).alias("_n"))
    return seeds.join(often, [*site, "py", "px"]).filter(F.col("_n") <= most).drop("_n")


def bright_scores(seeds: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Seeds whose height lies more than *least* standard deviations over the mean of their plane's seeds: their score is kept."""
    mean = seeds.groupBy(*keys).agg(F.avg("h").alias("_m"), F.stddev_pop("h").alias("_s"))
    return seeds.join(mean, keys).withColumn("score", F.round(F.try_divide(F.col("h") - F.col("_m"), F.col("_s")), 6)).filter(F.col("score") > least).drop("_m", "_s")


def suppress(seeds: DataFrame, site: list[str], radius: int) -> DataFrame:
    """The seeds that are left when the brightest of a site (then the lowest plane, row and column) is taken again and again and all others within *radius* rows and columns of it go.

    Seeds stand in grid cells of the radius; pairs in neighbouring cells are edges, and keep_greedy() decides in rounds what the walk in order decides.
    """
    named = seeds.withColumn("id", F.concat_ws("/", *site, "z", "py", "px")).withColumn("rank", F.struct("h", (-F.col("z")).alias("z"), (-F.col("py")).alias("y"), (-F.col("px")).alias("x")))
    cell = lambda c: F.floor(F.col(c) / radius).cast("int")
    own = named.select(*site, F.col("id").alias("a"), "py", "px", cell("py").alias("cy"), cell("px").alias("cx"))
    near = own.select(*site, F.col("a").alias("b"), F.col("py").alias("y"), F.col("px").alias("x"), F.explode(F.sequence(F.col("cy") - 1, F.col("cy") + 1)).alias("cy"), "cx").select(
        *site, "b", "y", "x", "cy", F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1)).alias("cx")
    )
    edges = own.join(near, [*site, "cy", "cx"]).filter((F.col("a") < F.col("b")) & (F.abs(F.col("py") - F.col("y")) <= radius) & (F.abs(F.col("px") - F.col("x")) <= radius)).select("a", "b")
    return named.join(keep_greedy(named.select("id", "rank"), edges), "id", "left_semi").drop("id", "rank")


def regions(pixels: DataFrame, keys: list[str], least: float, label: str | None = None) -> DataFrame:
    """One row for each connected region (by sides) of pixels of at least *least*, and of one *label* if that is given: keys, label, area, peak, total, y, x (its weighted middle) and its box."""
    same = [*keys, *([label] if label else [])]
    lit = pixels.filter(F.col("v") >= least).withColumn("node", F.concat_ws("/", *keys, "py", "px"))
    ahead = lit.select(*same, F.col("node").alias("a"), F.explode(F.array(*[F.struct((F.col("py") + dy).alias("py"), (F.col("px") + dx).alias("px")) for dy, dx in ((0, 1), (1, 0))])).alias("to"))
    edges = ahead.select(*same, "a", "to.py", "to.px").join(lit.select(*same, F.col("node").alias("b"), "py", "px"), [*same, "py", "px"]).select("a", "b")
    member = lit.join(components(edges), "node", "left").withColumn("region", F.coalesce("component", "node"))
    middle = lambda c: F.round(F.try_divide(F.sum(F.col(c) * F.col("v")), F.sum("v")), 6)
    box = [f(c).alias(f"{n}_{c[1]}") for n, f in (("min", F.min), ("max", F.max)) for c in ("py", "px")]
    return member.groupBy(*same, "region").agg(F.count(F.lit(1)).alias("area"), F.round(F.max("v"), 6).alias("peak"), F.round(F.sum("v"), 6).alias("total"), middle("py").alias("y"), middle("px").alias("x"), *box).drop("region")


def shifts(pixels: DataFrame, site: list[str], plane: str, reach: int, side: int) -> DataFrame:
    """site, plane, dy, dx, score: the shift of every plane to the lowest one of its site that makes the sum of products largest (the least shift of ties, 0 where nothing meets)."""
    planes = pixels.select(*site, plane).distinct()
    first = planes.groupBy(*site).agg(F.min(plane).alias(plane))
    fixed = _sent(pixels.join(first, [*site, plane]).drop(plane), site, square(reach), side)
    met = pixels.join(fixed.select(*site, "py", "px", F.col("v").alias("_w"), "_k"), [*site, "py", "px"])
    # the fixed pixel lies at the moving one less the offset
    score = met.groupBy(*site, plane, (-F.col("_k.dy")).alias("dy"), (-F.col("_k.dx")).alias("dx")).agg(F.round(F.sum(F.col("v") * F.col("_w")), DIGITS).alias("score"))
    far = F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    best = score.groupBy(*site, plane).agg(F.max(F.struct("score", (-far).alias("near"), (-F.col("dy")).alias("y"), (-F.col("dx")).alias("x"))).alias("m"))
    found = best.select(*site, plane, (-F.col("m.y")).alias("dy"), (-F.col("m.x")).alias("dx"), "m.score")
    return planes.join(found, [*site, plane], "left").select(*site, plane, F.coalesce("dy", F.lit(0)).alias("dy"), F.coalesce("dx", F.lit(0)).alias("dx"), F.coalesce("score", F.lit(0.0)).alias("score"))


def moved(pixels: DataFrame, by: DataFrame, keys: list[str], side: int) -> DataFrame:
    """Pixels moved by their plane's dy and dx; what leaves the plane is lost."""
    at = pixels.join(by.select(*keys, "dy", "dx"), keys).select(*keys, (F.col("py") + F.col("dy")).alias("py"), (F.col("px") + F.col("dx")).alias("px"), "v")
    return at.filter(f"py BETWEEN 0 AND {side - 1} AND px BETWEEN 0 AND {side - 1}")


def oriented(pixels: DataFrame, keys: list[str], side: int, flip_y: bool, flip_x: bool, transpose: bool) -> DataFrame:
    """Planes flipped, then transposed, as the microscope's description says."""
    y = side - 1 - F.col("py") if flip_y else F.col("py")
    x = side - 1 - F.col("px") if flip_x else F.col("px")
    return pixels.select(*keys, *((x.alias("py"), y.alias("px")) if transpose else (y.alias("py"), x.alias("px"))), "v")


def frame_means(pixels: DataFrame, site: list[str], plane: str) -> DataFrame:
    """The mean of every pixel over the planes of its site, dark ones included."""
    planes = pixels.select(*site, plane).distinct().groupBy(*site).agg(F.count(F.lit(1)).alias("_n"))
    return pixels.groupBy(*site, "py", "px").agg(F.sum("v").alias("_s")).join(planes, site).select(*site, "py", "px", (F.col("_s") / F.col("_n")).alias("v"))


def traces(spots: DataFrame, pixels: DataFrame, site: list[str], plane: str, window: list[tuple[int, int]]) -> DataFrame:
    """site, py, px, plane, mean, sd: of the window around every spot in every plane that is lit in it, dark pixels included."""
    around = spots.select(*site, "py", "px", _offsets([(dy, dx, 1) for dy, dx in window]).alias("_k")).select(*site, "py", "px", (F.col("py") + F.col("_k.dy")).alias("y"), (F.col("px") + F.col("_k.dx")).alias("x"))
    met = around.join(pixels.select(*site, plane, F.col("py").alias("y"), F.col("px").alias("x"), "v"), [*site, "y", "x"])
    n = float(len(window))
    made = met.groupBy(*site, "py", "px", plane).agg((F.sum("v") / n).alias("m"), (F.sum(F.col("v") * F.col("v")) / n).alias("q"))
    return made.select(*site, "py", "px", plane, F.round("m", 6).alias("mean"), F.round(F.sqrt(F.greatest(F.col("q") - F.col("m") * F.col("m"), F.lit(0.0))), 6).alias("sd"))


def moments(pixels: DataFrame, seeds: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Of the window around every seed: total, weighted middle and spread in either direction."""
    around = seeds.select(*keys, "py", "px", _offsets([(dy, dx, 1) for dy, dx in square(reach)]).alias("_k")).select(*keys, "py", "px", (F.col("py") + F.col("_k.dy")).alias("y"), (F.col("px") + F.col("_k.dx")).alias("x"))
    met = around.join(pixels.select(*keys, F.col("py").alias("y"), F.col("px").alias("x"), "v"), [*keys, "y", "x"])
    v, mean = F.col("v"), lambda c: F.sum(F.col(c) * F.col("v")) / F.sum("v")
    made = met.groupBy(*keys, "py", "px").agg(F.sum(v).alias("total"), mean("y").alias("my"), mean("x").alias("mx"), (F.sum(F.col("y") * F.col("y") * v) / F.sum(v)).alias("qy"), (F.sum(F.col("x") * F.col("x") * v) / F.sum(v)).alias("qx"))
    var = lambda q, m: F.round(F.greatest(F.col(q) - F.col(m) * F.col(m), F.lit(0.0)), 5)
    return made.select(*keys, "py", "px", F.round("total", 6).alias("total"), F.round("my", 6).alias("y"), F.round("mx", 6).alias("x"), var("qy", "my").alias("var_y"), var("qx", "mx").alias("var_x"))
