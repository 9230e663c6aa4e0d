"""Models and assignments: quality by boosted trees, reduction, clusters, codeword choices, fits of positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.operators.folds import Step, keep_in_order
from spotlake.operators.graphs import components
from spotlake.session import cut

#: Rows of either class that a classifier is fitted on, about; all rows are rated.
TRAINING_ROWS = 20_000


def predict_quality(molecules: DataFrame, id_column: str, label: str, features: list[str], rounds: int = 5, depth: int = 4) -> DataFrame:
    """id and quality, the probability of a blank (low is good), by boosted trees fitted on a balanced sample of at most TRAINING_ROWS a class or so.

    The sample is taken by a hash of the id, so it is the same whatever the partitions. Null and NaN features count as 0.
    """
    plain = molecules.select(id_column, F.col(label).cast("double").alias("label"), *[F.coalesce(F.when(~F.isnan(f), F.col(f).cast("double")), F.lit(0.0)).alias(f) for f in features])
    made = VectorAssembler(inputCols=features, outputCol="features").transform(plain)
    sizes = {r["label"]: r["n"] for r in plain.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    least = min([TRAINING_ROWS, *sizes.values()])
    share = F.lit(0.0)
    for k, n in sizes.items():
        share = F.when(F.col("label") == k, F.lit(least / n)).otherwise(share)
    sample = made.filter(F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) < share * 1_000_000)
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=1).fit(cut(sample.select("label", "features")))
    return model.transform(made).select(id_column, vector_to_array("probability")[1].alias("quality"))


def reduce_dimensions(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """key and the first *k* principal components of array columns; a component's sign makes its largest loading positive."""
    made = df.select(key, array_to_vector(vector).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="reduced").fit(made)
    loadings = model.pc.toArray()
    signs = F.array(*[F.lit(float(np.sign(c[np.abs(c).argmax()]) or 1.0)) for c in loadings.T])
    out = model.transform(made).select(key, vector_to_array("reduced").alias("r"))
    return out.select(key, F.zip_with("r", signs, lambda a, b: a * b).alias("components"))


def single_linkage(pairs: DataFrame, items: DataFrame, distance: str, most: float) -> DataFrame:
    """item, cluster (its least item): the flat cut of single linkage at *most* is the components of the pairs that close."""
    found = components(pairs.filter(F.col(distance) <= most).select("a", "b"))
    return items.join(found, items["item"] == found["node"], "left").select("item", F.coalesce("component", "item").alias("cluster"))


def propagate_labels(edges: DataFrame, rounds: int = 4) -> DataFrame:
    """node, label: every node starts with its own label and takes, round after round, the most frequent one of its neighbours and itself (the least of ties)."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    for _ in range(rounds):
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label").unionByName(labels)
        votes = heard.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
        labels = cut(votes.groupBy("node").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("m")).select("node", (-F.col("m.l")).alias("label")))
    return labels


def distant_codes(least: int) -> Step:
    """Keep a code if it differs from every kept one in at least *least* bits; the state is bounded by the codebook."""

    def step(kept: list | None, rows: pd.DataFrame) -> tuple[list, np.ndarray]:
        kept = kept or []
        mask = np.zeros(len(rows), bool)
        for i, code in enumerate(rows["code"].tolist()):
            if all((code ^ k).bit_count() >= least for k in kept):
                mask[i] = True
                kept.append(code)
        return kept, mask

    return step


def choose_codes(codebook: DataFrame, least: int) -> DataFrame:
    """The codes kept by walking the codebook in order with distant_codes()."""
    return keep_in_order(codebook.select(F.lit(0).alias("_k"), "barcode_id", "name", "code"), ["_k"], ["barcode_id"], distant_codes(least)).drop("_k")


def assign_codes(genes: DataFrame, gene: str, codes: DataFrame, seed: int) -> DataFrame:
    """gene, barcode_id: codes in the order of md5(seed, barcode_id) to genes by name; codes left over are named Blank-1, Blank-2, ..."""
    place = F.row_number().over(Window.orderBy(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("barcode_id").cast("string")))))
    drawn = codes.select("barcode_id", place.alias("_n"))  # a codebook is bounded by the chemistry
    named = genes.select(F.col(gene).alias("gene")).distinct().select("gene", F.row_number().over(Window.orderBy("gene")).alias("_n"))
    blank = F.row_number().over(Window.partitionBy(F.col("gene").isNull()).orderBy("_n"))
    return drawn.join(named, "_n", "left").select("barcode_id", F.coalesce("gene", F.concat(F.lit("Blank-"), blank.cast("string"))).alias("gene"))


def single_bit_errors(codebook: DataFrame, bits: int) -> DataFrame:
    """barcode_id, bit (-1 for none), code: every code and its neighbours with one bit flipped."""
    flip = F.explode(F.sequence(F.lit(-1), F.lit(bits - 1))).alias("bit")
    return codebook.select("barcode_id", "code", flip).select("barcode_id", "bit", F.when(F.col("bit") < 0, F.col("code")).otherwise(F.expr("code ^ shiftleft(cast(1 as bigint), greatest(bit, 0))")).alias("code"))


def fit_rotation(df: DataFrame, key: str | list[str], x: str, y: str, u: str, v: str) -> DataFrame:
    """key, n, angle, tx, ty: the rotation and shift that best move (x, y) onto (u, v), from combined sums."""
    good = df.filter(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in (x, y, u, v)))
    n, keys = F.count(F.lit(1)), [key] if isinstance(key, str) else key
    s = good.groupBy(*keys).agg(n.alias("n"), *[F.avg(c).alias(f"m{c}") for c in (x, y, u, v)], *[F.covar_pop(a, b).alias(f"c{a}{b}") for a, b in ((x, u), (y, v), (x, v), (y, u))])
    turned = s.withColumn("angle", F.atan2(F.col(f"c{x}{v}") - F.col(f"c{y}{u}"), F.col(f"c{x}{u}") + F.col(f"c{y}{v}")))
    cos, sin = F.cos("angle"), F.sin("angle")
    return turned.select(*keys, "n", "angle", (F.col(f"m{u}") - cos * F.col(f"m{x}") + sin * F.col(f"m{y}")).alias("tx"), (F.col(f"m{v}") - sin * F.col(f"m{x}") - cos * F.col(f"m{y}")).alias("ty"))


def label_overlaps(pixels: DataFrame, step: float, least: float) -> DataFrame:
    """label, z, other: for each label of a plane its best match in the plane *step* above, by f0 + f1 of the shares of common pixels, both over *least* (the least label of ties).

    pixels: label, z, place (any pixel key), without repeats. Planes are counted in steps of *step* from 0, so there may be any number of them.
    """
    placed = pixels.filter("z IS NOT NULL AND NOT isnan(z)").withColumn("_p", F.round(F.col("z") / step).cast("bigint"))
    size = placed.groupBy("label", "_p").agg(F.count(F.lit(1)).alias("size"))
    up = placed.select(F.col("label").alias("other"), (F.col("_p") - 1).alias("_p"), "place")
    common = placed.join(up, ["_p", "place"]).groupBy("label", "_p", "z", "other").agg(F.count(F.lit(1)).alias("both"))
    other = size.select(F.col("label").alias("other"), (F.col("_p") - 1).alias("_p"), F.col("size").alias("other_size"))
    rated = common.join(size, ["label", "_p"]).join(other, ["other", "_p"]).withColumn("f0", F.col("both") / F.col("size")).withColumn("f1", F.col("both") / F.col("other_size"))
    best = rated.filter((F.col("f0") > least) & (F.col("f1") > least)).groupBy("label", "z").agg(F.min(F.struct((-F.round(F.col("f0") + F.col("f1"), 9)).alias("s"), "other")).alias("m"))
    return best.select("label", "z", "m.other")


def cdf_scale(df: DataFrame, key: str, value: Column, share: float = 0.9, add: int = 2) -> DataFrame:
    """key, scale: the whole number at which the cumulative share of values is closest to *share* (the least of ties), plus *add*. Values are counted first."""
    hist = df.select(key, F.floor(value).cast("bigint").alias("v")).filter("v IS NOT NULL").groupBy(key, "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    cdf = hist.withColumn("gap", F.round(F.abs(F.sum("n").over(w.orderBy("v")) / F.sum("n").over(w) - share), 12))
    return cdf.groupBy(key).agg((F.min(F.struct("gap", "v"))["v"] + add).alias("scale"))
