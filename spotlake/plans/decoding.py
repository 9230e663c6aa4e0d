"""Queries: decoding of traces (embeddings are the traces, their labels the codes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.operators import decoding as de
from spotlake.plans import query
from spotlake.session import table

_BITS = 64
_CODES = """t AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS trace FROM embeddings),
e AS (SELECT vec_id, label, CAST(unnest(range(64)) AS INTEGER) AS bit, unnest(trace) AS value FROM t),
m AS (SELECT label, bit, avg(value) AS v FROM e GROUP BY 1, 2),
codes AS (SELECT label, list(v ORDER BY bit) AS code, list(CASE WHEN v > 0 THEN 1 ELSE 0 END ORDER BY bit) AS bits FROM m GROUP BY label)"""


def _traces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("trace"))


def _codes(spark: SparkSession, d: str) -> DataFrame:
    """label, code (mean trace) and bits (1 where it is above zero)."""
    mean = de.long_bits(_traces(spark, d), ["label"], "trace").groupBy("label", "bit").agg(F.avg("value").alias("v"))
    per = mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("bit", "v"))), lambda x: x["v"]).alias("code"))  # one entry a bit
    return per.withColumn("bits", F.transform("code", lambda v: F.when(v > 0, 1).otherwise(0)))


@query("trace_unit_norm", f"WITH {_CODES} SELECT vec_id, round(list_sum(list_transform(trace, lambda x: x / sqrt(list_sum(list_transform(trace, lambda y: y * y))))), 6) AS total FROM t")
def trace_unit_norm(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate(de.unit(F.col("trace")), F.lit(0.0), lambda a, x: a + x)
    return _traces(spark, d).select("vec_id", F.round(total, 6).alias("total"))


@query("trace_min_max", f"WITH {_CODES} SELECT vec_id, round(list_sum(list_transform(trace, lambda x: (x - list_min(trace)) / (list_max(trace) - list_min(trace)))), 6) AS total FROM t")
def trace_min_max(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate(de.min_max(F.col("trace")), F.lit(0.0), lambda a, x: a + x)
    return _traces(spark, d).select("vec_id", F.round(total, 6).alias("total"))


_DECODE = f"""WITH {_CODES}, u AS (SELECT vec_id, bit, value / sqrt(sum(value * value) OVER (PARTITION BY vec_id)) AS x FROM e), w AS (SELECT label, bit, v / sqrt(sum(v * v) OVER (PARTITION BY label)) AS y FROM m),
g AS (SELECT vec_id, label, round(sqrt(sum((x - y) * (x - y))), 6) AS dist FROM u JOIN w USING (bit) GROUP BY 1, 2), best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, label) AS k FROM g)"""


@query("decode_sql", _DECODE + " SELECT vec_id, label, dist FROM best WHERE k = 1")
def decode_sql(spark: SparkSession, d: str) -> DataFrame:
    return de.nearest_code_sql(_traces(spark, d).drop("label"), "vec_id", "trace", _codes(spark, d), "label", "code").withColumn("dist", F.round("dist", 6))


@query("decode_batches", _DECODE + " SELECT vec_id, CAST(label AS BIGINT) AS label, dist FROM best WHERE k = 1")
def decode_batches(spark: SparkSession, d: str) -> DataFrame:
    return de.nearest_code(_traces(spark, d).drop("label"), "vec_id", "trace", _codes(spark, d), "label", "code").withColumn("dist", F.round("dist", 6))


@query("decode_thresholded", _DECODE + " SELECT vec_id, CAST(CASE WHEN dist > 0.9 THEN -1 ELSE label END AS BIGINT) AS label FROM best WHERE k = 1")
def decode_thresholded(spark: SparkSession, d: str) -> DataFrame:
    return de.nearest_code(_traces(spark, d).drop("label"), "vec_id", "trace", _codes(spark, d), "label", "code", 0.9).select("vec_id", "label")


@query("trace_bit_quantiles", f"WITH {_CODES} SELECT bit, round(quantile_cont(value, 0.95), 6) AS scale, round(quantile_cont(value, 0.05), 6) AS background FROM e GROUP BY bit")
def trace_bit_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return de.bit_quantiles(_traces(spark, d), "trace").select("bit", F.round("scale", 6).alias("scale"), F.round("background", 6).alias("background"))


_QF = "q AS (SELECT bit, quantile_cont(value, 0.95) AS s, quantile_cont(value, 0.05) AS b FROM e GROUP BY bit)"


@query("trace_rescaled", f"WITH {_CODES}, {_QF} SELECT vec_id, round(sum((value - b) / s), 5) AS total FROM e JOIN q USING (bit) GROUP BY vec_id")
def trace_rescaled(spark: SparkSession, d: str) -> DataFrame:
    tr = _traces(spark, d)
    total = F.aggregate("trace", F.lit(0.0), lambda a, x: a + x)
    return de.rescale(tr, "vec_id", "trace", de.bit_quantiles(tr, "trace")).select("vec_id", F.round(total, 5).alias("total"))


_WITH_BITS = f"WITH {_CODES}, b AS (SELECT label, CAST(unnest(range(64)) AS INTEGER) AS bit, unnest(bits) AS on_bit FROM codes), u AS (SELECT vec_id, label, bit, value, value / sqrt(sum(value * value) OVER (PARTITION BY vec_id)) AS x FROM e)"


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).join(_codes(spark, d).select("label", "bits"), "label")


@query("trace_refactors", _WITH_BITS + ", p AS (SELECT bit, avg(mm) AS mm FROM (SELECT label, bit, avg(x) AS mm FROM u JOIN b USING (label, bit) WHERE on_bit = 1 GROUP BY 1, 2) GROUP BY bit) SELECT bit, round(mm / (SELECT avg(mm) FROM p), 6) AS refactor FROM p")
def trace_refactors(spark: SparkSession, d: str) -> DataFrame:
    return de.refactors(_labelled(spark, d), "label", "trace", "bits").withColumn("refactor", F.round("refactor", 6))


@query("trace_backgrounds", _WITH_BITS + " SELECT bit, round(sum(mm) / sum(n), 9) AS background FROM (SELECT label, bit, avg(value) AS mm, count(*) AS n FROM u JOIN b USING (label, bit) WHERE on_bit = 0 GROUP BY 1, 2) GROUP BY bit")
def trace_backgrounds(spark: SparkSession, d: str) -> DataFrame:
    return de.backgrounds(_labelled(spark, d), "label", "trace", "bits").withColumn("background", F.round("background", 9))


@query(
    "trace_features",
    _WITH_BITS
    + """ SELECT vec_id, max(value) AS high, min(value) AS low, round(max(value) - min(value), 6) AS spread, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, round(avg(value) FILTER (on_bit = 1), 6) AS on_mean,
round(avg(value) FILTER (on_bit = 0), 6) AS off_mean, round(coalesce(avg(value) FILTER (on_bit = 1) / nullif(avg(value) FILTER (on_bit = 0), 0), 0), 4) AS ratio FROM u JOIN b USING (label, bit) GROUP BY vec_id""",
)
def trace_features(spark: SparkSession, d: str) -> DataFrame:
    made = de.trace_features(_labelled(spark, d), "vec_id", "trace", "bits")
    return made.withColumns({c: F.round(c, 6) for c in ("spread", "mean", "sd", "on_mean", "off_mean")}).withColumn("ratio", F.round("ratio", 4))


@query("scale_optimization")
def scale_optimization(spark: SparkSession, d: str) -> DataFrame:
    """Scales of every bit after each of ten rounds of decoding."""
    return de.optimize_scales(_traces(spark, d).drop("label"), "vec_id", "trace", _codes(spark, d), "label", "bits", 10)


_KNN = f"""WITH {_CODES}, g AS (SELECT a.vec_id AS query, b.vec_id, round(sqrt(sum((a.value - b.value) * (a.value - b.value))), 9) AS dist FROM e a JOIN e b ON a.bit = b.bit WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, vec_id) AS k FROM g)"""


def _neighbours(spark: SparkSession, d: str) -> DataFrame:
    tr = _traces(spark, d)
    return de.knn(tr, "vec_id", "trace", tr.filter("vec_id % 20 = 0"), 10)


@query("trace_knn", _KNN + " SELECT query, vec_id, round(dist, 4) AS dist, CAST(k AS INTEGER) AS place FROM n WHERE k <= 10")
def trace_knn(spark: SparkSession, d: str) -> DataFrame:
    return _neighbours(spark, d).withColumn("dist", F.round("dist", 4))


@query("trace_imputed", _KNN + " SELECT query, bit, CASE WHEN avg(value) < 0.05 THEN 0.0 ELSE round(avg(value), 6) END AS mean FROM n JOIN e USING (vec_id) WHERE k <= 10 GROUP BY 1, 2")
def trace_imputed(spark: SparkSession, d: str) -> DataFrame:
    values = de.long_bits(_traces(spark, d), ["vec_id"], "trace")
    return de.impute(_neighbours(spark, d), values, "vec_id", "bit", "value", 0.05).withColumn("mean", F.round("mean", 6))
