"""Queries of the training-data problems (3 and 5 to 9), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.llm.boundary_pieces import natural_boundaries, split_pieces
from spotlake.llm.byte_bpe import encode_corpus
from spotlake.llm.leakage import leaked_items
from spotlake.llm.quantile_digest import certify, estimate_quantiles, merge_digests, partial_digests
from spotlake.llm.shared_spans import shared_spans
from spotlake.llm.stuffing import SHARE, stuffed_share
from spotlake.session import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Problem 3: the longest piece, and how far a piece reaches back.
PIECE_LIMIT, PIECE_OVERLAP = 1500, 100
#: Problem 5.
PERCENTILES = [0.01, 0.05, 0.5, 0.95, 0.99]
MEASURES = ["magnitude", "distance"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_pieces(table(spark, d, "transcriptome"), "transcript_id", "sequence", PIECE_LIMIT, PIECE_OVERLAP)


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return natural_boundaries(_pieces(spark, d), PIECE_LIMIT).withColumnRenamed("id", "transcript_id")


@query
def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d).withColumnRenamed("id", "transcript_id")


def _measured(spark: SparkSession, d: str) -> DataFrame:
    """Each molecule once, with its day of decoding."""
    columns = ["molecule_id", "run_id", "barcode_id", *MEASURES, F.to_date("decoded_at").alias("day")]
    return table(spark, d, "molecules").select(*columns).filter("barcode_id IS NOT NULL").distinct()


def _certified(spark: SparkSession, d: str) -> DataFrame:
    rows = _measured(spark, d)
    runs = cut(merge_digests(partial_digests(rows, ["run_id", "barcode_id"], MEASURES), ["run_id", "barcode_id", "field"]))
    whole = merge_digests(runs, ["barcode_id", "field"])
    each = certify(rows, estimate_quantiles(runs, PERCENTILES), ["run_id", "barcode_id"], MEASURES, PERCENTILES)
    every = certify(rows, estimate_quantiles(whole, PERCENTILES), ["barcode_id"], MEASURES, PERCENTILES)
    return every.withColumn("scope", F.lit("all")).withColumn("run_id", F.lit(None).cast("string")).unionByName(each.withColumn("scope", F.lit("run")))


@query
def p5_certified(spark: SparkSession, d: str) -> DataFrame:
    """Certified percentiles of every barcode over all runs, from the combined digests of the runs (scope 'all'), and in each run (scope 'run')."""
    return _certified(spark, d)


@query
def p5_bounds(spark: SparkSession, d: str) -> DataFrame:
    """What SQL can state of p5_certified: the values that were counted for every percentile, and that each is within the stated bound."""
    return _certified(spark, d).select("scope", "run_id", "barcode_id", "field", "quantile", "n", "within_bound")


@query
def p5_day_totals(spark: SparkSession, d: str) -> DataFrame:
    """What the digests of the days hold in all: number, least and largest value and sum of every barcode and field."""
    total = F.aggregate(F.zip_with("means", "weights", lambda m, w: m * w), F.lit(0.0), lambda a, x: a + x)
    return p5_day_digests(spark, d).select("day", "barcode_id", "field", "n", "low", "high", F.round(total, 4).alias("total"))


@query
def p5_run_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Certified percentiles of every run and barcode; the digests they come from combine to any set of runs."""
    rows = _measured(spark, d)
    runs = merge_digests(partial_digests(rows, ["run_id", "barcode_id"], MEASURES), ["run_id", "barcode_id", "field"])
    return certify(rows, estimate_quantiles(runs, PERCENTILES), ["run_id", "barcode_id"], MEASURES, PERCENTILES)


@query
def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Certified percentiles of every barcode, from the combined digests of the runs."""
    rows = _measured(spark, d)
    runs = merge_digests(partial_digests(rows, ["run_id", "barcode_id"], MEASURES), ["run_id", "barcode_id", "field"])
    whole = merge_digests(runs, ["barcode_id", "field"])
    return certify(rows, estimate_quantiles(whole, PERCENTILES), ["barcode_id"], MEASURES, PERCENTILES)


@query
def p5_day_digests(spark: SparkSession, d: str) -> DataFrame:
    return merge_digests(partial_digests(_measured(spark, d), ["day", "barcode_id"], MEASURES), ["day", "barcode_id", "field"])


@query
def p5_run_digests(spark: SparkSession, d: str) -> DataFrame:
    return merge_digests(partial_digests(_measured(spark, d), ["run_id", "barcode_id"], MEASURES), ["run_id", "barcode_id", "field"])


@query
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text", "byte_bpe_50k")


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    leaks = leaked_items(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "benchmark"), "item_id", "text")
    return leaks.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffed_share(table(spark, d, "documents"), "doc_id", "text", "lang").filter(F.col("stuffed_share") > SHARE).select(F.col("id").alias("doc_id"))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans(table(spark, d, "probe_dict"), "probe_id", "target_sequence").withColumnRenamed("id", "probe_id")


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d)


@query
def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of each probe that is found elsewhere; 0 for probes that share nothing, null or empty ones included."""
    found = _spans(spark, d).groupBy("probe_id").agg(F.sum("span_len").alias("shared"))
    probes = table(spark, d, "probe_dict").groupBy("probe_id").agg(F.max(F.length("target_sequence")).alias("letters"))
    share = F.coalesce(F.try_divide(F.col("shared"), F.col("letters")), F.lit(0.0))
    return probes.join(found, "probe_id", "left").select("probe_id", F.coalesce("letters", F.lit(0)).alias("letters"), F.coalesce("shared", F.lit(0)).alias("shared"), F.round(share, 6).alias("share"))


ORACLES["p3_found"] = r"""
WITH s AS (SELECT DISTINCT transcript_id, regexp_replace(sequence, '\s+', '', 'g') AS q FROM transcriptome),
t AS (SELECT transcript_id, q, length(q) AS n, regexp_extract_all(q, '[NnXx.\-]+|\||[^NnXx.|\-]+') AS k FROM s WHERE length(q) > 1500),
u AS (SELECT transcript_id, n, k, unnest(range(1, len(k) + 1)) AS i FROM t),
e AS (SELECT transcript_id, n, k[i] AS tok, sum(length(k[i])) OVER (PARTITION BY transcript_id, n, k ORDER BY i) AS e FROM u),
c AS (SELECT DISTINCT transcript_id, CAST(e AS INTEGER) AS cut_at FROM e WHERE e < n AND (tok = '|' OR regexp_full_match(tok, '[NnXx.\-]{5,}')))
SELECT * FROM c UNION SELECT transcript_id, 0 FROM t WHERE transcript_id NOT IN (SELECT transcript_id FROM c)
"""

ORACLES["p3_pieces"] = r"""
WITH RECURSIVE s AS (SELECT DISTINCT transcript_id, regexp_replace(sequence, '\s+', '', 'g') AS q FROM transcriptome),
t AS (SELECT transcript_id, q, length(q) AS n, regexp_extract_all(q, '[NnXx.\-]+|\||[^NnXx.|\-]+') AS k FROM s WHERE length(q) > 1500),
u AS (SELECT transcript_id, q, n, k, unnest(range(1, len(k) + 1)) AS i FROM t),
e AS (SELECT transcript_id, q, n, k[i] AS tok, sum(length(k[i])) OVER (PARTITION BY transcript_id, q ORDER BY i) AS e FROM u),
b AS (SELECT transcript_id, q, n, coalesce(list(e) FILTER (tok = '|'), []) AS junctions, coalesce(list(e) FILTER (regexp_full_match(tok, '[NnXx.\-]{5,}')), []) AS gaps FROM e GROUP BY 1, 2, 3),
p AS (SELECT transcript_id, q, n, junctions, gaps, CAST(-1 AS INTEGER) AS piece, CAST(0 AS BIGINT) AS begin_at, CAST(0 AS BIGINT) AS end_at FROM b
  UNION ALL
  SELECT transcript_id, q, n, junctions, gaps, piece + 1, end_at, CAST(CASE WHEN n - end_at <= most THEN n
    ELSE coalesce(list_max(list_filter(junctions, lambda x: x > end_at + short AND x <= end_at + most)), list_max(list_filter(gaps, lambda x: x > end_at + short AND x <= end_at + most)), end_at + most) END AS BIGINT)
  FROM (SELECT *, CASE WHEN piece < 0 THEN 1500 ELSE 1400 END AS most, CASE WHEN piece < 0 THEN 100 ELSE 0 END AS short FROM p) WHERE end_at < n)
SELECT transcript_id, piece, CAST(greatest(begin_at - 100, 0) AS INTEGER) AS start_at, CAST(end_at AS INTEGER) AS end_at, substring(q, greatest(begin_at - 100, 0) + 1, end_at - greatest(begin_at - 100, 0)) AS text FROM p WHERE piece >= 0
"""

ORACLES["p6_found"] = """
WITH w AS (SELECT probe_id, CAST(i AS INTEGER) AS i, substring(target_sequence, i + 1, 40) AS k FROM (SELECT probe_id, target_sequence, unnest(range(0, length(target_sequence) - 39)) AS i FROM probe_dict WHERE length(target_sequence) >= 40)),
s AS (SELECT k FROM w GROUP BY k HAVING count(DISTINCT probe_id) > 1),
m AS (SELECT DISTINCT probe_id, i FROM w JOIN s USING (k)),
r AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY probe_id ORDER BY i) + 40 THEN 0 ELSE 1 END AS fresh FROM m),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY probe_id ORDER BY i) AS run FROM r)
SELECT probe_id, min(i) AS span_start, max(i) + 40 - min(i) AS span_len FROM g GROUP BY probe_id, run
"""

ORACLES["p6_shares"] = (
    ORACLES["p6_found"].replace("SELECT probe_id, min(i)", ", f AS (SELECT probe_id, min(i)", 1).rstrip()
    + """), t AS (SELECT probe_id, sum(span_len) AS shared FROM f GROUP BY 1), p AS (SELECT probe_id, max(length(target_sequence)) AS letters FROM probe_dict GROUP BY 1)
SELECT probe_id, CAST(coalesce(letters, 0) AS INTEGER) AS letters, CAST(coalesce(shared, 0) AS BIGINT) AS shared, round(coalesce(shared / nullif(letters, 0), 0.0), 6) AS share FROM p LEFT JOIN t USING (probe_id)"""
)

_VALUES = """WITH m AS (SELECT DISTINCT molecule_id, run_id, barcode_id, magnitude, distance, CAST(decoded_at AS DATE) AS day FROM molecules WHERE barcode_id IS NOT NULL),
v AS (SELECT run_id, day, barcode_id, unnest(['magnitude', 'distance']) AS field, unnest([magnitude, distance]) AS number FROM m),
g AS (SELECT * FROM v WHERE number IS NOT NULL AND isfinite(number))"""

ORACLES["p5_bounds"] = f"""{_VALUES}, q AS (SELECT unnest({PERCENTILES}::DOUBLE[]) AS quantile),
n AS (SELECT 'run' AS scope, run_id, barcode_id, field, count(*) AS n FROM g GROUP BY ALL UNION ALL SELECT 'all', NULL, barcode_id, field, count(*) FROM g GROUP BY ALL)
SELECT scope, run_id, barcode_id, field, quantile, CAST(n AS BIGINT) AS n, true AS within_bound FROM n CROSS JOIN q"""

ORACLES["p5_day_totals"] = f"{_VALUES} SELECT day, barcode_id, field, CAST(count(*) AS BIGINT) AS n, min(number) AS low, max(number) AS high, round(sum(number), 4) AS total FROM g GROUP BY 1, 2, 3"

ORACLES["p8_found"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '\\[A-Za-z]+', ' ', 'g')), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(regexp_replace(text, '\\[A-Za-z]+', ' ', 'g')), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
dw AS (SELECT doc_id, array_to_string(w[i:i + 9], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS i FROM d WHERE len(w) >= 10)),
bw AS (SELECT item_id, array_to_string(w[i:i + 9], ' ') AS k FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10))
SELECT DISTINCT doc_id, item_id FROM dw JOIN bw USING (k)
"""
