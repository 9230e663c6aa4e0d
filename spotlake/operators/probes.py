"""Probe design: windows, k-mer tables, scores, selection and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.functions.sequences import gc_share, kmers, melting_temperature, revcomp
from spotlake.operators.folds import keep_in_order, no_overlap
from spotlake.operators.ranking import row_numbers
from spotlake.session import measured

#: Letters of a stretch whose windows are cut out together; substring walks a text from its start, so stretches keep it short.
STRETCH = 256
#: Codes up to which a codebook is broadcast for its pairs.
MOST_CODES = 10_000


def windows(df: DataFrame, sequence: str, length: int, step: int = 1, *keep: str, spread: bool = False) -> DataFrame:
    """Windows of *length* letters every *step* letters: the kept columns, shift (their start) and target. Shorter sequences give none.

    With *spread*, the stretches are shuffled (about the text once) before the windows (many times the text) are cut from them,
    so a few very long sequences or files don't bear the work alone.
    """
    stride = max(1, STRETCH // step) * step
    last = F.length(sequence) - length
    cut = df.filter(last >= 0).select(*keep, F.col(sequence).alias("_s"), F.explode(F.sequence(F.lit(0), F.length(sequence) - length, F.lit(stride))).alias("_at"))
    part = cut.select(*keep, "_at", F.substring(F.col("_s"), F.col("_at") + 1, F.lit(stride - step + length)).alias("_p"))
    if spread:
        part = part.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_p")
    each = part.select(*keep, "_at", "_p", F.explode(F.sequence(F.lit(0), F.length("_p") - length, F.lit(step))).alias("_i"))
    return each.select(*keep, (F.col("_at") + F.col("_i")).alias("shift"), F.substring(F.col("_p"), F.col("_i") + 1, F.lit(length)).alias("target"))


def kmer_sums(df: DataFrame, sequence: str, k: int, weight: Column | None = None) -> DataFrame:
    """kmer (plain letters only) and hits: the number of its occurrences, or the sum of *weight*.

    Other letters are masked once for each sequence, not for each k-mer; occurrences are combined on the map side, so repeats don't
    weigh on a task.
    """
    masked = df.select(F.regexp_replace(F.upper(F.col(sequence)), "[^ACGT]", "N").alias("_s"), (F.lit(1).cast("bigint") if weight is None else weight).alias("_w"))
    each = windows(masked, "_s", k, 1, "_w", spread=True).filter(~F.contains("target", F.lit("N")))
    return each.groupBy(F.col("target").alias("kmer")).agg(F.sum("_w").alias("hits"))


def kmer_table(df: DataFrame, sequence: str, k: int, weight: Column | None = None, limit: int | None = None) -> DataFrame:
    """code (packed k-mer) and hits, at most *limit*."""
    hits = F.col("hits")
    return kmer_sums(df, sequence, k, weight).select(F.conv(F.translate("kmer", "ACGT", "0123"), 4, 10).cast("bigint").alias("code"), (hits if limit is None else F.least(hits, F.lit(limit))).alias("hits"))


def kmer_hits(probes: DataFrame, key: str, sequence: str, sums: DataFrame, k: int, both_strands: bool = False, step: int = 1) -> DataFrame:
    """key, n_kmers and hits: the sum of kmer_sums() over the k-mers of the sequence, optionally of both strands; -1 for too short sequences."""
    strands = [F.explode_outer(kmers(F.col(sequence), k, step))] + ([F.explode_outer(F.transform(kmers(F.col(sequence), k, step), revcomp))] if both_strands else [])
    each = None
    for e in strands:
        one = probes.select(F.col(key), e.alias("kmer"))
        each = one if each is None else each.unionByName(one)
    # equal k-mers of a probe are counted once before the join
    counted = each.groupBy(key, "kmer").agg(F.count("kmer").alias("times"))
    joined = counted.join(sums, "kmer", "left")
    n = F.sum("times")
    return joined.groupBy(key).agg(n.alias("n_kmers"), F.when(n == 0, F.lit(-1)).otherwise(F.sum(F.coalesce("hits", F.lit(0)) * F.col("times"))).alias("hits"))


def filter_probes(df: DataFrame, sequence: str, gc: tuple[float, float], tm: tuple[float, float]) -> DataFrame:
    """Probes with their gc share and tm, both in range (ends included)."""
    rated = df.withColumn("gc", gc_share(F.col(sequence))).withColumn("tm", melting_temperature(F.col(sequence)))
    return rated.filter(F.col("gc").between(*gc) & F.col("tm").between(*tm))


def select_no_overlap(df: DataFrame, keys: list[str], start: str, sequence: str, tie: str) -> DataFrame:
    """Per key, the probes that greedy interval scheduling by *start* keeps (ties by *tie*)."""
    return keep_in_order(df.filter(F.col(start).isNotNull()), keys, [start, tie], no_overlap(start, lambda rows: rows[sequence].str.len().to_numpy()))


def largest_gaps(df: DataFrame, key: str, start: str, most: int) -> DataFrame:
    """Per key, the *most* probes with the largest distance from the one before (the first has the largest)."""
    before = F.lag(start).over(Window.partitionBy(key).orderBy(start))
    gapped = df.withColumn("gap", F.coalesce(F.col(start) - before, F.lit(float("inf"))))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("gap"), start))
    return gapped.withColumn("_n", place).filter(F.col("_n") <= most).drop("_n")


def best_split(df: DataFrame, key: str, sequence: str, reach: int = 3, most: float = 5.0) -> DataFrame:
    """The split of a target into two arms within *reach* letters of its middle whose melting temperatures are closest.

    split is -1 where the arms differ by more than *most* everywhere. Ties go to the split nearest the middle, then the left one.
    """
    middle = F.floor(F.length(sequence) / 2).cast("int")
    each = df.select(key, F.col(sequence).alias("_s"), middle.alias("_m"), F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("_o")).filter("_m + _o > 1 AND length(_s) - _m - _o > 1")
    at = F.col("_m") + F.col("_o")
    left, right = F.substring(F.col("_s"), F.lit(1), at), F.substring(F.col("_s"), at + 1, F.length("_s") - at)
    diff = F.round(F.abs(melting_temperature(left) - melting_temperature(right)), 6)
    best = each.select(key, at.alias("at"), F.col("_o"), diff.alias("diff")).groupBy(key).agg(F.min(F.struct("diff", F.abs("_o").alias("far"), "at")).alias("b"))
    return best.select(key, F.when(F.col("b.diff") <= most, F.col("b.at")).otherwise(-1).alias("split"), F.col("b.diff").alias("tm_diff"))


def assemble(sequence: Column, bits: list[Column], forward: Column, reverse: Column, spacer: str = "A") -> Column:
    """primer + readouts, the reverse complement of the target between them + primer."""
    half = len(bits) // 2
    return F.concat(forward, *[F.concat(b, F.lit(spacer)) for b in bits[:half]], revcomp(sequence), *[F.concat(F.lit(spacer), b) for b in bits[half:]], reverse)


def plate_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """plate (from 0) and well of each row, filling plates of 96 wells row by row in *order* (which must be unique)."""
    n = row_numbers(df, [], order, "_n")
    well = F.concat(F.chr(F.lit(65) + ((F.col("_n") % 96) / 12).cast("int")), (F.col("_n") % 12 + 1).cast("string"))
    return n.withColumn("plate", F.floor(F.col("_n") / 96).cast("int")).withColumn("well", well).drop("_n")


def transcript_of_gene(df: DataFrame, which: str) -> DataFrame:
    """One transcript for each gene: the 'shortest' (first id of ties), the 'longest' (last id) or that of 'median' length (last id; none if no transcript has it)."""
    sized = df.select("gene_id", "transcript_id", F.length("seq").alias("n")).filter("n IS NOT NULL")
    if which == "shortest":
        one = sized.groupBy("gene_id").agg(F.min(F.struct("n", "transcript_id")).alias("t"))
    elif which == "longest":
        one = sized.groupBy("gene_id").agg(F.max(F.struct("n", "transcript_id")).alias("t"))
    elif which == "median":
        middle = sized.groupBy("gene_id").agg(F.median("n").alias("m"))
        one = sized.join(middle, "gene_id").filter("n = m").groupBy("gene_id").agg(F.max(F.struct("n", "transcript_id")).alias("t"))
    else:
        raise ValueError(f"unknown choice {which}")
    return one.select("gene_id", "t.transcript_id", F.col("t.n").alias("n"))


def hamming_pairs(codebook: DataFrame) -> DataFrame:
    """Bits in which every two codes differ: a, b (a < b), distance. A codebook is fixed by the chemistry; every pair of it is the result, and it is broadcast up to MOST_CODES codes."""
    a = codebook.select(F.col("barcode_id").alias("a"), F.col("code").alias("ca"))
    b = codebook.select(F.col("barcode_id").alias("b"), F.col("code").alias("cb"))
    return a.join(measured(b, MOST_CODES), F.col("a") < F.col("b")).select("a", "b", F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))).alias("distance"))
