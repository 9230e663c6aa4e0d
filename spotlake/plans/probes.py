"""Queries: sequences and probe design."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.functions import sequences as sq
from spotlake.operators import probes as pb
from spotlake.plans import query
from spotlake.session import table
from spotlake.sources.views import CODES_SQL, PROBES_SQL, TRANSCRIPTS_SQL, codebook, probes, transcripts

_P, _T = f"WITH {PROBES_SQL}", f"WITH {TRANSCRIPTS_SQL}"
#: Recognition sites to avoid.
SITES = ["GAATTC", "GGATCC", "GGTCTC"]
FORWARD, REVERSE = "CGGTCTCGATCC", "TTGCGAGCTAGC"


def _rc(s: str) -> str:
    return f"translate(reverse({s}), '{sq.LETTERS}', '{sq.COMPLEMENTS}')"


def _tm(s: str, na: float = 0.33) -> str:
    maps = ["MAP {" + ", ".join(f"'{k}': {v[i]}" for k, v in sq.NEIGHBOURS.items()) + "}" for i in (0, 1)]
    ends = ["+".join(f"(CASE WHEN {e} IN ('A', 'T') THEN {sq.END_AT[i]} ELSE {sq.END_GC[i]} END)" for e in (f"substring({s}, 1, 1)", f"right({s}, 1)")) for i in (0, 1)]
    total = [f"(list_sum(list_transform(range(1, length({s})), lambda i: CAST({maps[i]}[substring({s}, i, 2)] AS DOUBLE))) + {ends[i]})" for i in (0, 1)]
    return f"(1000 * {total[0]} / ({total[1]} + 0.368 * (length({s}) - 1) * ln({na}) + {sq.GAS} * ln(12.5 * 1e-9)) - 273.15)"


@query("seq_revcomp", f"{_P} SELECT probe_id, {_rc('seq')} AS rc FROM probe")
def seq_revcomp(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", sq.revcomp(F.col("seq")).alias("rc"))


@query("seq_gc", f"{_P} SELECT probe_id, round((length(seq) - length(regexp_replace(seq, '[GC]', '', 'g'))) / length(seq), 9) AS gc FROM probe")
def seq_gc(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", F.round(sq.gc_share(F.col("seq")), 9).alias("gc"))


@query("seq_tm", f"{_P} SELECT probe_id, round({_tm('seq')}, 6) AS tm FROM probe")
def seq_tm(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", F.round(sq.melting_temperature(F.col("seq")), 6).alias("tm"))


def _packed(s: str, alphabet: str, base: int) -> str:
    return f"CAST(list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), lambda c: CAST(strpos('{alphabet}', c) - {1 if base == 4 else 0} AS BIGINT))), lambda a, b: a * {base} + b) AS BIGINT)"


_BLOCKS = f"{_P}, b AS (SELECT probe_id, i AS start, substring(seq, i + 1, 27) AS part FROM (SELECT probe_id, seq, unnest(range(0, length(seq), 27)) AS i FROM probe))"


_PACKED = f"{_BLOCKS} SELECT probe_id, CAST(start AS INTEGER) AS start, CAST(length(part) AS INTEGER) AS letters, {_packed('part', 'ACGT', 4)} AS code, {_packed(_rc('part'), 'ACGT', 4)} AS rc_code, {_packed('reverse(lower(part))', 'acgt', 5)} AS base5 FROM b"


@query("seq_pack", _PACKED)
@query("seq_pack_blocks", _PACKED)
def seq_pack(spark: SparkSession, d: str) -> DataFrame:
    """The whole sequence of every probe in successive blocks of up to 27 letters, with their start and length."""
    starts = probes(spark, d).select("probe_id", "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - 1, F.lit(27))).alias("start"))
    part = F.col("part")
    blocks = starts.select("probe_id", "start", F.substring("seq", F.col("start") + 1, F.lit(27)).alias("part"))
    return blocks.select("probe_id", "start", F.length(part).alias("letters"), sq.pack(part).alias("code"), sq.pack(sq.revcomp(part)).alias("rc_code"), sq.pack_base5(part).alias("base5"))


@query("seq_sites", f"{_P} SELECT probe_id, " + " OR ".join(f"contains(seq, '{s}') OR contains(seq, {_rc(repr(s))})" for s in SITES) + " AS has_site FROM probe")
def seq_sites(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", sq.has_site(F.col("seq"), SITES).alias("has_site"))


_RAW = r"regexp_replace(sequence, '\s+', '', 'g')"


@query("seq_case_runs", f"SELECT DISTINCT transcript_id, CAST(len(regexp_extract_all({_RAW}, '[A-Z]+|[a-z]+')) AS INTEGER) AS runs, md5(array_to_string(list_transform(regexp_extract_all({_RAW}, '[A-Z]+|[a-z]+'), lambda p, i: CASE WHEN i % 2 = 1 THEN upper(p) ELSE lower(p) END), '')) AS joined FROM transcriptome WHERE sequence IS NOT NULL")
def seq_case_runs(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "transcriptome").filter("sequence IS NOT NULL").select("transcript_id", sq.case_runs(F.regexp_replace("sequence", r"\s+", "")).alias("p")).distinct()
    return parts.select("transcript_id", F.size("p").alias("runs"), F.md5(sq.alternate_case(F.col("p"))).alias("joined")).distinct()


@query("probe_windows", f"{_T} SELECT transcript_id, CAST(i AS INTEGER) AS shift, substring(seq, i + 1, 30) AS target FROM (SELECT transcript_id, seq, unnest(range(0, length(seq) - 29, 10)) AS i FROM tx WHERE length(seq) >= 30)")
def probe_windows(spark: SparkSession, d: str) -> DataFrame:
    return pb.windows(transcripts(spark, d), "seq", 30, 10, "transcript_id")


_KMERS = f"{_T}, km AS (SELECT substring(seq, i + 1, 9) AS kmer, fpkm FROM (SELECT seq, fpkm, unnest(range(0, length(seq) - 8)) AS i FROM tx WHERE length(seq) >= 9))"
_PLAIN = "regexp_full_match(kmer, '[ACGT]+')"


@query("kmer_counts", f"{_KMERS} SELECT {_packed('kmer', 'ACGT', 4)} AS code, CAST(n AS BIGINT) AS hits FROM (SELECT kmer, count(*) AS n FROM km WHERE {_PLAIN} GROUP BY kmer)")
def kmer_counts(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_table(transcripts(spark, d), "seq", 9)


@query("kmer_counts_limited", f"{_KMERS} SELECT {_packed('kmer', 'ACGT', 4)} AS code, CAST(least(n, 5) AS BIGINT) AS hits FROM (SELECT kmer, count(*) AS n FROM km WHERE {_PLAIN} GROUP BY kmer)")
def kmer_counts_limited(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_table(transcripts(spark, d), "seq", 9, None, 5)


@query("kmer_fpkm", f"{_KMERS} SELECT {_packed('kmer', 'ACGT', 4)} AS code, round(w, 4) AS hits FROM (SELECT kmer, sum(coalesce(fpkm, 1.0)) AS w FROM km WHERE {_PLAIN} GROUP BY kmer)")
def kmer_fpkm(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_table(transcripts(spark, d), "seq", 9, F.coalesce("fpkm", F.lit(1.0))).withColumn("hits", F.round("hits", 4))


_HITS = f"""{_KMERS}, {PROBES_SQL}, t AS (SELECT kmer, count(*) AS n FROM km WHERE {_PLAIN} GROUP BY kmer),
pk AS (SELECT probe_id, CASE WHEN length(seq) >= 9 THEN unnest(range(0, length(seq) - 8)) END AS i, seq FROM probe),"""


@query("probe_hits", f"{_HITS} pk2 AS (SELECT probe_id, substring(seq, i + 1, 9) AS kmer FROM pk) SELECT probe_id, CAST(count(*) AS BIGINT) AS n_kmers, CAST(sum(coalesce(n, 0)) AS BIGINT) AS hits FROM pk2 LEFT JOIN t USING (kmer) GROUP BY probe_id")
def probe_hits(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_hits(probes(spark, d), "probe_id", "seq", pb.kmer_sums(transcripts(spark, d), "seq", 9), 9)


@query("probe_hits_both", f"{_HITS} pk2 AS (SELECT probe_id, substring(seq, i + 1, 9) AS kmer FROM pk UNION ALL SELECT probe_id, {_rc('substring(seq, i + 1, 9)')} FROM pk) SELECT probe_id, CAST(count(*) AS BIGINT) AS n_kmers, CAST(sum(coalesce(n, 0)) AS BIGINT) AS hits FROM pk2 LEFT JOIN t USING (kmer) GROUP BY probe_id")
def probe_hits_both(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_hits(probes(spark, d), "probe_id", "seq", pb.kmer_sums(transcripts(spark, d), "seq", 9), 9, True)


@query("probe_hits_stride", f"{_HITS} pk2 AS (SELECT probe_id, substring(seq, i + 1, 9) AS kmer FROM pk WHERE i % 9 = 0) SELECT probe_id, CAST(count(*) AS BIGINT) AS n_kmers, CAST(sum(coalesce(n, 0)) AS BIGINT) AS hits FROM pk2 LEFT JOIN t USING (kmer) GROUP BY probe_id")
def probe_hits_stride(spark: SparkSession, d: str) -> DataFrame:
    return pb.kmer_hits(probes(spark, d), "probe_id", "seq", pb.kmer_sums(transcripts(spark, d), "seq", 9), 9, False, 9)


@query("probe_filter", f"{_P}, r AS (SELECT probe_id, (length(seq) - length(regexp_replace(seq, '[GC]', '', 'g'))) / length(seq) AS gc, {_tm('seq')} AS tm FROM probe) SELECT probe_id, round(gc, 9) AS gc, round(tm, 6) AS tm FROM r WHERE gc BETWEEN 0.4 AND 0.6 AND tm BETWEEN 55 AND 75")
def probe_filter(spark: SparkSession, d: str) -> DataFrame:
    return pb.filter_probes(probes(spark, d), "seq", (0.4, 0.6), (55.0, 75.0)).select("probe_id", F.round("gc", 9).alias("gc"), F.round("tm", 6).alias("tm"))


@query(
    "probe_select",
    f"""WITH RECURSIVE {PROBES_SQL}, l AS (SELECT gene_id, transcript_id, list(struct_pack(s := shift, i := probe_id, e := shift + length(seq)) ORDER BY shift, probe_id) AS l FROM probe WHERE transcript_id IS NOT NULL AND shift IS NOT NULL GROUP BY 1, 2),
r AS (SELECT gene_id, transcript_id, l, l[1] AS now FROM l UNION ALL SELECT gene_id, transcript_id, l, list_filter(l, lambda x: x.s >= r.now.e)[1] AS now FROM r WHERE len(list_filter(l, lambda x: x.s >= r.now.e)) > 0)
SELECT probe.* FROM r JOIN probe ON probe.probe_id = r.now.i""",
)
def probe_select(spark: SparkSession, d: str) -> DataFrame:
    """Non-overlapping probes of each transcript."""
    shifted = probes(spark, d).filter("transcript_id IS NOT NULL")
    return pb.select_no_overlap(shifted, ["gene_id", "transcript_id"], "shift", "seq", "probe_id")


@query("probe_largest_gaps", f"{_P}, g AS (SELECT probe_id, transcript_id, shift, coalesce(shift - lag(shift) OVER (PARTITION BY transcript_id ORDER BY shift), 'Infinity'::DOUBLE) AS gap FROM (SELECT transcript_id, shift, min(probe_id) AS probe_id FROM probe WHERE transcript_id IS NOT NULL AND shift IS NOT NULL GROUP BY 1, 2)) SELECT probe_id, transcript_id FROM (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY gap DESC, shift) AS k FROM g) WHERE k <= 3")
def probe_largest_gaps(spark: SparkSession, d: str) -> DataFrame:
    one = probes(spark, d).filter("transcript_id IS NOT NULL AND shift IS NOT NULL").groupBy("transcript_id", "shift").agg(F.min("probe_id").alias("probe_id"))
    return pb.largest_gaps(one, "transcript_id", "shift", 3).select("probe_id", "transcript_id")


@query(
    "probe_best_split",
    f"""{_P}, s AS (SELECT probe_id, seq, length(seq) // 2 AS m, unnest(range(-3, 4)) AS o FROM probe), a AS (SELECT probe_id, o, m + o AS k, left(seq, m + o) AS l, substring(seq, m + o + 1) AS r FROM s WHERE m + o > 1 AND length(seq) - m - o > 1),
e AS (SELECT probe_id, o, k, round(abs({_tm('l')} - {_tm('r')}), 6) AS diff FROM a)
SELECT probe_id, CAST(CASE WHEN diff <= 5 THEN k ELSE -1 END AS INTEGER) AS split, diff AS tm_diff FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY diff, abs(o), k) AS n FROM e) WHERE n = 1""",
)
def probe_best_split(spark: SparkSession, d: str) -> DataFrame:
    return pb.best_split(probes(spark, d), "probe_id", "seq")


@query("probe_assembly", f"{_P} SELECT probe_id, '{FORWARD}' || left(seq, 6) || 'A' || {_rc('seq')} || 'A' || right(seq, 6) || '{REVERSE}' AS oligo FROM probe")
def probe_assembly(spark: SparkSession, d: str) -> DataFrame:
    bits = [F.substring("seq", 1, 6), F.substring("seq", -6, 6)]
    return probes(spark, d).select("probe_id", pb.assemble(F.col("seq"), bits, F.lit(FORWARD), F.lit(REVERSE)).alias("oligo"))


@query("probe_on_bits", f"SELECT probe_id, CAST(list_position(string_split(barcode, ''), '1') AS INTEGER) AS first_bit, CAST(length(barcode) - length(replace(barcode, '1', '')) AS INTEGER) AS n_on FROM probe_dict WHERE regexp_full_match(barcode, '[01]{{16}}')".replace("{{", "{").replace("}}", "}"))
def probe_on_bits(spark: SparkSession, d: str) -> DataFrame:
    bits = F.filter(F.transform(F.split("barcode", ""), lambda b, i: F.when(b == "1", i + 1)), lambda i: i.isNotNull())
    return table(spark, d, "probe_dict").filter(F.col("barcode").rlike("^[01]{16}$")).select("probe_id", F.try_element_at(bits, F.lit(1)).alias("first_bit"), F.size(bits).alias("n_on"))


@query("probe_genes_failed", f"{_P} SELECT DISTINCT gene_id FROM transcriptome WHERE gene_id NOT IN (SELECT gene_id FROM probe WHERE gene_id IS NOT NULL)")
def probe_genes_failed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "transcriptome").select("gene_id").distinct().join(probes(spark, d).select("gene_id"), "gene_id", "left_anti")


@query("probe_plates", f"{_P}, n AS (SELECT probe_id, row_number() OVER (ORDER BY probe_id) - 1 AS n FROM probe) SELECT probe_id, CAST(n // 96 AS INTEGER) AS plate, chr(CAST(65 + (n % 96) // 12 AS INTEGER)) || CAST(n % 12 + 1 AS VARCHAR) AS well FROM n")
def probe_plates(spark: SparkSession, d: str) -> DataFrame:
    return pb.plate_positions(probes(spark, d).select("probe_id"), ["probe_id"])


@query("probe_order_rows", "SELECT probe_id, CAST(i - 1 AS INTEGER) AS part, string_split(target_sequence, '.')[i] AS sequence FROM (SELECT probe_id, target_sequence, unnest(range(1, len(string_split(target_sequence, '.')) + 1)) AS i FROM probe_dict WHERE target_sequence IS NOT NULL)")
def probe_order_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "probe_dict").filter("target_sequence IS NOT NULL").select("probe_id", F.posexplode(F.split("target_sequence", r"\.")).alias("part", "sequence"))


@query("transcript_fasta", f"{_T} SELECT md5('>' || transcript_id || chr(10) || regexp_replace(regexp_replace(seq, '(.{{80}})', '\\1' || chr(10), 'g'), chr(10) || '$', '')) AS record, transcript_id FROM tx WHERE seq <> ''")
def transcript_fasta(spark: SparkSession, d: str) -> DataFrame:
    record = F.concat(F.lit(">"), "transcript_id", F.lit("\n"), sq.wrap(F.col("seq")))
    return transcripts(spark, d).filter("seq <> ''").select("transcript_id", F.md5(record).alias("record"))


_SIZED = f"{_T}, s AS (SELECT gene_id, transcript_id, length(seq) AS n FROM tx WHERE seq IS NOT NULL)"


@query("gene_shortest_transcript", f"{_SIZED} SELECT gene_id, transcript_id, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY n, transcript_id) AS k FROM s) WHERE k = 1")
def gene_shortest_transcript(spark: SparkSession, d: str) -> DataFrame:
    return pb.transcript_of_gene(transcripts(spark, d), "shortest")


@query("gene_longest_transcript", f"{_SIZED} SELECT gene_id, transcript_id, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY n DESC, transcript_id DESC) AS k FROM s) WHERE k = 1")
def gene_longest_transcript(spark: SparkSession, d: str) -> DataFrame:
    return pb.transcript_of_gene(transcripts(spark, d), "longest")


@query("gene_median_transcript", f"{_SIZED}, m AS (SELECT gene_id, median(n) AS m FROM s GROUP BY 1) SELECT gene_id, transcript_id, CAST(n AS INTEGER) AS n FROM (SELECT s.*, row_number() OVER (PARTITION BY gene_id ORDER BY transcript_id DESC) AS k FROM s JOIN m USING (gene_id) WHERE n = m) WHERE k = 1")
def gene_median_transcript(spark: SparkSession, d: str) -> DataFrame:
    return pb.transcript_of_gene(transcripts(spark, d), "median")


@query("codebook_hamming", f"WITH {CODES_SQL} SELECT a.barcode_id AS a, b.barcode_id AS b, CAST(bit_count(xor(a.code, b.code)) AS INTEGER) AS distance FROM codes a JOIN codes b ON a.barcode_id < b.barcode_id")
def codebook_hamming(spark: SparkSession, d: str) -> DataFrame:
    return pb.hamming_pairs(codebook(spark, d))
