"""Queries: probes chosen by coverage, repaired and tailed sequences, and the cassettes of the assays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlake.functions import sequences as sq
from spotlake.operators import designs as de
from spotlake.operators import probes as pb
from spotlake.plans import query
from spotlake.plans.probes import _PLAIN, FORWARD, REVERSE, _packed, _rc, _tm
from spotlake.session import table
from spotlake.sources.views import PROBES_SQL, TRANSCRIPTS_SQL, probes, transcripts

_P, _T = f"WITH {PROBES_SQL}", f"WITH {TRANSCRIPTS_SQL}"
PAD = FORWARD * 30
#: The primer between the arms of a ligated probe.
LINK_PRIMER = "TCCTACAGTAGGA"
_CHOSEN = 4


def _rounds(n: int) -> str:
    made = f"{_P}, c0 AS (SELECT transcript_id AS key, probe_id AS id, md5('11-' || probe_id) AS mix, shift AS a, shift + length(seq) AS b, 0 AS covered FROM probe WHERE transcript_id IS NOT NULL AND shift IS NOT NULL)"
    for i in range(n):
        made += f""", p{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY covered, mix, id) AS r FROM c{i}) WHERE r = 1),
c{i + 1} AS (SELECT c.key, c.id, c.mix, c.a, c.b, c.covered + greatest(0, least(c.b, p.b) - greatest(c.a, p.a)) AS covered FROM c{i} c JOIN p{i} p USING (key) WHERE c.id <> p.id)"""
    return made + " " + " UNION ALL ".join(f"SELECT key AS transcript_id, id AS probe_id, {i} AS place FROM p{i}" for i in range(n))


@query("probe_coverage_choice", _rounds(_CHOSEN))
def probe_coverage_choice(spark: SparkSession, d: str) -> DataFrame:
    """Four probes of each transcript, each as little covered by those before as can be."""
    return de.choose_by_coverage(probes(spark, d), "transcript_id", "probe_id", "shift", "seq", _CHOSEN, 11)


@query("probe_coordinates", f"{_T}, {PROBES_SQL} SELECT DISTINCT probe_id, transcript_id, substring(tx.seq, shift + 1, length(probe.seq)) AS target, substring(tx.seq, shift + 1, length(probe.seq)) = probe.seq AS same FROM probe JOIN tx USING (transcript_id) WHERE shift IS NOT NULL AND tx.seq IS NOT NULL")
def probe_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """The stretch of the transcript that a probe's coordinates name, and whether it is the probe's target."""
    tx = transcripts(spark, d).filter("seq IS NOT NULL").select("transcript_id", F.col("seq").alias("whole"))
    at = probes(spark, d).filter("shift IS NOT NULL").join(tx, "transcript_id").withColumn("target", F.substring(F.col("whole"), F.col("shift") + 1, F.length("seq")))
    return at.select("probe_id", "transcript_id", "target", (F.col("target") == F.col("seq")).alias("same")).distinct()


@query("probe_without_runs", f"{_P} SELECT probe_id FROM probe WHERE NOT regexp_matches(seq, 'AAAA|CCCC|GGGGGG|TTTTTT')")
def probe_without_runs(spark: SparkSession, d: str) -> DataFrame:
    """Probes that a condition on their sequence keeps."""
    return probes(spark, d).filter(~F.col("seq").rlike("AAAA|CCCC|GGGGGG|TTTTTT")).select("probe_id")


def _broken(source: str) -> str:
    size = "CASE run[1] " + " ".join(f"WHEN '{x}' THEN {n}" for x, n in de.RUNS.items()) + " ELSE 1000000 END"
    other = "CASE run[1] " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in de.COMPLEMENT.items()) + " END"
    whole = f"array_to_string(list_transform(range(0, length(run)), lambda i: CASE WHEN i % ({size}) = ({size}) // 2 THEN {other} ELSE run[1] END), '')"
    return f"(SELECT probe_id, array_to_string(list_transform(regexp_extract_all(s, 'A+|C+|G+|T+'), lambda run: CASE WHEN length(run) >= ({size}) THEN {whole} ELSE run END), '') AS s FROM {source})"


def _broken_sql() -> str:
    made = f"{_P}, b0 AS (SELECT probe_id, seq AS s FROM probe)"
    for i in range(de.PASSES):
        made += f", b{i + 1} AS MATERIALIZED {_broken(f'b{i}')}"
    return f"{made} SELECT probe_id, s AS seq FROM b{de.PASSES}"


@query("probe_runs_broken", _broken_sql())
def probe_runs_broken(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", de.break_runs(F.col("seq")).alias("seq"))


_SIZE = "(SELECT max(length(target_sequence)) FROM probe_dict)"
_MISSING = f"greatest({_SIZE} - length(s), 0)"


@query(
    "probe_padded",
    f"""WITH t AS (SELECT probe_id, target_sequence AS s FROM probe_dict WHERE target_sequence <> ''), l AS (SELECT *, left('{PAD}', CAST(least({_MISSING}, 5) AS INTEGER)) AS a, CASE WHEN {_MISSING} > 5 THEN right('{PAD}', CAST({_MISSING} - 5 AS INTEGER)) ELSE '' END AS b FROM t)
SELECT probe_id, (CASE WHEN left(s, 1) = lower(left(s, 1)) THEN upper(a) ELSE lower(a) END) || s || (CASE WHEN right(s, 1) = lower(right(s, 1)) THEN upper(b) ELSE lower(b) END) AS padded FROM l""",
)
def probe_padded(spark: SparkSession, d: str) -> DataFrame:
    """All targets filled up to the longest one."""
    given = table(spark, d, "probe_dict").filter("target_sequence != ''").select("probe_id", "target_sequence")
    size = given.agg(F.max(F.length("target_sequence")).alias("size"))  # one row
    return given.join(F.broadcast(size)).select("probe_id", de.padded(F.col("target_sequence"), F.col("size"), PAD).alias("padded"))


@query("seq_halves_joined", f"{_P} SELECT probe_id, seq FROM probe")
def seq_halves_joined(spark: SparkSession, d: str) -> DataFrame:
    """The halves that seq_halves gives, joined again."""
    half = F.floor(F.length("seq") / 2).cast("int")
    left, right = sq.revcomp(F.left("seq", half)), sq.revcomp(F.substring(F.col("seq"), half + 1, F.length("seq")))
    return probes(spark, d).select("probe_id", F.concat(sq.revcomp(left), sq.revcomp(right)).alias("seq"))


_ON = "list_filter(range(1, 17), lambda i: barcode[i] = '1')"
_CODED = f"{_P}, coded AS (SELECT *, {_ON} AS bits FROM probe WHERE regexp_full_match(barcode, '[01]{{16}}'))".replace("{{", "{").replace("}}", "}")


def _coded(spark: SparkSession, d: str) -> DataFrame:
    """Probes with a barcode of 16 bits, and their on-bits (from 1)."""
    on = F.filter(F.transform(F.split("barcode", ""), lambda b, i: F.when(b == "1", i + 1)), lambda i: i.isNotNull())
    return probes(spark, d).filter(F.col("barcode").rlike("^[01]{16}$")).withColumn("bits", on)


@query("probe_tails", f"{_CODED}, n AS (SELECT probe_id, bits, row_number() OVER (PARTITION BY gene_id ORDER BY probe_id) - 1 AS n FROM coded WHERE gene_id IS NOT NULL AND len(bits) > 0) SELECT probe_id, CAST(bits[n % len(bits) + 1] AS INTEGER) AS bit FROM n WHERE n < 10 * len(bits)")
def probe_tails(spark: SparkSession, d: str) -> DataFrame:
    """The bit that each probe's tail carries, ten probes of a gene to a bit at most."""
    return de.tails_in_turn(_coded(spark, d).filter("gene_id IS NOT NULL"), "gene_id", "probe_id", "bits", 10)


@query(
    "probe_self_cleaving",
    f"{_P} SELECT probe_id, lower({_rc('substring(seq, 2, 14)')} || '{de.CLEAVED_START}') AS before, lower((CASE WHEN right(seq, 1) = 'T' THEN '{de.CLEAVED_T}' ELSE '{de.CLEAVED_OTHER}' END) || {_rc('right(seq, 15)')}) AS behind FROM probe",
)
def probe_self_cleaving(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark, d).select("probe_id", *de.self_cleaving(F.col("seq")))


_ARMS = f"""{_T}, w AS (SELECT DISTINCT transcript_id, shift, substring(seq, shift + 1, 60) AS target FROM (SELECT transcript_id, seq, CAST(unnest(range(0, length(seq) - 59, 60)) AS INTEGER) AS shift FROM tx WHERE length(seq) >= 60)),
o AS (SELECT transcript_id, shift, target, unnest(range(-3, 4)) AS o FROM w WHERE regexp_full_match(target, '[ACGT]+')),
a AS (SELECT transcript_id, shift, o, {_rc('left(target, 30 + o)')} AS l, {_rc('substring(target, 31 + o)')} AS r FROM o),
t AS (SELECT *, {_tm('l')} AS tl, {_tm('r')} AS tr FROM a), b AS (SELECT *, row_number() OVER (PARTITION BY transcript_id, shift ORDER BY round(abs(tl - tr), 6), abs(o), o) AS k FROM t),
arms AS (SELECT transcript_id, shift, l AS left_arm, r AS right_arm, round(abs(tl - tr), 6) AS tm_diff FROM b WHERE k = 1 AND round(abs(tl - tr), 6) <= 5 AND least(tl, tr) >= 47)"""


def _arms(spark: SparkSession, d: str) -> DataFrame:
    return de.ligation_arms(transcripts(spark, d).select("transcript_id", "seq").distinct(), "seq", "transcript_id")


@query("ligation_arms", f"{_ARMS} SELECT * FROM arms")
def ligation_arms(spark: SparkSession, d: str) -> DataFrame:
    return _arms(spark, d)


@query("ligation_probes_blank", f"{_ARMS} SELECT transcript_id, shift, left_arm || '{LINK_PRIMER}' || 'N' || 'ta' || right_arm AS oligo FROM arms")
def ligation_probes_blank(spark: SparkSession, d: str) -> DataFrame:
    """Ligated probes with a place for the readouts."""
    return _arms(spark, d).select("transcript_id", "shift", F.concat("left_arm", F.lit(LINK_PRIMER), F.lit("N"), F.lit("ta"), "right_arm").alias("oligo"))


_PAIRS = f"""{_T}, w AS (SELECT DISTINCT gene_id, transcript_id, shift, substring(seq, shift + 1, 60) AS target FROM (SELECT gene_id, transcript_id, seq, CAST(unnest(range(0, length(seq) - 59, 60)) AS INTEGER) AS shift FROM tx WHERE length(seq) >= 60)),
h AS (SELECT *, left(target, 30) AS a, substring(target, 31) AS b FROM w WHERE regexp_full_match(target, '[ACGT]+')),
g AS (SELECT * FROM h WHERE (30 - length(regexp_replace(a, '[GC]', '', 'g'))) / 30 BETWEEN 0.3 AND 0.7 AND (30 - length(regexp_replace(b, '[GC]', '', 'g'))) / 30 BETWEEN 0.3 AND 0.7),
k AS (SELECT gene_id, transcript_id, shift, side, substring(s, i + 1, 12) AS kmer FROM (SELECT gene_id, transcript_id, shift, 0 AS side, a AS s, unnest(range(0, 19)) AS i FROM g UNION ALL SELECT gene_id, transcript_id, shift, 1, b, unnest(range(0, 19)) FROM g)),
known AS (SELECT DISTINCT gene_id AS other, substring(seq, i + 1, 12) AS kmer FROM (SELECT gene_id, seq, unnest(range(0, length(seq) - 11)) AS i FROM tx WHERE length(seq) >= 12)),
hit AS (SELECT gene_id, transcript_id, shift FROM k JOIN known USING (kmer) WHERE other <> gene_id GROUP BY gene_id, transcript_id, shift, other HAVING count(DISTINCT side) = 2)
SELECT gene_id, transcript_id, shift, target FROM g WHERE (gene_id, transcript_id, shift) NOT IN (SELECT (gene_id, transcript_id, shift) FROM hit) AND gene_id IS NOT NULL AND transcript_id IS NOT NULL"""


@query("probe_pair_windows", _PAIRS)
def probe_pair_windows(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of neighbouring windows that no other gene could bind together."""
    return de.pair_windows(transcripts(spark, d), "gene_id", "seq", "transcript_id").filter("transcript_id IS NOT NULL")


@query(
    "kmer_maps",
    f"""{_T}, {PROBES_SQL}, km AS (SELECT 'transcripts' AS map, substring(seq, i + 1, 9) AS kmer FROM (SELECT seq, unnest(range(0, length(seq) - 8)) AS i FROM tx WHERE length(seq) >= 9) UNION ALL SELECT 'probes', substring(seq, i + 1, 9) FROM (SELECT seq, unnest(range(0, length(seq) - 8)) AS i FROM probe WHERE length(seq) >= 9))
SELECT map, {_packed('kmer', 'ACGT', 4)} AS code, CAST(n AS BIGINT) AS hits FROM (SELECT map, kmer, count(*) AS n FROM km WHERE {_PLAIN} GROUP BY 1, 2)""",
)
def kmer_maps(spark: SparkSession, d: str) -> DataFrame:
    """The k-mer maps of both sources, by name."""
    sources = {"transcripts": transcripts(spark, d), "probes": probes(spark, d)}
    made = [pb.kmer_table(df, "seq", 9).withColumn("map", F.lit(name)) for name, df in sources.items()]
    return made[0].unionByName(made[1])


@query(
    "isoforms_alike",
    f"""{_T}, s AS (SELECT DISTINCT gene_id, transcript_id, seq FROM tx WHERE length(seq) >= 17), l AS (SELECT gene_id, seq AS longest FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY length(seq) DESC, transcript_id DESC, seq DESC) AS k FROM s) WHERE k = 1),
k AS (SELECT gene_id, transcript_id, md5(seq) AS h, longest, substring(seq, i + 1, 17) AS kmer FROM (SELECT gene_id, transcript_id, seq, longest, unnest(range(0, length(seq) - 16, 17)) AS i FROM s JOIN l USING (gene_id)))
SELECT transcript_id, round(avg(CASE WHEN contains(longest, kmer) THEN 1.0 ELSE 0.0 END), 6) AS share FROM k GROUP BY transcript_id, h HAVING avg(CASE WHEN contains(longest, kmer) THEN 1.0 ELSE 0.0 END) > 0.3""",
)
def isoforms_alike(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts of which more than 0.3 of the 17-mers, every 17 letters, stand in the longest transcript of their gene."""
    tx = transcripts(spark, d).filter("length(seq) >= 17 AND gene_id IS NOT NULL").select("gene_id", "transcript_id", "seq").distinct()
    best = tx.groupBy("gene_id").agg(F.max(F.struct(F.length("seq").alias("n"), "transcript_id", "seq")).alias("m")).select("gene_id", F.col("m.seq").alias("seq"))
    known = pb.windows(best, "seq", 17, 1, "gene_id", spread=True).select("gene_id", "target").distinct().withColumn("_in", F.lit(1.0))
    each = pb.windows(tx.withColumn("_h", F.xxhash64("seq")), "seq", 17, 17, "gene_id", "transcript_id", "_h")
    share = each.join(known, ["gene_id", "target"], "left").groupBy("transcript_id", "_h").agg(F.avg(F.coalesce("_in", F.lit(0.0))).alias("share"))
    return share.filter("share > 0.3").select("transcript_id", F.round("share", 6).alias("share"))


@query("library_primers", f"{_P}, o AS (SELECT seq FROM probe UNION SELECT {_rc('seq')} FROM probe) SELECT left(seq, 12) AS forward, {_rc('right(seq, 12)')} AS reverse, CAST(count(*) AS BIGINT) AS oligos FROM o WHERE length(seq) >= 24 GROUP BY 1, 2")
def library_primers(spark: SparkSession, d: str) -> DataFrame:
    """The primer pairs of two joined libraries (targets and their complements, each sequence once) and how many oligos have them."""
    mine = probes(spark, d).select("seq")
    both = mine.unionByName(mine.select(sq.revcomp(F.col("seq")).alias("seq"))).distinct().filter("length(seq) >= 24")
    return both.groupBy(F.left("seq", F.lit(12)).alias("forward"), sq.revcomp(F.right("seq", F.lit(12))).alias("reverse")).agg(F.count(F.lit(1)).alias("oligos"))


def _readout(i: Column) -> Column:
    """A readout sequence for a bit, made from the md5 of its number."""
    return F.translate(F.left(F.md5(F.concat(F.lit("bit"), i.cast("string"))), F.lit(20)), "0123456789abcdef", "ACGTACGTACGTACGT")


def _readout_sql(i: str) -> str:
    return f"translate(left(md5('bit' || {i}), 20), '0123456789abcdef', 'ACGTACGTACGTACGT')"


_FIRST_TWO = f"{_readout_sql('bits[1]')}", f"{_readout_sql('bits[2]')}"


@query("design_combinatorial", f"{_CODED} SELECT probe_id, '{FORWARD}' || {_FIRST_TWO[0]} || 'A' || {_rc('seq')} || 'A' || {_FIRST_TWO[1]} || '{REVERSE}' AS oligo FROM coded WHERE len(bits) >= 2")
def design_combinatorial(spark: SparkSession, d: str) -> DataFrame:
    """Combinatorial probes: two readouts of the code around the target, between primers."""
    two = [_readout(F.element_at("bits", F.lit(k))) for k in (1, 2)]
    return _coded(spark, d).filter(F.size("bits") >= 2).select("probe_id", pb.assemble(F.col("seq"), two, F.lit(FORWARD), F.lit(REVERSE)).alias("oligo"))


@query("design_smfish", f"{_CODED} SELECT probe_id, {_rc('seq')} || 'A' || {_FIRST_TWO[0]} || 'A' || {_FIRST_TWO[0]} AS oligo FROM coded WHERE len(bits) >= 1")
def design_smfish(spark: SparkSession, d: str) -> DataFrame:
    """Single-molecule probes: one readout twice behind the target."""
    one = _readout(F.element_at("bits", F.lit(1)))
    return _coded(spark, d).filter(F.size("bits") >= 1).select("probe_id", F.concat(sq.revcomp(F.col("seq")), F.lit("A"), one, F.lit("A"), one).alias("oligo"))


_HALF = "length(seq) // 2"


@query("design_ligated", f"{_CODED} SELECT probe_id, {_rc(f'left(seq, {_HALF})')} || '{LINK_PRIMER}' || array_to_string(list_transform(bits, lambda b: {_rc(_readout_sql('b'))}), 't') || 't' || {_rc(f'substring(seq, {_HALF} + 1)')} AS oligo FROM coded WHERE len(bits) >= 1")
def design_ligated(spark: SparkSession, d: str) -> DataFrame:
    """Ligated probes: all readouts of the code, complemented, between the arms."""
    half = F.floor(F.length("seq") / 2).cast("int")
    left, right = sq.revcomp(F.left("seq", half)), sq.revcomp(F.substring(F.col("seq"), half + 1, F.length("seq")))
    inner = F.array_join(F.transform("bits", lambda b: sq.revcomp(_readout(b))), "t")
    return _coded(spark, d).filter(F.size("bits") >= 1).select("probe_id", F.concat(left, F.lit(LINK_PRIMER), inner, F.lit("t"), right).alias("oligo"))


@query("design_split", f"{_CODED} SELECT probe_id, {_rc(f'left(seq, {_HALF})')} || {_FIRST_TWO[0]} || '.' || {_FIRST_TWO[1]} || {_rc(f'substring(seq, {_HALF} + 1)')} AS oligo FROM coded WHERE len(bits) >= 2")
def design_split(spark: SparkSession, d: str) -> DataFrame:
    """Split probes: each arm with one readout, as two oligos joined by a dot."""
    half = F.floor(F.length("seq") / 2).cast("int")
    left, right = sq.revcomp(F.left("seq", half)), sq.revcomp(F.substring(F.col("seq"), half + 1, F.length("seq")))
    two = [_readout(F.element_at("bits", F.lit(k))) for k in (1, 2)]
    return _coded(spark, d).filter(F.size("bits") >= 2).select("probe_id", F.concat(left, two[0], F.lit("."), two[1], right).alias("oligo"))
