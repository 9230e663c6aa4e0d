"""Probes chosen by coverage, broken runs of letters, padded and tailed sequences, and the cassettes of the assays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotlake.functions.sequences import COMPLEMENTS, LETTERS, melting_temperature, revcomp
from spotlake.operators import letters as le
from spotlake.operators.folds import keep_in_order
from spotlake.operators.probes import windows
from spotlake.session import cut

#: Runs of so many equal letters are broken, by the complement at the middle of every such stretch.
RUNS = {"G": 6, "C": 4, "T": 6, "A": 4}
COMPLEMENT = {"G": "C", "C": "G", "A": "T", "T": "A"}
#: Times that runs are looked for again.
PASSES = 6
#: The tails of self-cleaving ends, after a target's last letter T, after any other, and before its first letters.
CLEAVED_T = "AGTATCTTTTGCGTACAATCCGACGCGTCGGATTGTAAGCTAGGGGAATAAATCTTTGGGTG"
CLEAVED_OTHER = "AGCATCTTAGTAGTACAATCCGACGCGTCGGATTGTACGATTGGGGAATAGATCTTTGGGAC"
CLEAVED_START = "TATACCGGGCAACTATTGCCTCGTCATCGCTATTTTCTGCGATAGTGAGTCGTATTATTTTAATACGACTCACTATACTGC"
#: Letters of the sequences that a task rates together, and of those whose k-mers of one part of all k-mers it counts together.
CHUNK, COUNTED = 1 << 19, 1 << 21
#: Letters of the sequences whose pairs a task looks up, of the genes it looks them up in, of a slice of these; the least number of such blocks.
PAIRS_CHUNK, GENES_CHUNK, SLICE, LEAST_BLOCKS = 1 << 24, 1 << 25, 1 << 20, 12


def choose_by_coverage(df: DataFrame, key: str, id_column: str, start: str, sequence: str, n: int, seed: int) -> DataFrame:
    """key, id, place (from 0): *n* probes of each key, each time one whose letters are least covered by those chosen before; ties by md5 of seed and id.

    Every round is a minimum over each key and a join that adds the overlap with the probe just chosen, for all keys at once; rounds
    end with a checkpoint. Keys with fewer probes give all of them.
    """
    order = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(id_column).cast("string")))
    left = cut(df.filter(F.col(start).isNotNull() & F.col(sequence).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(id_column).alias("id"), order.alias("mix"), F.col(start).alias("a"), (F.col(start) + F.length(sequence)).alias("b"), F.lit(0).cast("bigint").alias("covered")))
    chosen = None
    for place in range(n):
        best = cut(left.groupBy("key").agg(F.min(F.struct("covered", "mix", "id", "a", "b")).alias("m")).select("key", "m.id", F.col("m.a").alias("pa"), F.col("m.b").alias("pb")))
        made = best.select(F.col("key").alias(key), F.col("id").alias(id_column), F.lit(place).alias("place"))
        chosen = made if chosen is None else chosen.unionByName(made)
        added = F.greatest(F.lit(0), F.least("b", "pb") - F.greatest("a", "pa"))
        left = cut(left.join(best.withColumnRenamed("id", "_taken"), "key").filter(F.col("id") != F.col("_taken")).select("key", "id", "mix", "a", "b", (F.col("covered") + added).alias("covered")))
    return chosen


def break_runs(c: Column) -> Column:
    """Capital letters with every run of RUNS broken, looked for PASSES times, as breaking a run may make another."""
    for _ in range(PASSES):
        for x, size in RUNS.items():
            h = size // 2
            # the first stretch of a run is whole, further ones begin where the last ended; new letters are small until the pass is over
            c = F.regexp_replace(c, rf"(?:(?<!{x})(?={x}{{{size}}})|\G(?<={x}))({x}{{{h}}}){x}({x}{{0,{size - h - 1}}})", f"$1{COMPLEMENT[x].lower()}$2")
        c = F.upper(c)
    return c


def padded(c: Column, size: Column, pad: str) -> Column:
    """A sequence filled up to *size*: five letters of the pad in front, its end behind, in the other case than the letters beside them."""
    missing = F.greatest(size - F.length(c), F.lit(0))
    left = F.substring(F.lit(pad), F.lit(1), F.least(missing, F.lit(5)))
    right = F.expr("''") if not pad else F.when(missing > 5, F.right(F.lit(pad), missing - 5)).otherwise("")
    other = lambda part, beside: F.when(beside == F.lower(beside), F.upper(part)).otherwise(F.lower(part))
    return F.concat(other(left, F.left(c, F.lit(1))), c, other(right, F.right(c, F.lit(1))))


def tails_in_turn(df: DataFrame, key: str, id_column: str, bits: str, most: int) -> DataFrame:
    """id, bit: the probes of each key take its on-bits by turns, in the order of their ids, until a bit has *most* probes."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(id_column)) - 1
    turned = df.filter(F.size(bits) > 0).select(key, id_column, bits, place.alias("_n"))
    return turned.filter(F.col("_n") < F.size(bits) * most).select(id_column, F.element_at(bits, (F.col("_n") % F.size(bits) + 1).cast("int")).alias("bit"))


def self_cleaving(c: Column) -> tuple[Column, Column]:
    """The ends that cleave themselves off a target: before and behind it, in small letters."""
    up = F.upper(c)
    behind = F.concat(F.when(F.right(up, F.lit(1)) == "T", CLEAVED_T).otherwise(CLEAVED_OTHER), revcomp(F.right(up, F.lit(15))))
    before = F.concat(revcomp(F.substring(up, 2, 14)), F.lit(CLEAVED_START))
    return F.lower(before).alias("before"), F.lower(behind).alias("behind")


def ligation_arms(df: DataFrame, sequence: str, *keep: str, arm: int = 30, most: float = 5.0, least_tm: float = 47.0) -> DataFrame:
    """The kept columns, shift, left_arm, right_arm and tm_diff: stretches of two arms, one after another, split near their middle where the arms melt most alike.

    Stretches whose arms differ by more than *most* degrees or melt under *least_tm* are left out, as are those with other letters than ACGT.
    """
    each = windows(df, sequence, 2 * arm, 2 * arm, *keep, spread=True).filter(F.col("target").rlike("^[ACGT]+$"))
    cuts = each.select(*keep, "shift", "target", F.explode(F.sequence(F.lit(-3), F.lit(3))).alias("_o"))
    left, right = F.substring(F.col("target"), F.lit(1), arm + F.col("_o")), F.substring(F.col("target"), arm + F.col("_o") + 1, arm - F.col("_o"))
    rated = cuts.select(*keep, "shift", "_o", revcomp(left).alias("left_arm"), revcomp(right).alias("right_arm")).withColumn("_l", melting_temperature(F.col("left_arm"))).withColumn("_r", melting_temperature(F.col("right_arm")))
    best = rated.groupBy(*keep, "shift").agg(F.min(F.struct(F.round(F.abs(F.col("_l") - F.col("_r")), 6).alias("tm_diff"), F.abs("_o").alias("far"), "_o", "left_arm", "right_arm", F.least("_l", "_r").alias("low"))).alias("m"))
    return best.filter((F.col("m.tm_diff") <= most) & (F.col("m.low") >= least_tm)).select(*keep, "shift", "m.left_arm", "m.right_arm", "m.tm_diff")


def pair_windows(df: DataFrame, gene: str, sequence: str, *keep: str, arm: int = 30, k: int = 12, gc: tuple[float, float] = (0.3, 0.7)) -> DataFrame:
    """Gene, the kept columns, shift and target of pairs of neighbouring windows, both with a GC share in range, that no other gene has k-mers of both of.

    A pair is dropped if some other gene holds a k-mer of its left and one of its right window; a gene's own k-mers don't count, rows without a gene neither.
    Every chunk of pairs meets every chunk of genes in one task, which finds the pairs of a slice of genes after another, so the genes of a k-mer, whose number
    grows with the table, are neither shuffled nor listed; only the sequences are sent, once for each chunk of the other side.
    """
    if k > 13:
        raise ValueError("k-mers have up to 13 letters")
    keys = [gene, *keep]
    rows = df.select(*keys, F.col(sequence).alias("_seq")).filter(F.col(gene).isNotNull() & (F.length(sequence) >= k))
    cut_up, n = le.in_chunks(rows, "_seq", PAIRS_CHUNK, [F.col(gene)])
    known, m = le.in_chunks(rows.select(F.col(gene).alias("_gene"), F.col("_seq").alias("_text")), "_text", GENES_CHUNK, [F.col("_gene"), F.lit("known")], -(-LEAST_BLOCKS // n))

    def pairs(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The rows in a fixed order, their codes, and row, shift, place and number of the good pairs; pairs of equal keys and shift have one number."""
        pdf = pdf[[*keys, "_seq"]].drop_duplicates().sort_values([*keys, "_seq"], ignore_index=True)
        codes, starts = le.coded(pdf["_seq"])
        row, shift = le.window_places(pdf["_seq"], starts, 2 * arm, 2 * arm)
        at = starts[row] + shift
        good = le.within(le.running(codes == le.OTHER), at, 2 * arm) == 0
        strong = le.running((codes == 1) | (codes == 2))
        for a in (at, at + arm):
            share = le.within(strong, a, arm) / arm
            good &= (share >= gc[0]) & (share <= gc[1])
        row, shift, at = row[good], shift[good], at[good]
        same = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()[row]
        number = np.unique(same.astype(np.int64) << 32 | shift, return_inverse=True)[1]
        return pdf, codes, row, shift, at, number

    def met(key: tuple, pdf: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"_chunk": [], "hit": []})
        if not len(pdf) or not len(others):
            return none
        pdf, codes, row, _, at, number = pairs(pdf)
        if not len(at):
            return none
        per = arm - k + 1
        packed, _ = le.packed_kmers(codes, k)
        # the k-mer above, the pair's number and its side below
        held = np.empty((2 * per, len(at)), np.uint64)
        for j in range(2 * per):
            side, i = divmod(j, per)
            held[j] = packed[at + side * arm + i].astype(np.uint64) << np.uint64(32) | (number << 1 | side).astype(np.uint64)
        held = held.reshape(-1)
        held.sort()
        held = held[np.r_[True, held[1:] != held[:-1]]]
        kmer, payload = (held >> np.uint64(32)).astype(np.uint32), held.astype(np.uint32)
        del held, packed, codes
        ends = np.empty(4**k + 1, np.int32)
        for a in range(0, len(ends), 1 << 20):
            ends[a : a + (1 << 20)] = np.searchsorted(kmer, np.arange(a, min(a + (1 << 20), len(ends)), dtype=np.uint32))
        del kmer
        others = others.sort_values("_gene", ignore_index=True)
        names = pd.Index(others["_gene"].unique())
        other = names.get_indexer(others["_gene"])
        own = np.zeros(number.max() + 1, np.int64)
        own[number] = names.get_indexer(pdf[gene])[row]
        hit = np.zeros(len(own), bool)
        # slices of whole genes, then pieces of whole genes with a bounded number of meetings
        letters = others["_text"].str.len().to_numpy().cumsum()
        begins = np.flatnonzero(np.r_[True, other[1:] != other[:-1]])
        begins = begins[np.r_[True, np.diff(np.r_[0, letters][begins] // SLICE) > 0]]
        for a, b in zip(begins, [*begins[1:], len(others)]):
            codes, starts = le.coded(others["_text"].iloc[a:b])
            packed, plain = le.packed_kmers(codes, k)
            of = np.repeat(other[a:b], np.diff(np.r_[starts, len(codes)]))[: len(packed)]
            each = np.unique(of[plain] << 32 | packed[plain].astype(np.int64))
            of, x = each >> 32, each & 0xFFFFFFFF
            low = ends[x].astype(np.int64)
            times = ends[x + 1] - low
            of, low, times = of[times > 0], low[times > 0], times[times > 0]
            if not len(of):
                continue
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            before = np.r_[0, times.cumsum()]
            first = first[np.r_[True, np.diff(before[first] // SLICE) > 0]]
            for c, e in zip(first, [*first[1:], len(of)]):
                t = times[c:e]
                found = payload[np.repeat(low[c:e] - (before[c:e] - before[c]), t) + np.arange(before[e] - before[c])].astype(np.int64)
                g = np.repeat(of[c:e], t)
                left = (own[found >> 1] != g) & ~hit[found >> 1]
                both = np.sort(g[left] << 32 | found[left])
                both = both[np.flatnonzero((both[1:] == both[:-1] + 1) & (both[:-1] & 1 == 0))]
                hit[(both & 0xFFFFFFFF) >> 1] = True
        return pd.DataFrame({"_chunk": [key[0]], "hit": [np.packbits(hit).tobytes()]})

    def kept(pdf: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        pdf, _, row, shift, _, number = pairs(pdf)
        texts = pdf["_seq"].to_numpy()
        if len(number):
            for b in hits["hit"]:
                free = ~np.unpackbits(np.frombuffer(b, np.uint8), count=number.max() + 1).astype(bool)[number]
                row, shift, number = row[free], shift[free], number[free]
        made = {c: pdf[c].to_numpy()[row] for c in keys}
        return pd.DataFrame(made | {"shift": shift.astype(np.int32), "target": [texts[r][s : s + 2 * arm] for r, s in zip(row, shift)]}).drop_duplicates()

    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    left = cut_up.select("*", every(m).alias("_other")).groupBy("_chunk", "_other")
    right = known.select(F.col("_chunk").alias("_other"), "_gene", "_text", every(n).alias("_chunk")).groupBy("_chunk", "_other")
    hits = left.cogroup(right).applyInPandas(met, "_chunk int, hit binary")
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys) + ", shift int, target string"
    return cut_up.groupBy("_chunk").cogroup(hits.groupBy("_chunk")).applyInPandas(kept, schema)


def rare_windows(df: DataFrame, length: int, step: int, k: int, gc: tuple[float, float], tm: tuple[float, float], sites: list[str], most: int) -> DataFrame:
    """gene_id, transcript_id, shift, target and tm of the probes chosen for every transcript (columns gene_id, transcript_id, seq in capitals).

    Windows of plain letters with GC share and tm in range and none of the sites on either strand, whose k-mers are seen *most* times on average in all
    sequences; of these, as many as interval scheduling by shift keeps for a gene's transcript. Targets that differ at one shift of a transcript are rated
    together and chosen together. k-mers travel packed, each once for a chunk of sequences, to the part that counts them; only the counts of those seen
    more than once come back, and nothing is joined, so nothing is broadcast.
    """
    if not k <= 16 or not k <= length:
        raise ValueError("k-mers have up to 16 letters and fit the windows")
    both = {s.upper() for s in sites} | {s.upper()[::-1].translate(str.maketrans(LETTERS, COMPLEMENTS)) for s in sites}
    rows = df.select("gene_id", "transcript_id", "seq").filter(F.length("seq") >= k)
    chunks, n = le.in_chunks(rows, "seq", CHUNK, [F.col("transcript_id"), F.col("seq")])
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * CHUNK // COUNTED)

    def rated(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes, and row, shift, place and tm of the good windows."""
        codes, starts = le.coded(pdf.seq)
        row, shift = le.window_places(pdf.seq, starts, length, step)
        at = starts[row] + shift
        share = le.within(le.running((codes == 1) | (codes == 2)), at, length) / length
        good = (le.within(le.running(codes == le.OTHER), at, length) == 0) & (share >= gc[0]) & (share <= gc[1]) & pdf.transcript_id.notna().to_numpy()[row]
        for site in both:
            good &= ~le.holding(codes, at, length, site)
        row, shift, at = row[good], shift[good], at[good]
        melts = le.melting(codes, at, length)
        good = (melts >= tm[0]) & (melts <= tm[1])
        return codes, row[good], shift[good], at[good], melts[good]

    def sent(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, _, _, at, _ = rated(pdf)
        packed, plain = le.packed_kmers(codes, k)
        asked = np.zeros(len(packed) + 1, np.int32)
        asked[at] += 1
        asked[at + length - k + 1] -= 1
        asked = np.cumsum(asked)[:-1] > 0
        # the lowest bit says whether a good window holds the k-mer here
        marked = np.sort((packed[plain].astype(np.uint64) << np.uint64(1)) | asked[plain])
        kmer = (marked >> np.uint64(1)).astype(np.uint32)
        first = np.flatnonzero(np.r_[True, kmer[1:] != kmer[:-1]]) if len(kmer) else np.zeros(0, int)
        ends = np.r_[first[1:], len(kmer)].astype(int)[: len(first)]
        kmer, times, wanted = kmer[first], (ends - first).astype(np.uint32), (marked[ends - 1] & np.uint64(1)).astype(bool)
        part = ((kmer * np.uint32(0x9E3779B1)).astype(np.uint64) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        kmer, times, wanted, part = kmer[order], times[order], wanted[order], part[order]
        edges = np.searchsorted(part, np.arange(parts + 1))
        made = []
        for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                again = np.flatnonzero(times[a:b] > 1).astype(np.uint32)
                made.append((p, int(pdf["_chunk"].iloc[0]), kmer[a:b].tobytes(), np.packbits(wanted[a:b]).tobytes(), again.tobytes(), times[a:b][again].tobytes()))
        return pd.DataFrame(made, columns=["part", "chunk", "kmers", "wanted", "again", "times"])

    def counted(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(b, np.uint32) for b in pdf.kmers]
        # most k-mers are seen once: only those met again are kept, with their number
        met = np.sort(np.concatenate(each))
        first = np.flatnonzero(np.r_[True, met[1:] != met[:-1]])
        known, sums = met[first], np.diff(np.r_[first, len(met)])
        for x, again, more in zip(each, pdf["again"], pdf["times"]):
            sums[np.searchsorted(known, x[np.frombuffer(again, np.uint32)])] += np.frombuffer(more, np.uint32).astype(np.int64) - 1
        known, sums = known[sums > 1], sums[sums > 1]
        made = []
        for x, wanted, chunk in zip(each, pdf.wanted, pdf.chunk):
            x = x[np.unpackbits(np.frombuffer(wanted, np.uint8), count=len(x)).astype(bool)]
            place = np.searchsorted(known, x)
            back = np.flatnonzero(place < len(known))
            back = back[known[place[back]] == x[back]]
            made.append((chunk, x[back].tobytes(), sums[place[back]].astype(np.int64).tobytes()))
        return pd.DataFrame(made, columns=["_chunk", "kmers", "hits"])

    def finished(pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        codes, row, shift, at, melts = rated(pdf)
        packed, _ = le.packed_kmers(codes, k)
        known, times = np.frombuffer(b"".join(back.kmers), np.uint32), np.frombuffer(b"".join(back.hits), np.int64)
        order = np.argsort(known)
        known, times = np.r_[known[order], np.uint32(0)], np.r_[times[order], 1]
        hits = np.zeros(len(at), np.int64)
        for j in range(length - k + 1):
            x = packed[at + j]
            i = np.searchsorted(known[:-1], x)
            hits += np.where((known[i] == x) & (i < len(known) - 1), times[i], 1)
        genes, ids, texts = pdf.gene_id.to_numpy(), pdf.transcript_id.to_numpy(), pdf.seq.to_numpy()
        return pd.DataFrame({"gene_id": genes[row], "transcript_id": ids[row], "shift": shift.astype(np.int32), "target": [texts[r][s : s + length] for r, s in zip(row, shift)], "tm": melts, "hits": hits})

    known = chunks.groupBy("_chunk").applyInPandas(sent, "part int, chunk int, kmers binary, wanted binary, again binary, times binary")
    back = known.groupBy("part").applyInPandas(counted, "_chunk int, kmers binary, hits binary")
    found = chunks.groupBy("_chunk").cogroup(back.groupBy("_chunk")).applyInPandas(finished, "gene_id string, transcript_id string, shift int, target string, tm double, hits bigint")
    # a target that several genes have at a shift of a transcript counts once there
    once = found.repartition("transcript_id").dropDuplicates(["gene_id", "transcript_id", "shift", "target"])
    first = F.row_number().over(Window.partitionBy("transcript_id", "shift", "target").orderBy("gene_id")) == 1
    here = Window.partitionBy("transcript_id", "shift")
    summed = once.withColumn("_first", first).withColumn("_hits", F.sum(F.when(F.col("_first"), F.col("hits"))).over(here)).withColumn("_n", F.count(F.when(F.col("_first"), F.lit(1))).over(here))
    rare = summed.filter((F.col("_hits") <= F.lit(most * (length - k + 1)) * F.col("_n")) & F.col("gene_id").isNotNull()).select("gene_id", "transcript_id", "shift", "target", "tm")

    def apart(last: int | None, each: pd.DataFrame) -> tuple[int | None, np.ndarray]:
        mask = np.zeros(len(each), bool)
        for i, s in enumerate(each["shift"].to_numpy()):
            if last is None or s == last or s >= last + length:
                mask[i], last = True, s
        return last, mask

    return keep_in_order(rare, ["gene_id", "transcript_id"], ["shift"], apart)
