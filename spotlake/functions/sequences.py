"""Expressions on nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements of the letters, ambiguity codes included.
LETTERS, COMPLEMENTS = "ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd"

#: Nearest-neighbour enthalpy (kcal/mol) and entropy (cal/mol K) of Allawi and SantaLucia 1997, both strands' spelling.
NEIGHBOURS = {
    "AA": (-7.9, -22.2), "TT": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3),
    "CA": (-8.5, -22.7), "TG": (-8.5, -22.7), "GT": (-8.4, -22.4), "AC": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "AG": (-7.8, -21.0), "GA": (-8.2, -22.2), "TC": (-8.2, -22.2),
    "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9), "CC": (-8.0, -19.9),
}
#: Enthalpy and entropy of an end with A or T, and with G or C; the gas constant (cal/mol K).
END_AT, END_GC, GAS = (2.3, 4.1), (0.1, -2.8), 1.987


def revcomp(c: Column) -> Column:
    """Reverse complement; unknown letters stay."""
    return F.translate(F.reverse(c), LETTERS, COMPLEMENTS)


def gc_share(c: Column) -> Column:
    """Share of G and C, in either case; null for empty text."""
    return F.try_divide(F.length(c) - F.length(F.regexp_replace(c, "[GCgc]", "")), F.length(c))


def melting_temperature(c: Column, na_molar: float = 0.33, strand_nm: float = 25.0, formamide: float = 0.0) -> Column:
    """Melting temperature in degrees Celsius of a DNA of plain capital letters: nearest neighbours, salt entropy, 0.65 degrees a percent of formamide."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))
    table = lambda k: F.create_map(*[x for d, v in NEIGHBOURS.items() for x in (F.lit(d), F.lit(v[k]))])
    ends = lambda k: F.aggregate(F.array(F.substring(c, 1, 1), F.substring(c, -1, 1)), F.lit(0.0), lambda a, e: a + F.when(e.isin("A", "T"), END_AT[k]).otherwise(END_GC[k]))
    total = lambda k: F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.element_at(table(k), p)) + ends(k)
    entropy = total(1) + 0.368 * (F.length(c) - 1) * F.log(F.lit(na_molar))
    return F.when(F.length(c) > 1, 1000 * total(0) / (entropy + GAS * F.log(F.lit(strand_nm / 2 * 1e-9))) - 273.15 - 0.65 * formamide)


def pack(c: Column) -> Column:
    """Up to 31 letters as a whole number, two bits a letter, the first highest; letters other than ACGT count as A."""
    digits = F.translate(F.regexp_replace(F.upper(c), "[^ACGT]", "A"), "ACGT", "0123")
    return F.conv(digits, 4, 10).cast("bigint")


def pack_base5(c: Column) -> Column:
    """Up to 27 letters as a whole number of base 5: a, c, g, t are 1 to 4, others 0; the first letter lowest."""
    digits = F.translate(F.regexp_replace(F.lower(F.reverse(c)), "[^acgt]", "n"), "acgtn", "12340")
    return F.conv(digits, 5, 10).cast("bigint")


def kmers(c: Column, k: int, step: int = 1) -> Column:
    """The k-mers of a sequence, every *step* letters; empty if it is shorter."""
    last = F.length(c) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda i: F.substring(c, i + 1, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def has_site(c: Column, sites: list[str]) -> Column:
    """Whether a sequence holds one of the sites on either strand, in any case."""
    up = F.upper(c)
    found = F.lit(False)
    for s in sites:
        found |= F.contains(up, F.lit(s.upper())) | F.contains(up, revcomp(F.lit(s.upper())))
    return found


def case_runs(c: Column) -> Column:
    """A sequence split where its case changes."""
    return F.regexp_extract_all(c, F.lit("[A-Z]+|[a-z]+"), F.lit(0))


def alternate_case(parts: Column) -> Column:
    """Parts joined, in capitals and small letters by turns."""
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, F.upper(p)).otherwise(F.lower(p))), "")


def wrap(c: Column, width: int = 80) -> Column:
    """Text with a line end after every *width* letters."""
    return F.regexp_replace(c, rf"(.{{{width}}})(?=.)", "$1\n")
