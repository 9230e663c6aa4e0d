"""Splitting oversized sequences at natural boundaries, with overlap (problem 3)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The letters of a gap, how many of them make a boundary, and the junction mark.
GAP, GAP_RUN, JUNCTION = r"[NnXx.\-]", 5, r"\|"
#: Places at which a sequence may be cut, the strongest first: after a junction mark, after a whole run of gap letters.
BOUNDARIES = [rf"(?<={JUNCTION})", rf"(?<={GAP}{{{GAP_RUN}}})(?!{GAP})"]
#: White space of any script, which is no part of a sequence.
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def letters(c: Column) -> Column:
    """The sequence without white space."""
    return F.regexp_replace(c, _SPACE, "")


def _up_to(least: int, most: int) -> str:
    """The longest stretch of *least* to *most* letters that ends the text, else at the strongest boundary, else anywhere."""
    return "|".join([rf".{{1,{most}}}\z", *(rf".{{{least},{most}}}{b}" for b in BOUNDARIES), rf".{{1,{most}}}"])


def _running(sizes: pd.Series) -> pd.Series:
    return sizes.map(np.cumsum)


def split_pieces(df: DataFrame, id_column: str, sequence: str, limit: int, overlap: int) -> DataFrame:
    """Ordered pieces of at most *limit* letters of each sequence longer than that: id, piece, start_at, end_at, text.

    A regular expression whose alternatives are ordered by the strength of the boundary consumes up to the limit, any letter being the
    fallback; every piece after the first looks *overlap* letters back from the end of the one before, by a second look at the same
    matches. The pieces cover the sequence, and the work is in proportion to its length. Work is local to the row except for merging repeated rows. Null,
    empty and short sequences give nothing; a transcript with two different sequences gives the pieces of both.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be under the limit")
    seq = df.select(F.col(id_column).alias("id"), letters(F.col(sequence)).alias("seq"))
    once = seq.filter(F.length("seq") > limit).distinct()
    first, later = _up_to(overlap + 1, limit), _up_to(1, limit - overlap)
    parts = F.regexp_extract_all("seq", F.lit(rf"(?s)\A(?:{first})|(?:{later})"), F.lit(0))
    before = F.regexp_extract_all("seq", F.lit(rf"(?s)\A(?:{first})|(?<=(.{{{overlap}}}))(?:{later})"), F.lit(1))
    cut = once.select("id", parts.alias("part"), before.alias("before"))
    ends = F.pandas_udf(_running, "array<int>")(F.transform("part", F.length))  # the lengths only leave the JVM
    span = cut.withColumn("end_at", ends).select("id", F.posexplode(F.arrays_zip("part", "before", "end_at")).alias("piece", "p"))
    text = F.concat("p.before", "p.part")
    return span.select("id", "piece", (F.col("p.end_at") - F.length(text)).alias("start_at"), F.col("p.end_at").alias("end_at"), text.alias("text"))


def natural_boundaries(pieces: DataFrame, limit: int) -> DataFrame:
    """Every natural boundary inside the sequences of *pieces*, which overlap by more than GAP_RUN letters: id, cut_at (letters before it); 0 where there is none.

    The pieces of split_pieces() are taken apart by the same bounded extraction, consuming as little as possible up to the next
    boundary of any strength; parts that end at the fallback are no boundaries. A boundary at a piece's end shows in the next piece,
    which begins before it and holds the letter after it, so the end of the sequence is none.
    """
    pattern = rf"(?s).{{1,{limit}}}?(?:{'|'.join(BOUNDARIES)})|.{{1,{limit}}}"
    start = F.array().cast("array<int>")
    sizes = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.length)
    ends = F.aggregate(sizes, start, lambda done, n: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)))  # of one piece, so bounded by the limit
    inner = F.filter(ends, lambda e: e < F.length("text"))
    # whether a part ends at a boundary is seen in its last letters and the one after it
    near = lambda e: F.substring(F.col("text"), F.greatest(e - GAP_RUN, F.lit(0)) + 1, F.least(e, F.lit(GAP_RUN)) + 1)
    whole = rf"(?s)\A(?:.*{JUNCTION}.|{GAP}{{{GAP_RUN}}}(?!{GAP}).)\z"
    cuts = F.transform(F.filter(inner, lambda e: near(e).rlike(whole)), lambda e: e + F.col("start_at"))
    found = pieces.select("id", F.explode(F.when(F.col("piece") == 0, F.concat(F.array(F.lit(0)), cuts)).otherwise(cuts)).alias("cut_at")).distinct()
    return found.withColumn("last", F.max("cut_at").over(Window.partitionBy("id"))).filter("cut_at > 0 OR last = 0").drop("last")
