"""Pages made of repeated keywords, bare lists of links or product tags (problem 9)."""

from __future__ import annotations

import math
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.session import cut

#: Words of a block; a rest of less than half of them joins the block before.
BLOCK_WORDS = 200
#: A block is prose, and counts for the expected ratios, from this many sentence ends a word.
PROSE_ENDS = 0.03
#: A block is redundant if its ratio, divided by that of prose of its length and language, is under this; prose and data stay around 1.
REDUNDANT = 0.93
#: A redundant block is confirmed as stuffed if it has at most this many sentence ends a word.
CONFIRMED_ENDS = 0.02
#: A text of fewer words is a stub and gets no verdict.
LEAST_WORDS = 30
#: Length classes for each doubling of the length.
CLASSES = 8
#: Blocks of prose that a language needs at a length; else those of all languages at the nearest length count.
LEAST_PROSE = 30
#: The share of a document's words in stuffed blocks above which it is a case.
SHARE = 0.5

BLOCK_TYPE = "array<struct<script:string,size:int,words:int,ratio:double,ends:double>>"

_WORD = re.compile(r"[^\W_]+")
_COMMAND = re.compile(r"\\[A-Za-z]+")
#: Commands whose arguments name files, packages, labels or references; those are no words of the text.
_NAMES = re.compile(r"\\(?:input|include|subfile|import|includegraphics|usepackage|bibliography|bibliographystyle|label|(?:page|eq|auto|c)?ref|[a-z]*cite[a-z]*)\*?\s*(?:\[[^\]]*\]\s*)*\{[^{}]*\}")
_URL = re.compile(r"(https?)://[^\s{}<>]*")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
#: A sentence ends at a mark before a capital letter, a command, an opening or the end of the line.
_SENTENCE = re.compile(r"[.!?][)}\]]*(?:\s+(?=[A-ZÀ-Þ\\\d\"“`({\[%])|\s*$)|[。！？]|\.(?=[\\}])")
_DISPLAY = re.compile(r"\\begin\{(equation|align|gather|multline|eqnarray)(\*?)\}.*?\\end\{\1\2\}|\\\[.*?\\\]", re.S)
_PREAMBLE = re.compile(r"^\s*\\(?:documentclass|usepackage|newcommand|renewcommand|newenvironment|DeclareMathOperator|def|let|title|author|date)\b.*$", re.M)
_BEGIN, _END = r"\begin{document}", r"\end{document}"


def body(text: str) -> str:
    """The text without preamble, title, displayed formulas and names of files and labels."""
    _, found, rest = text.partition(_BEGIN)
    return _NAMES.sub(" ", _DISPLAY.sub(" ", _PREAMBLE.sub("", (rest if found else text).replace(_END, ""))))


def blocks(text: str) -> list[str]:
    """The body in blocks of about BLOCK_WORDS words, cut at line ends and within long lines."""
    out: list[str] = []
    held: list[str] = []
    n = 0
    for line in body(text).split("\n"):
        size = len(_WORD.findall(_COMMAND.sub(" ", line)))
        parts = [line]
        if size > BLOCK_WORDS:
            tokens = line.split(" ")
            step = max(1, len(tokens) * BLOCK_WORDS // size)
            parts = [" ".join(tokens[k : k + step]) for k in range(0, len(tokens), step)]
        for part in parts:
            held.append(part)
            n += size if part is line else len(_WORD.findall(_COMMAND.sub(" ", part)))
            if n >= BLOCK_WORDS:
                out.append("\n".join(held))
                held, n = [], 0
    if n >= BLOCK_WORDS // 2 or (n and not out):
        out.append("\n".join(held))
    elif n:
        out[-1] += "\n" + "\n".join(held)
    return out


def measure(block: str) -> dict | None:
    """Script, length class, words, compression ratio and sentence ends a word of one block; addresses compress as their scheme."""
    words = len(_WORD.findall(_COMMAND.sub(" ", block)))
    if not words:
        return None
    plain = " ".join(_WORD.findall(_COMMAND.sub(" ", _URL.sub(r"\1", block)).lower())).encode()
    ratio = (len(zlib.compress(plain, 6)) - 8) / max(1, len(plain))
    script = "cjk" if len(_CJK.findall(block)) * 5 > len(block) else "other"
    return {"script": script, "size": round(CLASSES * math.log2(max(1, len(plain)))), "words": words, "ratio": ratio, "ends": len(_SENTENCE.findall(block)) / words}


def _measured(texts: pd.Series) -> pd.Series:
    return pd.Series([[m for b in blocks(t or "") if (m := measure(b))] for t in texts])


def block_measures(df: DataFrame, id_column: str, text: str, lang: str) -> DataFrame:
    """A row for each block: id, lang (two letters or 'xx'), script, size (class of the length), words, ratio, ends."""
    lang_key = F.regexp_extract(F.lower(F.coalesce(F.col(lang), F.lit(""))), r"^\s*([a-z]{2})(?![a-z])", 1)
    made = df.filter(F.col(text).isNotNull()).select(
        F.col(id_column).alias("id"), F.when(lang_key == "", "xx").otherwise(lang_key).alias("lang"), F.explode(F.pandas_udf(_measured, BLOCK_TYPE)(text)).alias("b")
    )
    return made.select("id", "lang", "b.*")


def stuffed_share(df: DataFrame, id_column: str, text: str, lang: str) -> DataFrame:
    """id, words and stuffed_share (of the words) of every document with at least LEAST_WORDS words outside preamble and title.

    Each block's compression ratio is divided by the median ratio of prose blocks of the same length and language in the
    whole corpus. Blocks that are far more redundant than such prose are flagged, and those of them that hardly have sentence ends are stuffed.
    Block measures are kept in the shared folder (a few numbers for every 200 words), so texts are read once. The tables of expected ratios are
    bounded by languages (two letters), scripts and length classes (CLASSES for each doubling), whatever the corpus' size, and so are their
    broadcasts. Null, empty and blank texts and stubs give no row; whole texts are measured; repeated rows of an id count together.
    """
    made = cut(block_measures(df, id_column, text, lang))
    prose = made.filter(F.col("ends") >= PROSE_ENDS)
    median = F.percentile_approx("ratio", 0.5, 10_000)
    by_lang = prose.groupBy("lang", "script", "size").agg(median.alias("own"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_PROSE).drop("n")
    overall = prose.groupBy("script", "size").agg(median.alias("any")).groupBy("script").agg(F.sort_array(F.collect_list(F.struct("size", "any"))).alias("lengths"))
    nearest = F.array_min(F.transform("lengths", lambda x: F.struct(F.abs(x["size"] - F.col("size")).alias("off"), x["any"].alias("any"))))
    rated = (
        made.join(F.broadcast(by_lang), ["lang", "script", "size"], "left")
        .join(F.broadcast(overall), "script", "left")
        .withColumn("normal", F.col("ratio") / F.coalesce("own", nearest["any"], F.lit(1.0)))
    )
    stuffed = (F.col("normal") < REDUNDANT) & (F.col("ends") <= CONFIRMED_ENDS)
    per_text = rated.groupBy("id").agg(F.sum("words").alias("words"), F.sum(F.when(stuffed, F.col("words")).otherwise(0)).alias("held"))
    return per_text.filter(F.col("words") >= LEAST_WORDS).select("id", "words", (F.col("held") / F.col("words")).alias("stuffed_share"))
