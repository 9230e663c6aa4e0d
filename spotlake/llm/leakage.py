"""Passages of held-out items inside a corpus (problem 8)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotlake.llm.words import shingle_rows, words
from spotlake.session import cut, measured

#: Words of a shingle, and words in a row that make a leak.
SHINGLE, RUN = 5, 10


def shingles(df: DataFrame, id_column: str, text: str, width: int = SHINGLE) -> DataFrame:
    """id, pos, h: a 64-bit hash of every *width* words in a row of every text. Rows stay in their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for row, pos, h in shingle_rows(batch.column(1), width):
                for a in range(0, len(row), 1 << 18):
                    b = a + (1 << 18)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[a:b])), pa.array(pos[a:b]), pa.array(h[a:b])], ["id", "pos", "h"])

    return df.select(F.col(id_column).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "id bigint, pos int, h bigint")


def leaked_items(corpus: DataFrame, corpus_id: str, corpus_text: str, items: DataFrame, item_id: str, item_text: str, run: int = RUN, width: int = SHINGLE) -> DataFrame:
    """Distinct (doc, item) that have at least *run* words in a row in common.

    A window of *run* words of an item is a set of run - width + 1 shingles, all of which a leak must hold, so one of them is the
    necessary prefix: the rarest in the corpus, counted over all of it. Documents join the prefix shingles only; the position of the prefix
    in its window bounds where the leak begins, the shingles at the other positions of the window must be there as
    well, and at last the words themselves are compared.

    The corpus' shingles that some item has are kept in a table in the shared folder, so the corpus is hashed once and read
    once more for the comparison. Items are broadcast only while they are measured to be small. Null, empty and short texts hold
    no window and give nothing; repeated rows and several leaks of an item give one row.
    """
    per_window = run - width + 1
    item_rows = cut(shingles(items, item_id, item_text, width))
    known = cut(item_rows.select("h").distinct())
    kept = cut(shingles(corpus, corpus_id, corpus_text, width).join(measured(known), "h", "left_semi"))
    rarity = kept.groupBy("h").agg(F.count(F.lit(1)).alias("n"))

    placed = item_rows.join(rarity, "h").select(F.col("id").alias("item"), "pos", "h", "n")
    window = placed.select(
        "item", F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - (per_window - 1)), F.col("pos"))).alias("begin"), "pos", "h", "n"
    )
    whole = window.groupBy("item", "begin").agg(
        F.count(F.lit(1)).alias("found"),
        F.min(F.struct("n", "h", (F.col("pos") - F.col("begin")).alias("shift"))).alias("prefix"),
        F.sort_array(F.collect_list(F.struct("pos", "h"))).alias("all"),  # at most per_window shingles for each row of the item
    )
    windows = cut(whole.filter(F.col("found") >= per_window).select("item", "begin", F.col("prefix.h").alias("h"), F.col("prefix.shift").alias("shift"), F.array_distinct(F.transform("all", lambda s: F.struct((s["pos"] - F.col("begin")).alias("shift"), s["h"].alias("h")))).alias("expected")))

    candidates = kept.join(measured(windows), "h").select(F.col("id").alias("doc"), (F.col("pos") - F.col("shift")).alias("at"), "item", "begin", "expected").filter("at >= 0")
    needed = candidates.select("doc", "item", "at", "begin", F.explode("expected").alias("e")).select("doc", "item", "at", "begin", (F.col("at") + F.col("e.shift")).alias("pos"), F.col("e.h").alias("h"))
    met = needed.join(kept.select(F.col("id").alias("doc"), "pos", "h").distinct(), ["doc", "pos", "h"])
    likely = met.groupBy("doc", "item", "at", "begin").agg(F.count_distinct("pos").alias("held")).filter(F.col("held") == per_window)
    first = cut(likely.groupBy("doc", "item").agg(F.min(F.struct("at", "begin")).alias("w")).select("doc", "item", "w.at", "w.begin"))

    return _verified(corpus, corpus_id, corpus_text, items, item_id, item_text, first, run)


def _verified(corpus: DataFrame, corpus_id: str, corpus_text: str, items: DataFrame, item_id: str, item_text: str, windows: DataFrame, run: int) -> DataFrame:
    """The windows (doc, item, at, begin) whose words are the same in the two texts."""
    mine = windows.groupBy("item").agg(F.collect_set("begin").alias("begins"))  # bounded by the windows of an item
    read = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))

    def cut_out(texts: pd.Series, places: pd.Series) -> pd.Series:
        made = []
        for t, ps in zip(texts, places):  # the words of one text at a time
            w = words(t)
            made.append([{"at": int(p), "passage": " ".join(w[p : p + run])} for p in ps])
        return pd.Series(made)

    passages = F.pandas_udf(cut_out, "array<struct<at:int,passage:string>>")
    wanted = read.join(mine, "item").select("item", F.explode(passages("text", "begins")).alias("p")).select("item", F.col("p.at").alias("begin"), F.col("p.passage").alias("wanted")).distinct()

    spots = cut(windows.groupBy("doc").agg(F.collect_set("at").alias("places")))  # one window for each item of the document
    texts = corpus.select(F.col(corpus_id).alias("doc"), F.col(corpus_text).alias("text"))
    there = texts.join(measured(spots), "doc").select("doc", F.explode(passages("text", "places")).alias("p")).select("doc", F.col("p.at").alias("at"), F.col("p.passage").alias("there")).distinct()
    return windows.join(there, ["doc", "at"]).join(wanted, ["item", "begin"]).filter("there = wanted").select("doc", "item").distinct()
