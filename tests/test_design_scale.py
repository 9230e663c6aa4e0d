"""Designs over k-mers of all sequences: no side is broadcast by its guessed size, and odd transcripts give the rows of the SQL."""

import random

import __spark_entry__ as entry
import duckdb
import pytest
from oracle import connect, differences

from spotlake.operators import designs as de


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Transcripts that share ids, shifts, stretches and genes; some without gene or id, some with other letters or none."""
    d, rng = tmp_path_factory.mktemp("odd"), random.Random(5)
    text = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    whole = text(1500)
    rows = [(f"T{i}", f"G{i % 7}", text(rng.randint(10, 900))) for i in range(40)]
    rows += [("T1", "G1", text(700)), ("T1", "G9", rows[1][2]), ("T2", "G2", text(800)), (None, "G3", text(600)), ("T50", None, text(600)), ("T1", None, text(500))]
    rows += [(f"T{60 + i}", f"G{20 + i}", whole[100 * i : 100 * i + 700]) for i in range(6)] + [("T70", "G30", None), ("T71", "G31", ""), ("T72", "G32", "acgun " * 90), ("T73", "G33", "A" * 300)]
    rows += [("T74", "G34", whole[:60]), ("T75", None, whole[:700]), (None, "G40", whole[300:900])]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (transcript_id VARCHAR, gene_id VARCHAR, gene_short_name VARCHAR, sequence VARCHAR, FPKM DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, 'x', ?, 1.0)", rows)
    con.execute("INSERT INTO t SELECT transcript_id, gene_id, 'y', sequence, 2.0 FROM t WHERE transcript_id IN ('T3', 'T4', 'T5')")
    con.execute(f"COPY t TO '{d}/transcriptome.parquet' (FORMAT parquet)")
    return str(d)


def same(spark, d, name):
    return differences(spark, connect(d), d, entry.queries()[name], entry.oracle_sql()[name])


def broadcasts(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("BroadcastExchange")


def test_design_pipeline_of_odd_transcripts(spark, odd):
    assert same(spark, odd, "design_pipeline") is None


def test_design_pipeline_broadcasts_nothing(spark, sf):
    assert broadcasts(entry.queries()["design_pipeline"](spark, sf)) == 0


def test_pair_windows_of_odd_transcripts(spark, odd):
    assert same(spark, odd, "probe_pair_windows") is None


def test_pair_windows_in_many_chunks(spark, sf, monkeypatch):
    want = sorted(map(tuple, entry.queries()["probe_pair_windows"](spark, sf).collect()))
    for name, size in (("PAIRS_CHUNK", 20_000), ("GENES_CHUNK", 30_000), ("SLICE", 700)):
        monkeypatch.setattr(de, name, size)
    assert sorted(map(tuple, entry.queries()["probe_pair_windows"](spark, sf).collect())) == want != []


def test_pair_windows_broadcast_nothing(spark, sf):
    assert broadcasts(entry.queries()["probe_pair_windows"](spark, sf)) == 0
