"""Problems 3, 5 and 6 against brute force and on small cases."""

import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from spotlake.llm.boundary_pieces import natural_boundaries, split_pieces
from spotlake.llm.quantile_digest import ERROR_BOUND, certify, cluster, estimate_quantiles, merge_digests, partial_digests
from spotlake.llm.queries import p3_found, p6_found, p6_shares
from spotlake.llm.shared_spans import shared_spans


def brute_boundaries(rows, limit):
    out = set()
    for i, s in rows:
        s = re.sub(r"\s", "", s or "")
        if len(s) > limit:
            cuts = {m.end() for m in re.finditer(r"[NnXx.\-]{5,}|\|", s)} - {len(s)}
            out |= {(i, c) for c in cuts or {0}}
    return out


def test_boundaries_of_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    t = pd.read_parquet(f"{d}/transcriptome.parquet")
    got = p3_found(spark, d).collect()
    want = brute_boundaries(zip(t.transcript_id, t.sequence), 1500)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def sequences(n=60):
    random.seed(2)
    bits = ["ACGT", "acg", "NNNNN", "nX.-N", "NNNN", "|", "||", " ", "\n", "\u00a0", "-----|"]
    return [(f"t{i}", "".join(random.choice(bits) for _ in range(random.randint(0, 60)))) for i in range(n)]


def test_boundaries_and_pieces_of_odd_sequences(spark):
    rows = [*sequences(), ("none", None), ("empty", ""), ("t0", sequences()[0][1]), ("run", "N" * 100), ("plain", "A" * 95), ("long", "ACGTNNNNNN" * 3000)]
    df = spark.createDataFrame([(i, s, "x", 1) for i, s in rows], "transcript_id string, sequence string, id string, piece int")
    got = natural_boundaries(split_pieces(df, "transcript_id", "sequence", 30, 5), 30).collect()
    assert {tuple(r) for r in got} == brute_boundaries(rows, 30) and len(got) == len(brute_boundaries(rows, 30))
    pieces = split_pieces(df, "transcript_id", "sequence", 30, 5).toPandas().sort_values(["id", "piece"])
    whole = {i: re.sub(r"\s", "", s) for i, s in rows if s}
    assert set(pieces.id) == {i for i, s in whole.items() if len(s) > 30}
    for i, g in pieces.groupby("id"):
        s, end = whole[i], 0
        for k, (a, b, text) in enumerate(zip(g.start_at, g.end_at, g.text)):
            assert 0 < len(text) <= 30 and text == s[a:b] and a == (end - 5 if k else 0) and b > end
            end = b
        assert end == len(s)


def test_pieces_end_at_the_strongest_last_boundary(spark):
    s = "A" * 10 + "|" + "C" * 5 + "NNNNN" + "G" * 30
    df = spark.createDataFrame([("t", s)], "i string, s string")
    got = split_pieces(df, "i", "s", 25, 3).orderBy("piece").collect()
    assert [(r.start_at, r.end_at) for r in got] == [(0, 11), (8, 21), (18, 43), (40, 51)]
    assert split_pieces(df.limit(0), "i", "s", 25, 3).collect() == []
    with pytest.raises(ValueError):
        split_pieces(df, "i", "s", 25, 25)


def measured(spark, n=20_000):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"key": np.where(rng.random(n) < 0.6, 1, rng.integers(2, 40, n)), "day": rng.integers(0, 5, n), "v": rng.lognormal(3, 2, n), "w": rng.integers(0, 3, n).astype(float)})
    pdf.loc[::97, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_percentiles_keep_their_bound_and_days_combine(spark):
    pdf, df = measured(spark)
    qs = [0.01, 0.05, 0.5, 0.95, 0.99]
    days = merge_digests(partial_digests(df, ["key", "day"], ["v", "w"]), ["key", "day", "field"])
    both = [merge_digests(partial_digests(df, ["key"], ["v", "w"]), ["key", "field"]), merge_digests(days, ["key", "field"])]
    for digests in both:
        got = certify(df, estimate_quantiles(digests, qs), ["key"], ["v", "w"], qs).toPandas()
        assert len(got) == 39 * 2 * 5 and got.within_bound.all()
        for r in got.sample(40, random_state=1).itertuples():
            x = pdf.loc[pdf.key == r.key, r.field].dropna()
            assert r.n == len(x)
            error = max(0, (x < r.value).mean() - r.quantile, r.quantile - (x <= r.value).mean())
            assert error == pytest.approx(r.rank_error, abs=1e-9) and error <= ERROR_BOUND + 0.5 / len(x)


def test_digests_of_nothing_nulls_and_one_value(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, float("nan"), 1.0), (2, float("inf"), 1.0), (None, 5.0, 1.0)], "key int, v double, n double")
    got = merge_digests(partial_digests(df, ["key"], ["v"]), ["key", "field"]).collect()
    assert [(r.key, r.n, r.low, r.high, r.means, r.weights) for r in got] == [(None, 1, 5.0, 5.0, [5.0], [1.0])]
    assert merge_digests(partial_digests(df.limit(0), ["key"], ["v"]), ["key", "field"]).collect() == []
    assert estimate_quantiles(merge_digests(partial_digests(df, ["key"], ["v"]), ["key", "field"]), [0.5]).first().estimates == [5.0]


def test_clusters_are_bounded_and_keep_weight():
    v = np.sort(np.random.default_rng(0).random(50_000))
    _, means, weights = cluster(np.zeros(len(v), np.int64), v, np.ones(len(v)), 100)
    assert len(means) <= 101 and weights.sum() == len(v) and (np.diff(means) > 0).all()


def brute_spans(rows, k):
    at = defaultdict(set)
    for i, s in rows:
        for a in range(len(s) - k + 1):
            at[s[a : a + k]].add(i)
    out = set()
    for i, s in rows:
        marks = [False] * (len(s) + 1)
        for a in range(len(s) - k + 1):
            if len(at[s[a : a + k]]) > 1:
                marks[a : a + k] = [True] * k
        a = 0
        for b, m in enumerate(marks):
            if not m:
                if b > a:
                    out.add((i, a, b - a))
                a = b + 1
    return out


def test_spans_of_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    p = pd.read_parquet(f"{d}/probe_dict.parquet").dropna(subset=["target_sequence"])
    want = brute_spans(list(zip(p.probe_id, p.target_sequence)), 40)
    got = p6_found(spark, d).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    shares = p6_shares(spark, d).toPandas()
    assert len(shares) == 2000 and shares.share.between(0, 1).all() and shares.shared.sum() == sum(n for _, _, n in want)


@pytest.mark.parametrize("kw", [{"depth": 14, "anchor": 6}, {"depth": 10, "group": 20, "lengths": (2, 4), "anchor": 10}, {"depth": 64, "group": 3, "lengths": (1, 3, 5), "anchor": 4}, {"anchor": 1, "group": 200}, {"anchor": 8}])
def test_spans_whatever_the_groups(spark, kw):
    random.seed(4)
    base = ["".join(random.choice("ab") for _ in range(30)) for _ in range(3)]
    cut = lambda: random.choice(base)[random.randint(0, 5) : random.randint(8, 30)]
    rows = [(random.randint(1, 60), "".join(cut() for _ in range(random.randint(0, 6)))) for _ in range(200)]
    rows += [(7, "a" * 50), (8, "a" * 30), (9, "c" * 70), (9, "c" * 70), (9, "xc" * 9), (500, None), (501, ""), (502, "é" * 12), (503, "é" * 12), (504, "x" + "éа一b" * 5), (505, "éа一b" * 3 + "y"), (506, "éа一b" * 2)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "id bigint, s string, seq_id int, pos int")
    got = shared_spans(df, "id", "s", least=10, **kw).collect()
    assert {tuple(r) for r in got} == brute_spans([r for r in rows if r[1]], 10)


def test_spans_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, s string")
    assert shared_spans(df, "id", "s").collect() == []
    with pytest.raises(ValueError):
        shared_spans(df, "id", "s", least=10, depth=9)
    with pytest.raises(ValueError):
        shared_spans(df, "id", "s", least=10, anchor=11)
