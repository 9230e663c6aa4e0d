"""Operators against brute force and on odd input: nulls, ties, repeated rows, empty tables, clashing names."""

import random
import re
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlake import session
from spotlake.functions.sequences import melting_temperature
from spotlake.operators import cells, decoding, designs, graphs, groups, models, ranking, stats, tiles
from spotlake.operators.proximity import region_parts
from spotlake.sources import layout


def test_exact_quantiles_of_skewed_keys(spark):
    random.seed(1)
    rows = [(random.choice([1, 1, 1, 2, None]), random.choice([0.0, 1.5, random.random(), float("nan"), None]), "x") for _ in range(400)] + [(3, 7.0, "x"), (4, None, "x")]
    got = {r.k: (r.low, r.high) for r in ranking.exact_quantiles(spark.createDataFrame(rows, "k int, v double, _m string"), ["k"], "v", {"low": 0.05, "high": 0.95}).collect()}
    for k in (1, 2, 3, None):
        v = [b for a, b, _ in rows if a == k and b is not None and b == b]
        assert got[k] == pytest.approx((np.quantile(v, 0.05), np.quantile(v, 0.95)))
    assert 4 not in got


def test_keep_greedy_is_the_walk_in_order(spark):
    random.seed(2)
    n = 60
    edges = {tuple(sorted(random.sample(range(n), 2))) for _ in range(140)}
    rank = random.sample(range(1000), n + 3)
    kept = []
    for i in sorted(range(n), key=lambda i: -rank[i]):
        if not any((min(i, j), max(i, j)) in edges for j in kept):
            kept.append(i)
    nodes = spark.createDataFrame([(i, rank[i]) for i in range(n + 3)], "id int, rank int")
    df = spark.createDataFrame([*edges, *list(edges)[:5]], "a int, b int")
    assert {r.id for r in graphs.keep_greedy(nodes, df).collect()} == set(kept) | {n, n + 1, n + 2}
    assert {r.id for r in graphs.keep_greedy(nodes, df.limit(0)).collect()} == set(range(n + 3))


def test_adjust_within_null_keys_and_ties(spark):
    rows = [(None, 0.2), (None, 0.2), (1, 0.5), (1, None), (1, 0.01), (1, 0.01)]
    got = sorted((r.k is None, r.p is None, r.p or 0, r.q) for r in stats.adjust(spark.createDataFrame(rows, "k int, p double"), ["k"], "p").collect() if r.p is not None)
    assert [round(x[3], 9) for x in got] == [0.015, 0.015, 0.5, 0.2, 0.2]
    assert stats.adjust(spark.createDataFrame([], "k int, p double"), ["k"], "p").collect() == []


def test_choice_by_coverage(spark):
    random.seed(3)
    rows = [(k, i, random.randint(0, 40), "A" * random.randint(5, 12)) for i, k in enumerate("a" * 12 + "b" * 2)] + [("a", 90, None, "A"), (None, 91, 1, "A"), ("c", 92, 1, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "t string, i int, s int, q string, a int, covered int")
    import hashlib

    want = set()
    for t in "ab":
        left = {i: [0, hashlib.md5(f"5-{i}".encode()).hexdigest(), s, s + len(q)] for k, i, s, q in rows if k == t and s is not None and q is not None}
        for place in range(3):
            if left:
                best = min(left, key=lambda i: (left[i][0], left[i][1], i))
                _, _, a, b = left.pop(best)
                want.add((t, best, place))
                for x in left.values():
                    x[0] += max(0, min(b, x[3]) - max(a, x[2]))
    got = designs.choose_by_coverage(df, "t", "i", "s", "q", 3, 5).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert designs.choose_by_coverage(df.limit(0), "t", "i", "s", "q", 3, 5).collect() == []


def test_broken_runs(spark):
    random.seed(4)
    seqs = ["".join(random.choice("ACGT") * random.randint(1, 9) for _ in range(random.randint(0, 12))) for _ in range(200)] + ["AAAAAAA", "A" * 100, ""]
    df = spark.createDataFrame([(s,) for s in seqs] + [(None,)], "s string")
    got = df.select("s", designs.break_runs(F.col("s")).alias("t")).collect()
    for r in got:
        assert (r.s is None and r.t is None) or (len(r.s) == len(r.t) and not re.search("A{4}|C{4}|G{6}|T{6}", r.t))
    assert {r.s: r.t for r in got}["AAAAAAA"] == "AATAAAT"


def test_pads_tails_and_ends(spark):
    df = spark.createDataFrame([("acg", 12), ("ACg", 6), ("ACG", 3), ("", 4), (None, 4)], "s string, n int")
    got = [r.p for r in df.select(designs.padded(F.col("s"), F.col("n"), "CCCCCTTTT").alias("p")).collect()]
    assert got == ["CCCCC" + "acg" + "TTTT", "ccc" + "ACg", "ACG", "CCCC", None]
    rows = spark.createDataFrame([("g", i, [3, 7]) for i in range(6)] + [("h", 9, []), ("h", 10, [1])], "g string, i int, b array<int>")
    assert {(r.i, r.bit) for r in designs.tails_in_turn(rows, "g", "i", "b", 2).collect()} == {(0, 3), (1, 7), (2, 3), (3, 7), (10, 1)}
    ends = spark.createDataFrame([("ACGTACGTACGTACGTACGT",), (None,)], "s string").select(*designs.self_cleaving(F.col("s"))).collect()
    assert ends[0].behind.endswith("acgtacgtacgtacg") and ends[1].behind is None


def test_ligation_arms_meet_their_limits(spark):
    random.seed(6)
    seqs = [(i, "".join(random.choice("ACGT") for _ in range(200)), "t") for i in range(20)] + [(90, None, "t"), (91, "", "t"), (92, "N" * 100, "t"), (93, "ACGT", "t")]
    df = spark.createDataFrame(seqs, "i int, s string, target string")
    arms = designs.ligation_arms(df, "s", "i")
    rated = arms.select("*", melting_temperature(F.col("left_arm")).alias("l"), melting_temperature(F.col("right_arm")).alias("r")).collect()
    assert len(rated) > 5 and all(abs(x.l - x.r) <= 5 and min(x.l, x.r) >= 47 and len(x.left_arm + x.right_arm) == 60 and x.shift % 60 == 0 for x in rated)
    assert designs.ligation_arms(df.limit(0), "s", "i").collect() == []


def test_pair_windows_drop_what_another_gene_holds(spark):
    random.seed(7)
    a, b = ("".join(random.choice("ACGT") for _ in range(60)) for _ in range(2))
    rows = [("g1", "t1", a + b), ("g2", "t2", "ACGTAC" + a[5:20] + "TT" + a[40:55]), ("g3", "t3", b[:20]), (None, "t4", a), ("g5", None, None), ("g6", "t6", "")]
    df = spark.createDataFrame(rows, "g string, t string, s string")
    got = {(r.t, r.shift) for r in designs.pair_windows(df.filter("g IS NOT NULL AND t IS NOT NULL"), "g", "s", "t", gc=(0.0, 1.0)).collect()}
    assert got == {("t1", 60)}  # the first window meets g2 with both halves, the second g3 with one


def test_images_of_tiles(spark):
    catalog = spark.createDataFrame([("r", f, k, f"r_{f}_{k}.tif") for f in (1, 2) for k in (0, 1)] + [(None, 3, 0, "x")], "prefix string, fov int, round int, path string")
    rows = [(1, "r", " Ch1 ", "ro", "560", 0, "A"), (2, "r", "ch2", "ro", None, 0, "a"), (3, "r", None, None, "650", 1, "a"), (4, None, "ch1", "x", "y", 0, "a"), (5, "r", "ch9", "x", "y", None, "a")]
    dorg = spark.createDataFrame(rows, "dorg_row int, run_id string, channelName string, readoutName string, color string, imagingRound int, imageType string")
    files = tiles.file_map(catalog, dorg)
    assert files.count() == 4 and {r.fov for r in tiles.without_last_tile(files).collect()} == {1}
    images = tiles.tile_images(files, dorg)
    assert {(r.fov, r.image_idx, r.dorg_row, r.channel) for r in images.collect()} == {(f, i, i + 1, c) for f in (1, 2) for i, c in enumerate(("ch1", "ch2", None))}
    assert {(r.fov, r.place) for r in tiles.concatenated(images).collect()} == {(1, 0), (1, 1), (1, 2), (2, 3), (2, 4), (2, 5)}
    parts = tiles.rolled(tiles.unrolled(images)).collect()
    assert {(r.channel_no, r.plane_no, r.image_idx) for r in parts} == {(0, 0, 0), (1, 0, 1)} and len(parts) == 4
    assert tiles.subset(images, "channel", dorg.select(F.lit("ch2").alias("channel"))).count() == 2
    assert tiles.tile_images(tiles.file_map(catalog.limit(0), dorg), dorg).collect() == []


WKT = [("a", 0.0, "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,4 2,4 4,2 4,2 2))"), ("b", 0.0, "multipolygon (((0 0, 8 0, 8 8, 0 8)), ((1 1, 2 1, 2 2)))"), ("c", 0.0, " POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))"), ("d", 0.0, None), ("e", 0.0, ""), ("f", 0.0, "POLYGON EMPTY"), ("g", 0.0, "POLYGON((1 x, 2 2, 3 3))")]


def test_polygons_exchanged_and_compared(spark):
    df = spark.createDataFrame([(*r, 1) for r in WKT], "id string, z double, w string, area int")
    written = cells.to_geojson(df, "id", "w", "z")
    back = cells.from_geojson(written.unionByName(spark.createDataFrame([("x", 0.0, "{"), ("y", 0.0, '{"type":"Point"}'), ("n", 0.0, None)], written.schema)), "id", "z")
    assert sorted((r.id, r.corners, r.area) for r in back.collect()) == [("a", 8, 96.0), ("b", 3, 0.5), ("b", 4, 64.0), ("c", 8, 96.0)]
    assert {(r.id, r.same_as) for r in cells.equal_classes(df, "id", "w", "z").collect()} >= {("a", "a"), ("c", "a"), ("b", "b")}
    parts = region_parts(df, "id", "w", "z")
    assert {r.region_id for r in cells.interior_parts(parts, "z").collect()} == {"b"}
    box = {r.region_id: (r.min_x, r.max_x, r.min_y, r.max_y) for r in cells.transformed(parts, "z", (0, -1, 10, 2, 0, -5)).collect()}
    assert box["a"] == (0.0, 10.0, -5.0, 15.0)
    assert cells.to_geojson(df.limit(0), "id", "w", "z").collect() == []


def test_labels_chained_through_planes(spark):
    pixels = spark.createDataFrame([(1, 0.0, p) for p in "abcd"] + [(7, 1.5, p) for p in "bcde"] + [(8, 3.0, p) for p in "cde"] + [(9, 3.0, "z"), (5, 4.0, "y")], "label int, z double, place string")
    chains = {(r.label, r.z): r.chain for r in cells.label_chains(pixels, models.label_overlaps(pixels, 1.5, 0.2), 1.5).collect()}
    assert chains[1, 0.0] == chains[7, 1.5] == chains[8, 3.0] == "1@0" and chains[9, 3.0] == "9@2" and len(chains) == 5


def test_groups_of_nothing_and_one_cell(spark):
    counts = spark.createDataFrame([(1, 5, 3), (2, 5, 3), (3, 6, 1)], "cell int, gene int, n int")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "cell int, grp int")
    got = groups.bootstrap_differential(counts, labels, 0, 2, 4).collect()
    assert [(r.grp, r.gene, r.ratio, r.z, round(r.p, 6)) for r in got] == [(1, 5, 1.0, 0.0, 1.0)]
    assert groups.bootstrap_differential(counts, labels.limit(0), 0, 2, 4).collect() == []
    pairs = groups.correlation_p(counts, labels, 4).collect()
    assert [(r.a, r.b, r.corr) for r in pairs] == [(0, 1, None)]


def test_covariances_and_divergence(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0.5, 3]])
    df = spark.createDataFrame([("a", *map(float, r)) for r in x] + [("b", 1.0, 1.0, 1.0), ("b", None, 1.0, 1.0), ("b", float("nan"), 1.0, 1.0)], "k string, x double, y double, z double")
    made = groups.covariances(df, ["k"], ["x", "y", "z"])
    a = made.filter("k = 'a'").first()
    c = np.cov(x.T, bias=True)
    inverse = np.linalg.inv(c)
    assert [a.xx, a.yz, a.det, a.ixy, a.izz] == pytest.approx([c[0, 0], c[1, 2], np.linalg.det(c), inverse[0, 1], inverse[2, 2]])
    same = made.alias("p").join(made.alias("q")).filter("p.k = 'a' AND q.k = 'a'").select(groups.divergence("p", "q").alias("kl")).first()
    assert same.kl == pytest.approx(0, abs=1e-9) and made.filter("k = 'b'").first().ixx is None


def test_codes_in_parts_give_the_same_nearest(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, rng.random(4).tolist()) for i in range(30)] + [(99, [0.0] * 4)], "i int, t array<double>")
    codes = spark.createDataFrame([(i, rng.random(4).tolist()) for i in range(11)], "c int, v array<double>")
    one = sorted(map(tuple, decoding.nearest_code(df, "i", "t", codes, "c", "v", 0.4).collect()))
    monkeypatch.setattr(decoding, "CODES_AT_ONCE", 3)
    assert sorted(map(tuple, decoding.nearest_code(df, "i", "t", codes, "c", "v", 0.4).collect())) == one
    monkeypatch.setattr(decoding, "CODES_IN_ROW", 3)
    assert decoding.nearest_code_sql(df, "i", "t", codes, "c", "v").count() == 31
    assert decoding.nearest_code(df, "i", "t", codes.limit(0), "c", "v").collect() == []


def test_frame_description_as_cameras_write_it(spark):
    lines = ["information file for", "data type = 16 bit integers (binary, big endian)", "frame dimensions = 2048 x 1024", "number of frames = 9", "Stage X = -12.5", "Stage Y = 3", "Lock Target = 0.0", "scalemax = 900"]
    df = spark.createDataFrame([("a", t) for t in lines] + [("b", "x (little endian)"), ("c", None)], "path string, value string")
    got = {r.path: r for r in layout.parse_frame_info(df).collect()}
    assert tuple(got["a"])[1:] == (2048, 1024, 9, "big", -12.5, 3.0, 0.0, 900.0, None)
    assert (got["b"].endian, got["b"].width, got["b"].frames, got["c"].endian) == ("little", 256, None, None)


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda _: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077", setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError):
        session.shared_checkpoints(SimpleNamespace(sparkContext=sc))
    sc.master = "local[2]"
    session.shared_checkpoints(SimpleNamespace(sparkContext=sc))
