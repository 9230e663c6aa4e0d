"""Core operators on small hand-made cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spotlake.functions import sequences as sq
from spotlake.operators import decoding as de
from spotlake.operators import graphs, pixels, quality, spatial, stats
from spotlake.operators.folds import keep_in_order, no_overlap, sparse_centers
from spotlake.operators.ranking import row_numbers, running_sums
from spotlake.session import shared_checkpoints
from spotlake.sources import layout, sinks
from spotlake.streaming.molecules import molecule_stream, once_each, window_counts, write_batches


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a bigint, b bigint")


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    got = dict(graphs.components(edges(spark, [*chain, (7, 1), (7, 2), (2, 7), (9, 9), (1, 7)])).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, 2: 1, 7: 1, 9: 9}
    assert graphs.components(edges(spark, [])).collect() == []


def test_drop_most_overlapping_leaves_no_edge(spark):
    pairs = [(1, 2), (1, 3), (1, 4), (4, 5), (6, 7), (8, 8)]
    dropped = {r.node for r in graphs.drop_most_overlapping(edges(spark, pairs)).collect()}
    assert 1 in dropped and all(a == b or a in dropped or b in dropped for a, b in pairs)
    assert graphs.drop_most_overlapping(edges(spark, [])).collect() == []


def test_running_sums_over_parts(spark):
    df = spark.createDataFrame([(k, v, 1 + v % 3) for k in "ab" for v in range(500)], "k string, v int, n bigint")
    got = {(r.k, r.v): r.s for r in running_sums(df, ["k"], ["v"], {"s": F.col("n")}).collect()}
    total = 0
    for v in range(500):
        assert got["a", v] == got["b", v] == total
        total += 1 + v % 3
    assert sorted(r.row for r in row_numbers(df.filter("k = 'a'").select("v"), [], ["v"]).collect()) == list(range(500))


def test_adjust_against_hand_values(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.02), (3, 0.03), (4, 0.5), (5, None)], "i int, p double")
    got = {r.i: r.q for r in stats.adjust(df, [], "p").collect()}
    assert got[5] is None and [round(got[i], 6) for i in (1, 2, 3, 4)] == [0.04, 0.04, 0.04, 0.5]
    by = {r.i: r.q for r in stats.adjust(df, [], "p", "by").collect()}
    assert by[1] == pytest.approx(0.04 * (1 + 1 / 2 + 1 / 3 + 1 / 4))
    with pytest.raises(ValueError):
        stats.adjust(df, [], "p", "holm")


def test_p_value_is_close_to_erfc(spark):
    zs = [0.0, 0.5, 1.0, 1.96, 3.0, 5.0, -2.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", stats.two_sided_p(F.col("z")).alias("p")).collect()
    assert all(abs(r.p - math.erfc(abs(r.z) / math.sqrt(2))) < 2e-7 for r in got)


def test_permutation_keeps_labels(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as label")
    mixed = stats.permuted(df, "id", "label", 3)
    assert sorted(r.label for r in mixed.collect()) == sorted(r.label for r in df.collect())
    assert mixed.join(df.withColumnRenamed("label", "was"), "id").filter("label != was").count() > 500


def test_folds(spark):
    df = spark.createDataFrame([("a", 0, "xxxx"), ("a", 2, "xx"), ("a", 4, "x"), ("a", 4, "xx"), (None, 1, "x"), ("b", 9, "")], "k string, s int, t string")
    kept = keep_in_order(df, ["k"], ["s", "t"], no_overlap("s", lambda r: r["t"].str.len().to_numpy())).collect()
    assert sorted((r.k or "", r.s, r.t) for r in kept) == [("", 1, "x"), ("a", 0, "xxxx"), ("a", 4, "x"), ("b", 9, "")]
    pts = spark.createDataFrame([("a", i, float(i), 0.0) for i in range(10)], "k string, i int, x double, y double")
    far = keep_in_order(pts, ["k"], ["i"], sparse_centers(["x", "y"], 2.0)).collect()
    assert sorted(r.i for r in far) == [0, 3, 6, 9]


def test_sequences(spark):
    df = spark.createDataFrame([("ACGTN",), ("acgu",), ("",), (None,)], "s string")
    got = [r.rc for r in df.select(sq.revcomp(F.col("s")).alias("rc")).collect()]
    assert got == ["NACGT", "ucgt", "", None]
    twice = df.select(sq.revcomp(sq.revcomp(F.col("s"))).alias("t"), "s").collect()
    assert all(r.t == r.s for r in twice)
    one = spark.createDataFrame([("GATTACA",)], "s string").select(sq.pack(F.col("s")).alias("p"), sq.gc_share(F.col("s")).alias("g"), sq.kmers(F.col("s"), 3).alias("k"), sq.kmers(F.col("s"), 9).alias("none"), sq.wrap(F.lit("a" * 161)).alias("w")).first()
    assert one.p == int("2033010", 4) and one.g == pytest.approx(2 / 7) and one.k == ["GAT", "ATT", "TTA", "TAC", "ACA"] and one.none == [] and one.w == "a" * 80 + "\n" + "a" * 80 + "\na"


def test_nearest_code_of_a_codeword_is_itself(spark):
    codes = spark.createDataFrame([(1, [1.0, 0.0, 1.0]), (2, [0.0, 1.0, 1.0])], "code bigint, v array<double>")
    traces = spark.createDataFrame([(1, [2.0, 0.0, 2.0]), (2, [0.0, 5.0, 5.0]), (3, [0.0, 0.0, 0.0]), (4, [1.0, 1.0, 0.0])], "m bigint, t array<double>")
    a = {r.m: (r.code, round(r.dist, 6)) for r in de.nearest_code(traces, "m", "t", codes, "code", "v").collect()}
    b = {r.m: (r.code, round(r.dist, 6)) for r in de.nearest_code_sql(traces, "m", "t", codes, "code", "v").collect()}
    assert a == b and a[1] == (1, 0.0) and a[2] == (2, 0.0) and a[4][0] == 1
    assert {r.code for r in de.nearest_code(traces, "m", "t", codes, "code", "v", 0.1).filter("m > 2").collect()} == {-1}


def test_crop_is_exclusive(spark):
    df = spark.createDataFrame([(10.0, 50.0), (10.1, 50.0), (90.0, 50.0), (None, 50.0)], "x double, y double")
    assert [r.x for r in quality.crop(df, 100, 100, 0.1).collect()] == [10.1]


def test_z_of_plane(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (3.0,), (9.0,)], "p double")
    assert [r.z for r in df.select(spatial.z_of_plane(F.col("p"), [0.0, 1.0, 3.0, 4.0]).alias("z")).collect()] == [0.0, 0.5, 4.0, 4.0]


def plane_of(df, side, value="v"):
    out = np.zeros((side, side))
    for r in df.collect():
        out[r.py, r.px] += r[value]
    return out


def plane_rows(spark, a, k=1):
    return spark.createDataFrame([(k, int(y), int(x), float(a[y, x])) for y, x in zip(*np.nonzero(a))], "k int, py int, px int, v double")


def brute_blur(a, kernel):
    out = np.zeros_like(a)
    for y in range(len(a)):
        for x in range(len(a)):
            for dy, dx, w in kernel:
                if 0 <= y + dy < len(a) and 0 <= x + dx < len(a):
                    out[y + dy, x + dx] += a[y, x] * w
    return out


def test_filters_of_pixel_rows(spark):
    rng = np.random.default_rng(0)
    a = np.where(rng.random((16, 16)) < 0.3, rng.integers(1, 9, (16, 16)), 0).astype(float)
    rows, kernel = plane_rows(spark, a), pixels.gaussian(1.0, 2)
    assert sum(w for _, _, w in kernel) == pytest.approx(1, abs=1e-6)
    soft = brute_blur(a, kernel)
    assert plane_of(pixels.convolve(rows, ["k"], kernel, 16), 16) == pytest.approx(soft, abs=1e-8)
    assert plane_of(pixels.high_pass(rows, ["k"], kernel, 16), 16) == pytest.approx(np.maximum(a - soft, 0), abs=1e-8)
    ratio = np.divide(a, soft, out=np.zeros_like(a), where=a > 0)
    assert plane_of(pixels.deconvolve(rows, ["k"], kernel, 16, 1), 16) == pytest.approx(a * brute_blur(ratio, kernel), abs=1e-6)
    assert plane_of(pixels.oriented(rows, ["k"], 16, True, False, True), 16) == pytest.approx(np.flipud(a).T)
    assert plane_of(pixels.clip_high(rows, ["k"], 0.5), 16) == pytest.approx(np.minimum(a, np.quantile(a[a > 0], 0.5)))
    one = pixels.equalize(rows, ["k"], 16).filter("py >= 0")
    assert {(r.py, r.px): round(r.v, 9) for r in one.collect()} == {(y, x): round((a <= a[y, x]).mean(), 9) for y, x in zip(*np.nonzero(a))}
    for f in (pixels.convolve, pixels.high_pass):
        assert f(rows.limit(0), ["k"], kernel, 16).collect() == []


def test_maxima_regions_and_suppression(spark):
    rng = np.random.default_rng(1)
    a = np.where(rng.random((20, 20)) < 0.4, rng.integers(1, 5, (20, 20)), 0).astype(float)
    rows = plane_rows(spark, a)
    want = set()
    for y, x in zip(*np.nonzero(a)):
        window = [(a[i, j], -i, -j) for i in range(max(0, y - 1), min(20, y + 2)) for j in range(max(0, x - 1), min(20, x + 2))]
        if max(window) == (a[y, x], -y, -x) and a[y, x] >= 2 and 1 <= min(y, x) and max(y, x) < 19:
            want.add((int(y), int(x), a[y, x]))
    peaks = pixels.maxima(rows, ["k"], 1, 2.0, 20, 1)
    assert {(r.py, r.px, r.h) for r in peaks.collect()} == want
    left, kept = sorted(want, key=lambda t: (-t[2], t[0], t[1])), []
    for y, x, h in left:
        if all(max(abs(y - i), abs(x - j)) > 3 for i, j, _ in kept):
            kept.append((y, x, h))
    got = pixels.suppress(peaks.withColumn("z", F.lit(0.0)), ["k"], 3).collect()
    assert {(r.py, r.px, r.h) for r in got} == set(kept) and 1 < len(kept) < len(want)

    seen, sizes = set(), []
    for start in zip(*np.nonzero(a >= 2)):
        todo, n = [start], 0
        while todo:
            y, x = todo.pop()
            if (y, x) in seen or not (0 <= y < 20 and 0 <= x < 20) or a[y, x] < 2:
                continue
            seen.add((y, x))
            n += 1
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        sizes += [n] if n else []
    assert sorted(r.area for r in pixels.regions(rows, ["k"], 2.0).collect()) == sorted(sizes)


def test_planes_are_registered_to_the_lowest(spark):
    a = np.zeros((16, 16))
    a[[3, 8, 9], [4, 10, 2]] = [2, 3, 5]
    low, high = plane_rows(spark, a).withColumn("z", F.lit(0.0)), plane_rows(spark, np.roll(a, (2, -1), (0, 1))).withColumn("z", F.lit(1.0))
    planes = low.unionByName(high).select("k", "z", "py", "px", "v")
    found = pixels.shifts(planes, ["k"], "z", 3, 16)
    assert {(r.z, r.dy, r.dx) for r in found.collect()} == {(0.0, 0, 0), (1.0, -2, 1)}
    at = pixels.moved(planes, found, ["k", "z"], 16).cache()
    assert plane_of(at.filter("z = 1"), 16) == pytest.approx(a) and plane_of(at.filter("z = 0"), 16) == pytest.approx(a)
    spots = spark.createDataFrame([(1, 8, 10)], "k int, py int, px int")
    assert {(r.z, r["mean"]) for r in pixels.traces(spots, at, ["k"], "z", pixels.square(0)).collect()} == {(0.0, 3.0), (1.0, 3.0)}
    assert plane_of(pixels.frame_means(at, ["k"], "z"), 16) == pytest.approx(a)


def test_planes_hold_all_points(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.5, 0.0), (1, 9.9, 9.9), (1, 10.0, 0.0), (2, -1.0, 0.0), (None, 1.0, 1.0), (1, None, 1.0)], "k int, x double, y double")
    a = plane_of(pixels.rasterize(pts, ["k"], "x", "y", 2.5, 4), 4)
    assert a[0, 0] == 2 and a[3, 3] == 1 and a.sum() == 3


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t1 cdna x gene:G1 gene_biotype:protein_coding", "ACGT" * 50), ("t2", "A")], "h string, s string")
    sinks.write_fasta(df, "h", "s", str(tmp_path / "f"))
    back = layout.read_fasta(spark, str(tmp_path / "f"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    parsed = {r.id: r.fields for r in layout.parse_cdna_header(back).collect()}
    assert parsed == {"t1": {"gene": "G1", "gene_biotype": "protein_coding"}, "t2": {}}


def test_codebook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, "a", "G1", [0, 1]), (1, "Blank-1", "", [1, 1])], "barcode_id int, name string, id string, bits array<int>")
    sinks.write_codebook(df, ["bit1", "bit2"], str(tmp_path / "c"))
    back = layout.read_codebook(spark, str(tmp_path / "c" / "*.csv")).collect()
    assert sorted((r.barcode_id, r.name, r.bits) for r in back) == [(0, "a", [0, 1]), (1, "Blank-1", [1, 1])]


def test_tiles_are_replaced_alone(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.write_tiles(spark.createDataFrame([(1, 5, 1), (2, 5, 2), (2, 65535, 3)], "fov int, barcode_id int, m int"), p)
    sinks.write_tiles(spark.createDataFrame([(2, 6, 9)], "fov int, barcode_id int, m int"), p)
    done = spark.read.parquet(p)
    assert sorted((r.fov, r.m) for r in done.collect()) == [(1, 1), (2, 9)]
    tiles = spark.createDataFrame([(1,), (2,), (3,)], "fov int")
    assert [r.fov for r in sinks.not_done(tiles, done, ["fov"]).collect()] == [3] and sinks.not_done(tiles, done, ["fov"], True).count() == 3


def test_layout_texts(spark, tmp_path):
    names = spark.createDataFrame([("/x/a_b_3_10.tif",), ("c_1_2.ome.tif",), ("notes.txt",)], "p string")
    assert sorted((r.prefix, r.fov, r.round) for r in layout.parse_image_names(names, "p").collect()) == [("a_b", 3, 10), ("c", 1, 2)]
    (tmp_path / "m.json").write_text('{"na": 1.2}')
    m = layout.read_microscope(spark, str(tmp_path / "m.json")).first()
    assert m.na == 1.2 and m.mag == layout.MICROSCOPE["mag"]
    rows = spark.createDataFrame([("1 3",), ("<pre>",), ("",)], "t string")
    assert [r.bits for r in layout.covering_codes(rows, "t", 4).collect()] == [[1, 0, 1, 0]]
    assert spark.range(1).select(layout.bits_of_text(F.lit("0110")).alias("b")).first().b == [0, 1, 1, 0]


def test_stream_counts_each_molecule_once(spark, sf, tmp_path):
    shared_checkpoints(spark)
    rows = spark.read.parquet(f"{sf}/molecules.parquet").filter("fov IS NOT NULL AND barcode_id IS NOT NULL")
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = once_each(molecule_stream(spark, str(tmp_path / "in"), rows.schema, 2), "molecule_id", "decoded_at", "30 days")
    q = write_batches(stream, str(tmp_path / "out"), str(tmp_path / "check"), lambda df: df.select("molecule_id", "fov", "decoded_at", "magnitude"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == rows.select("molecule_id").distinct().count() and got.select("batch").distinct().count() >= 3
    counted = window_counts(got, "decoded_at", "fov", "1 hour", "30 minutes")
    assert counted.agg(F.sum("n")).first()[0] == 2 * got.count()


def test_single_linkage_and_labels(spark):
    from spotlake.operators import models as mo

    items = spark.createDataFrame([(i,) for i in range(1, 8)], "item bigint")
    pairs = spark.createDataFrame([(1, 2, 1), (2, 3, 2), (3, 4, 5), (5, 6, 1)], "a bigint, b bigint, distance int")
    assert dict(mo.single_linkage(pairs, items, "distance", 2).collect()) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}
    two = spark.createDataFrame([(a, b) for g in (range(1, 6), range(11, 16)) for a in g for b in g if a < b] + [(5, 11)], "a bigint, b bigint")
    labels = dict(mo.propagate_labels(two, 5).collect())
    assert len(set(labels.values())) <= 2 and len({labels[i] for i in range(1, 5)}) == 1


def test_codes_keep_their_distance(spark):
    from spotlake.operators import models as mo

    codes = spark.createDataFrame([(0, "a", 0b0000), (1, "b", 0b0001), (2, "c", 0b0011), (3, "d", 0b1111)], "barcode_id int, name string, code bigint")
    assert sorted(r.barcode_id for r in mo.choose_codes(codes, 2).collect()) == [0, 2, 3]
    assert mo.single_bit_errors(codes, 4).count() == 20
    named = mo.assign_codes(spark.createDataFrame([("g1",), ("g2",)], "g string"), "g", codes, 1).collect()
    assert sorted(r.gene for r in named) == ["Blank-1", "Blank-2", "g1", "g2"]


def test_rotation_is_found(spark):
    from spotlake.operators import models as mo

    a = math.radians(30)
    rows = [(1, float(x), float(y), math.cos(a) * x - math.sin(a) * y + 5, math.sin(a) * x + math.cos(a) * y - 2) for x in range(5) for y in range(4)] + [(1, None, 1.0, 1.0, 1.0)]
    r = mo.fit_rotation(spark.createDataFrame(rows, "k int, x double, y double, u double, v double"), "k", "x", "y", "u", "v").first()
    assert r.n == 20 and r.angle == pytest.approx(a) and (r.tx, r.ty) == (pytest.approx(5), pytest.approx(-2))


def test_quality_separates_blanks(spark):
    from spotlake.operators import models as mo

    rows = [(i, i % 10 == 0, 1.0 + (i % 10 == 0) * 5 + (i % 7) * 0.1, None if i == 3 else 1.0) for i in range(2000)]
    rated = mo.predict_quality(spark.createDataFrame(rows, "id bigint, blank boolean, f double, g double"), "id", "blank", ["f", "g"])
    means = {r.blank: r.q for r in rated.join(spark.createDataFrame(rows, "id bigint, blank boolean, f double, g double"), "id").groupBy("blank").agg(F.avg("quality").alias("q")).collect()}
    assert rated.count() == 2000 and means[True] > 0.8 and means[False] < 0.2


def test_windows_spread_or_not(spark):
    from spotlake.operators import probes as pb

    text = "".join("ACGT"[(i * 7 + i // 5) % 4] for i in range(1000))
    df = spark.createDataFrame([("a", text), ("short", "AC"), ("none", None)], "t string, s string")
    for step in (1, 3, 300):
        for spread in (False, True):
            got = sorted((r.shift, r.target) for r in pb.windows(df, "s", 17, step, "t", spread=spread).collect())
            assert got == [(i, text[i : i + 17]) for i in range(0, 1000 - 16, step)]


def test_knn_whatever_the_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(0, 4, 3)]) for i in range(300)] + [(900, None), (None, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    x = {i: np.array(v) for i, v in rows if i is not None and v is not None}
    want = {(q, i, p) for q in x if q % 20 == 0 for p, (_, i) in enumerate(sorted((round(float(np.linalg.norm(x[q] - x[i])), 9), i) for i in x if i != q)[:5], 1)}
    for block in (40, 4096):
        got = {(r.query, r.id, r.place) for r in de.knn(df, "id", "v", df.filter("id % 20 = 0"), 5, block).collect()}
        assert got == want
    assert de.knn(df, "id", "v", df.limit(0), 5).collect() == []


def test_positions_and_overlaps_stay_within_their_run(spark):
    pos = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 9.0, 0.0), ("b", 1, 5000.0, 0.0), ("b", 2, 5009.0, 0.0), ("c", 1, 5001.0, 0.0)], "run_id string, fov int, fx double, fy double")
    rows = spark.createDataFrame([("a", 1, 2.0, 0.0), ("b", 1, 2.0, 0.0)], "run_id string, fov int, x double, y double")
    keys = ["run_id", "fov"]
    assert {r.run_id: r.gx for r in spatial.to_global(rows, pos, 0.5, keys).collect()} == {"a": 1.0, "b": 5001.0}
    met = spatial.overlapping_boxes(spatial.boxes(pos, 10.0, 10.0, ["run_id"]), "fov", 50.0, ["run_id"])
    assert sorted(map(tuple, met.collect())) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 2), ("b", 2, 1)]


def test_every_run_has_positions_extents_and_fits(spark, sf):
    q = entry.queries()
    runs = {r.run_id for r in spark.read.parquet(f"{sf}/molecules.parquet").select("run_id").distinct().collect()}
    for name in ("run_fov_positions", "run_global_extent", "run_tile_rotation", "run_tile_scale_fit"):
        assert {r.run_id for r in q[name](spark, sf).select("run_id").distinct().collect()} == runs


def test_image_queries_keep_the_run(spark, sf):
    names = [n for n in entry.queries() if n.startswith("image_")]
    assert len(names) > 15 and all("run_id" in entry.queries()[n](spark, sf).columns for n in names)
