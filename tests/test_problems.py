"""Problems 1, 2 and 4 on small cases: nulls, empties, ties, repeats, empty tables, extra columns; and brute force on the given tables."""

import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spotlake.operators.key_profile import heavy_keys, key_profile
from spotlake.operators.packed_lists import automaton_of, best_cover, explode_lists, split_list, unwrap, whole_values
from spotlake.operators.proximity import containing_regions, near_pairs, overlapping_regions, places, region_parts
from spotlake.plans.problems import p2_found, p4_found

KEYED = "fov int, cell_index bigint, barcode_id int, magnitude double, n bigint, item string, field string, total double"


def keyed(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2.0) for r in rows], KEYED)


def test_key_profile_handles_nulls_nan_and_clashing_names(spark):
    df = keyed(spark, [(1, -1, 5, 1.0), (1, -1, 5, float("nan")), (1, None, None, None), (None, 7, 6, 2.5), (2, -1, 6, 0.0)])
    got = {(r.field, r.key_value): (r.n_rows, r.n_values, r.total, r.n_distinct) for r in key_profile(df, ["fov", "cell_index"], "barcode_id", "magnitude").collect()}
    assert got == {
        ("fov", 1): (3, 1, 1.0, 1), ("fov", 2): (1, 1, 0.0, 1), ("fov", None): (1, 1, 2.5, 1),
        ("cell_index", -1): (3, 2, 1.0, 2), ("cell_index", None): (1, 0, None, 0), ("cell_index", 7): (1, 1, 2.5, 1),
    }


def test_key_profile_of_nothing(spark):
    made = key_profile(keyed(spark, []), ["fov"], "barcode_id", "magnitude")
    assert made.collect() == [] and heavy_keys(made, 0.04).collect() == []


def test_heavy_keys_at_the_limit_and_never_null(spark):
    df = keyed(spark, [(1, 0, 1, 1.0)] * 4 + [(None, 0, 1, 1.0)] * 60 + [(i, 0, 1, 1.0) for i in range(100, 136)])
    assert {r.key_value for r in heavy_keys(key_profile(df, ["fov"], "barcode_id", "magnitude"), 0.04).collect()} == {1}


def test_key_profile_shuffles_states_not_rows(spark):
    df = spark.range(200_000).selectExpr("cast(1 as int) fov", "id % 3 barcode_id", "1.0D magnitude")
    rows = key_profile(df, ["fov"], "barcode_id", "magnitude").collect()
    assert [(r.n_rows, r.n_distinct) for r in rows] == [(200_000, 3)]


@pytest.mark.parametrize(
    "text, items",
    [
        (None, []), ("", []), ("   \n", []), ("[]", []), ("[ ]", []), ("array([])", []),
        ("[0 5 10]", [(0, "0"), (1, "5"), (2, "10")]),
        ("array([1,5,9])", [(0, "1"), (1, "5"), (2, "9")]),
        ("np.array([1.\t2.\n 3.])", [(0, "1."), (1, "2."), (2, "3.")]),
        ("[3;8; ;13]", [(0, "3"), (1, "8"), (3, "13")]),
        ("[ ,1,,2,]", [(1, "1"), (3, "2")]),
        ("|4 / 5|", [(1, "4"), (2, "5")]),
        ("[ '0,';'0,5' ]", [(0, "0,"), (1, "0,5")]),
        ('"[""0,5"", ""1,5""]"', [(0, "0,5"), (1, "1,5")]),
        ("'3, 6; 9'", [(0, "3"), (1, "6"), (2, "9")]),
        ('"1";"4"', [(0, "1"), (1, "4")]),
        ("'1' '2'", [(0, "1"), (1, "2")]),
        ("[0 '5 , 6' nan]", [(0, "0"), (1, "5 , 6"), (2, "nan")]),
        ("['', 'a']", [(1, "a")]),
        ("[5' 6]", [(0, "5'"), (1, "6")]),
        ("7", [(0, "7")]),
        ("2 3", [(0, "2"), (1, "3")]),
    ],
)
def test_split_list(text, items):
    assert split_own(text) == items


def split_own(text, *others):
    bodies = [unwrap(t) for t in (text, *others) if t]
    return split_list(bodies[0], automaton_of(whole_values(bodies))) if bodies and text else []


def test_other_lists_do_not_change_clear_ones():
    texts = ["[' ' 'a,b']", "'1' '2'", "[0,5 '0,5']", '["a", "b;c"]']
    for t in texts:
        assert split_own(t, *texts) == split_own(t)


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ("[5' 6 '7,8' 9]", [(0, "5'"), (1, "6"), (2, "7,8"), (3, "9")]),
        ("['a, 'b;c', d]", [(0, "'a"), (1, "b;c"), (2, "d")]),
        ("it's | 'x|y' | don't", [(0, "it's"), (1, "x|y"), (2, "don't")]),
        ("[\"it's, so\" 'q \" r' 5']", [(0, "it's, so"), (1, 'q " r'), (2, "5'")]),
    ],
)
def test_stray_and_nested_quotes_that_pairing_from_the_left_gets_wrong(text, items):
    assert split_own(text) == items


def test_a_value_of_another_list_is_known():
    text = "[3' 'p,q'' 4]"
    assert split_own(text) == [(0, "3'"), (1, "p,q'"), (2, "4")]
    assert ("quoted", "p,q") in best_cover(unwrap("[x'p,q' y' 'z]"), automaton_of(whole_values(["'p,q'"])))
    assert ("quoted", " y") not in best_cover(unwrap("[x'p,q' y' 'z]"), automaton_of(whole_values(["'p,q'"])))


def test_lists_joined_with_the_dictionary_give_the_same(spark):
    texts = ["[5' 6 '7,8' 9]", "'p,q'", "[x'p,q' y' 'z]", "a,b", None, "", "['a, 'b;c', d]", "'b;c'", "a,b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    one, two = (sorted(map(tuple, explode_lists(df, "id", ["t"], most).collect())) for most in (1000, 0))
    assert one == two and (0, "t", 2, "7,8") in one


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab,;| ", min_size=1, max_size=4), min_size=1, max_size=6), st.sampled_from([",", "; ", " | ", "\n"]))
def test_quoted_items_come_back(items, gap):
    body = "[" + gap.join(f"'{i}'" for i in items) + "]"
    assert split_own(body) == list(enumerate(items))


def test_cover_prefers_whole_values():
    body = "'1' '2'"
    assert [t for k, t in best_cover(body, automaton_of(whole_values([body]))) if k == "quoted"] == ["1", "2"]


def test_explode_lists_keeps_repeats_and_ignores_other_columns(spark):
    df = spark.createDataFrame([(1, "[1 2]", None, "z"), (1, "[1 2]", "x", "z")], "id bigint, frame string, zPos string, item string")
    assert explode_lists(df, "id", ["frame", "zPos"]).count() == 5
    assert explode_lists(df.limit(0), "id", ["frame"]).collect() == []


def reference_lists(t):
    """A plain reading of one list, letter by letter."""
    if t is None or not t.strip():
        return []
    b, bracketed = t.strip(), False
    while True:
        was = b
        if m := re.fullmatch(r"[A-Za-z_][\w.]*\s*(\(.*\))", b, re.S):
            b = m[1]
        if len(b) > 1 and b[0] + b[-1] in ("[]", "()", "{}"):
            b, bracketed = b[1:-1].strip(), True
        elif len(b) > 1 and not bracketed and b[0] == b[-1] and b[0] in "'\"" and b[0] not in b[1:-1].replace(b[0] * 2, ""):
            b = b[1:-1].replace(b[0] * 2, b[0]).strip()
        if b == was:
            break
    out, pos, item, i = [], 0, "", 0
    gap = re.compile(r"\s*[,;|/]\s*|\s+")
    while i < len(b):
        end = b.find(b[i], i + 1) if b[i] in "'\"" else -1
        if end > 0:
            item, i = item + b[i + 1 : end], end + 1
        elif m := gap.match(b, i):
            out.append((pos, item))
            pos, item, i = pos + 1, "", m.end()
        else:
            item, i = item + b[i], i + 1
    return [(p, s) for p, s in [*out, (pos, item)] if s]


def test_lists_of_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    t = pd.read_parquet(f"{d}/dataorganization.parquet")
    want = {(r, f, p, s) for f in ("frame", "zPos") for r, x in zip(t.dorg_row, t[f]) for p, s in reference_lists(x)}
    got = p2_found(spark, d).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_near_pairs_are_exact_at_the_radius(spark):
    rows = [(1, 346.218, 0.0), (2, 346.618, 0.0), (3, 346.6181, 0.0), (3, 346.6181, 0.0), (4, None, 0.0), (5, float("nan"), 0.0), (6, -0.2, -5.0), (7, 0.2, -5.0), (8, 1e300, 0.0)]
    pts = places(spark.createDataFrame(rows, "m bigint, x double, y double"), "m", "x", "y")
    assert sorted(map(tuple, near_pairs(pts, 0.4).collect())) == [(1, 2), (2, 3), (6, 7)]
    assert near_pairs(pts.limit(0), 0.4).collect() == []


def test_points_at_one_place(spark):
    pts = places(spark.createDataFrame([(i, 1.0, 1.0) for i in range(20)], "m bigint, x double, y double"), "m", "x", "y")
    assert near_pairs(pts, 0.4).count() == 190


SHAPES = [
    ("square", 0.0, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"),
    ("square", 0.0, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"),
    ("two", 0.0, "SRID=1;multipolygon(((10 10,12 10,12 12,10 12)),((2E1 20,22 20,22 22,20 22,20 20)))"),
    ("empty", 0.0, "POLYGON EMPTY"), ("none", 0.0, None), ("blank", 0.0, "  "), ("bad", 0.0, "POLYGON ((a b, 1 2, 3 4))"), ("line", 0.0, "POLYGON ((0 0, 1 1))"),
    ("slanted", 1.5, "  Polygon ((0 0,0.003 0.001,0 0.002))"),
    ("noplane", None, "POLYGON ((0 0, 4 0, 4 4, 0 4))"),
]


def test_containing_regions(spark):
    regions = region_parts(spark.createDataFrame(SHAPES, "id string, z double, geometry string"), "id", "geometry", "z")
    assert {r.region_id for r in regions.collect()} == {"square", "two", "slanted", "noplane"}
    places_in = {1: (0.5, 0.5, 0.0), 2: (2.0, 2.0, 0.0), 3: (0.0, 2.0, 0.0), 4: (4.0, 4.0, 0.0), 5: (1.0, 2.0, 0.0), 6: (11.0, 11.0, 0.0), 7: (21.0, 21.0, 0.0), 8: (0.5, 0.5, 3.0), 9: (0.0015, 0.0005, 1.5), 10: (0.001, 0.001, 1.5), 11: (0.5, 0.5, None)}
    pts = places(spark.createDataFrame([(i, *p) for i, p in places_in.items()], "m bigint, x double, y double, z double"), "m", "x", "y", "z")
    got = sorted(map(tuple, containing_regions(pts, regions, "z").collect()))
    assert got == [(1, "square"), (6, "two"), (7, "two"), (10, "slanted")]
    area = {r.region_id: r.a for r in regions.groupBy("region_id").agg({"area": "sum"}).withColumnRenamed("sum(area)", "a").collect()}
    assert area["square"] == pytest.approx(12) and area["two"] == pytest.approx(8)


def test_overlapping_regions(spark):
    rows = [("a", 0.0, "POLYGON ((0 0, 4 0, 4 4, 0 4))"), ("b", 0.0, "POLYGON ((-1 1, 5 1, 5 2, -1 2))"), ("c", 0.0, "POLYGON ((1 3, 2 3, 2 3.5, 1 3.5))"), ("d", 0.0, "POLYGON ((4 0, 8 0, 8 4, 4 4))"), ("e", 1.5, "POLYGON ((0 0, 4 0, 4 4, 0 4))")]
    regions = region_parts(spark.createDataFrame(rows, "id string, z double, geometry string"), "id", "geometry", "z")
    assert sorted(map(tuple, overlapping_regions(regions, "z").collect())) == [("a", "b"), ("a", "c"), ("b", "d")]


def ring_side(x, y, ring):
    odd = 0
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return -1
        odd ^= (ay > y) != (by > y) and (by > ay) == (cross > 0)
    return int(odd)


def test_places_of_the_given_tables(spark, sf):
    m = pd.read_parquet(f"{sf}/molecules.parquet")[["molecule_id", "global_x", "global_y", "z"]].dropna().drop_duplicates()
    m["X"], m["Y"] = ((m[c] * 1000).round().astype("int64") for c in ("global_x", "global_y"))
    rows = list(zip(m.molecule_id, m.X, m.Y))
    rows.sort(key=lambda r: r[1])
    near = set()
    for i, (a, x, y) in enumerate(rows):
        for b, u, v in rows[i + 1 :]:
            if u - x > 400:
                break
            if a != b and (u - x) ** 2 + (v - y) ** 2 <= 160_000:
                near.add((min(a, b), str(max(a, b))))
    inside = set()
    for i, z, t in pd.read_parquet(f"{sf}/cells.parquet").dropna(subset=["geometry"])[["id", "z", "geometry"]].itertuples(index=False):
        t = re.sub(r"srid=\d+;", "", t.lower())
        for part in re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", t):
            outer, *holes = [[tuple(round(float(v) * 1000) for v in p.split()) for p in r.split(",")] for r in re.findall(r"\(([^()]*)\)", part)]
            q = m[(m.z == z) & m.X.between(min(p[0] for p in outer), max(p[0] for p in outer))]
            inside |= {(a, i) for a, x, y in zip(q.molecule_id, q.X, q.Y) if ring_side(x, y, outer) == 1 and all(ring_side(x, y, h) == 0 for h in holes)}
    got = p4_found(spark, sf).toPandas()
    pick = lambda r: set(got[got.relation == r][["molecule_id", "other_id"]].itertuples(index=False, name=None))
    assert pick("near") == near and pick("inside") == inside and len(got) == len(near) + len(inside)
