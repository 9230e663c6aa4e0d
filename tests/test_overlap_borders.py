"""Cells that share borders or are copies overlap too; cells that only touch don't."""

from spotlake.operators.proximity import overlapping_regions, region_parts


def test_copies_and_common_borders(spark):
    box = lambda x0, y0, x1, y1: f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"
    rows = [
        ("a", box(0, 0, 2, 2)), ("b", box(1, 0, 3, 2)), ("c", box(3, 0, 5, 2)),
        ("k", box(20, 0, 22, 2)), ("l", "POLYGON ((22 2, 22 0, 21 0, 20 0, 20 2, 22 2))"),
        ("p", box(40, 0, 50, 10)), ("q", "POLYGON ((40 3, 50 3, 50 10, 40 10))"), ("r", "POLYGON ((40 0, 50 0, 50 3, 40 3))"),
    ]
    df = spark.createDataFrame([(i, w, 1.0) for i, w in rows], "id string, geometry string, z double")
    got = {tuple(r) for r in overlapping_regions(region_parts(df, "id", "geometry", "z"), "z").collect()}
    assert got == {("a", "b"), ("k", "l"), ("p", "q"), ("p", "r")}
