"""The nearest of all rows, however far."""

from spotlake.operators import spatial


def test_nearest_of_all_finds_every_parity_and_distance(spark):
    rows = [(2, 0, 0), (4, 10, 0), (6, 900_000, 0), (7, 900_000, 5), (9, 90_000_000_000, 0)]
    pts = spark.createDataFrame(rows, "id bigint, px bigint, py bigint")
    got = {r.id: (r.other_id, int(r.d2)) for r in spatial.nearest_of_all(pts, pts, 0.01).collect()}
    far = {i: min(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in rows if j != i) for i, x, y in rows}
    assert got == {i: (j, d2) for i, (d2, j) in far.items()}
    assert spatial.nearest_of_all(pts.filter("id = 2"), pts.filter("id = 2"), 0.01).collect() == []
