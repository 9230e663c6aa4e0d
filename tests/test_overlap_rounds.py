"""Crowded places are thinned out, however many nodes meet."""

from itertools import combinations

from spotlake.operators import graphs


def test_large_cliques_end(spark):
    pairs = [*combinations(range(1, 81), 2), *combinations(range(200, 203), 2), (80, 200)]
    dropped = {r.node for r in graphs.drop_most_overlapping(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert all(a in dropped or b in dropped for a, b in pairs)
    assert len({n for p in pairs for n in p} - dropped) == 2
