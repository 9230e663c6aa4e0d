"""Scales are optimised for as many rounds as the reference's."""

import __spark_entry__ as entry


def test_ten_rounds(spark, sf):
    assert {r["round"] for r in entry.queries()["scale_optimization"](spark, sf).collect()} == set(range(11))
