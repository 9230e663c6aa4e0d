"""Shuffles of labels: ids of any length and type, rows without id, unit or label, and buckets and passes that don't change the result."""

import hashlib
import random
from collections import Counter

import pytest

from spotlake.operators import stats as st


@pytest.mark.parametrize("at_once, bucket", [(3, 40), (10, 1 << 17)])
def test_permutation_p_is_that_of_the_md5_order(spark, monkeypatch, at_once, bucket):
    monkeypatch.setattr(st, "SHUFFLES_AT_ONCE", at_once)
    monkeypatch.setattr(st, "BUCKET", bucket)
    rng = random.Random(3)
    rows = [(f"{i:04d}" + "x" * (80 if i % 50 == 0 else i % 9), f"u{rng.randint(0, 20) if i % 3 else 0}", None if i % 40 == 7 else rng.choice("abc")) for i in range(900)]
    seeds = 7
    seen, beaten = Counter((u, lab) for _, u, lab in rows), Counter()
    for s in range(seeds):
        mixed = sorted(rows, key=lambda r: hashlib.md5(f"{s}-{r[0]}".encode()).hexdigest())
        times = Counter((a[1], b[2]) for a, b in zip(sorted(rows), mixed) if b[2] is not None)
        beaten.update(k for k, m in times.items() if k in seen and m > seen[k])
    made = st.permutation_p(spark.createDataFrame(rows, "id string, u string, lab string"), "id", "u", "lab", seeds)
    got = {(r.u, r.lab): (r.n, round(r.p, 9)) for r in made.collect()}
    assert got == {k: (n, round(beaten[k] / seeds, 9)) for k, n in seen.items()}


def test_a_pass_drops_its_files(spark, sf, monkeypatch):
    """Every pass but the first begins after the files of the one before were given up."""
    from spotlake.plans.stats import permutation_pvalues

    calls = []
    monkeypatch.setattr(st, "freed", lambda s: calls.append(s))
    assert permutation_pvalues(spark, sf).count() > 0
    assert len(calls) == 100 // st.SHUFFLES_AT_ONCE
