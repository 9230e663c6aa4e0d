"""Whole sequences are packed, not their first letters."""

import __spark_entry__ as entry
from spotlake.sources.views import probes


def test_blocks_give_back_the_whole_sequence(spark, sf):
    made = {}
    for r in sorted(entry.queries()["seq_pack_blocks"](spark, sf).collect(), key=lambda r: r.start):
        made.setdefault(r.probe_id, set()).add((r.start, "".join("ACGT"[r.code >> 2 * i & 3] for i in reversed(range(r.letters)))))
    want = {}
    for r in probes(spark, sf).collect():
        want.setdefault(r.probe_id, set()).update((i, r.seq[i : i + 27]) for i in range(0, len(r.seq), 27))
    assert made == want and any(i > 0 for v in made.values() for i, _ in v)
