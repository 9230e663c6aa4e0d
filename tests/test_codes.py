"""Every coding gene gets a code."""

import __spark_entry__ as entry
from spotlake.sources.views import codebook


def test_every_gene_gets_a_code(spark, sf):
    genes = {r.id for r in codebook(spark, sf).filter("id != ''").select("id").distinct().collect()}
    assert genes <= {r.gene for r in entry.queries()["codes_assigned_all"](spark, sf).collect()}
