"""Driver contract: entry() smoke, every registered query against its oracle
on the smallest scale factor."""

import os

import pytest

from docsmith.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="test data not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"module_name", "class_name", "section", "method_count"}


def test_every_query_has_an_oracle(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
    assert len(QUERIES) >= 79
    assert set(QUERIES) == set(ORACLE)


def test_all_queries_match_oracle_sf0001(spark):
    from tools.oracle_check import check

    results = check(spark, SF_SMALL, names=list(QUERIES), verbose=False)
    bad = {n: r for n, r in results.items() if r[0] not in ("OK", "rows-only")}
    assert not bad
