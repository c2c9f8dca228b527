from __future__ import annotations

import pytest
from oracle import same

from sentrylake import queries as Q
from sentrylake import run_queries  # noqa: F401  registers its queries beside the others


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n in Q.ORACLE_SQL])
def test_query_equals_its_sql(spark, sf_dir, name):
    same(Q.QUERIES[name](spark, sf_dir), Q.ORACLE_SQL[name], sf_dir)


def test_approximate_median_is_near_the_exact_one(spark, sf_dir):
    exact, near = (Q.QUERIES[n](spark, sf_dir).first()[0] for n in ("median_days", "median_days_approx"))
    assert abs(exact - near) <= 2


def test_entry_has_rows(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
