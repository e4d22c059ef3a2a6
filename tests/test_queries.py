"""Every registered query of the catalogue engine against its SQL, or for its rows."""

from __future__ import annotations

import pytest
from comparing import difference

from leafmill.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert difference(spark, QUERIES[name], SQL[name], sf) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "species_name" in entry.entry(spark).columns


def test_scans_are_pruned_and_filtered(spark, sf):
    df = QUERIES["q_scan_docs"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "n_chars" not in plan and "PushedFilters: [" in plan and "IsNotNull(text)" in plan
