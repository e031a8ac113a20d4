"""Every query against its SQL counterpart in DuckDB."""

import check_queries
import pytest

import __spark_entry__ as entry
from turnstile.plans import oracle
from turnstile.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF)


# Missing times have no plain SQL form here; the rules are checked against loops in test_sequence.py.
WITHOUT_SQL = {"rejected_rows"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(oracle.oracle_sql())


def test_rejected_rows(spark):
    found = {r.reason: r.n for r in QUERIES["rejected_rows"](spark, SF).collect()}
    assert set(found) == {"direction", "time"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query(spark, con, name):
    assert check_queries.compare(spark, con, name, SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["overwritten", "appended", "appended_batches", "months_replaced", "dropped", "month_range_stored", "queried"])
def test_sinks_leave_no_table(spark, name):
    before = {t.name for t in spark.catalog.listTables()}
    rows = QUERIES[name](spark, SF).count()
    assert rows > 0
    assert {t.name for t in spark.catalog.listTables()} == before
