"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
OWN = {**registry.operator_queries.queries(), **registry.stream_queries.queries()}
QUERIES = {name: query for name, query in registry.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in registry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, duck, ORACLES[name]) == ""


def test_entry_gives_the_report(spark):
    from cohortloom.schemas import REPORT_COLUMNS

    df = registry.entry(spark)
    assert df.columns == REPORT_COLUMNS
    assert not df.isEmpty()


def test_ordered_report_is_ordered(spark):
    rows = QUERIES["report_ordered"](spark, SF_DIR).select("person_name", "event_date").collect()
    keys = [(r.person_name, -r.event_date.toordinal()) for r in rows]
    assert keys == sorted(keys)
