"""Input building: facts of the analogue get their site once per query, without changed rows."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from cohortloom.plans import report as plan
from cohortloom.plans import streams
from cohortloom.testbed import analogue, stream_queries

AT = dt.datetime(2000, 5, 5, 8)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with a line without order, an order without customer, and rows that come twice."""
    place = str(tmp_path_factory.mktemp("tables"))
    tables = {
        "region": ([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(c, f"C{c}", c % 2, 100.0 * c, "BUILDING") for c in [*range(8), 3]],
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "supplier": ([(s, f"S{s}", s % 2) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": (
            [(k, "blue ring widget", "B", "LARGE PROMO") for k in range(4)],
            "p_partkey long, p_name string, p_brand string, p_type string",
        ),
        "orders": (
            [(o, o % 10 if o else None, "FOP"[o % 3], 1.0, AT, "1-URGENT") for o in [*range(30), 4, 5]],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
            "o_orderpriority string",
        ),
        "lineitem": (
            [(i % 33, i % 4, i % 4, 1 + i % 7, "ANR"[i % 3], "OF"[i % 2]) for i in [*range(99), 7, 7]],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string",
        ),
        "events": (
            [(e, AT, e % 9, "click", 50.0, "{}") for e in range(20)],
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{place}/{name}.parquet")
    return place


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stored_lines_and_orders_are_those_of_the_joins(spark, folder):
    plain, stored = analogue.Analogue(spark, folder), analogue.Analogue(spark, folder, stored=True)
    assert plain.lines().count() > 80
    spark.sql(f"SELECT * FROM parquet.`{folder}/lineitem.parquet`").createOrReplaceTempView("l")
    spark.sql(f"SELECT * FROM parquet.`{folder}/orders.parquet`").createOrReplaceTempView("o")
    spark.sql(f"SELECT * FROM parquet.`{folder}/customer.parquet`").createOrReplaceTempView("c")
    spark.sql(f"SELECT * FROM parquet.`{folder}/nation.parquet`").createOrReplaceTempView("n")
    joined = spark.sql(
        """SELECT l.*, o_orderkey, o_custkey, o_orderdate, c_custkey AS PatientSID, n_regionkey AS Sta3n
           FROM l JOIN o ON l_orderkey = o_orderkey JOIN c ON o_custkey = c_custkey JOIN n ON c_nationkey = n_nationkey"""
    )
    for found in (plain.lines(), stored.lines()):
        assert same_rows(found.select(joined.columns), joined)
    assert same_rows(plain.orders(), stored.orders())


def test_report_joins_orders_and_lines_to_their_site_once(spark, folder):
    text = physical(stream_queries.report(spark, folder))
    assert "lineitem.parquet" not in text and "orders.parquet" not in text
    given = stream_queries.inputs(spark, folder)
    assert same_rows(stream_queries.report(spark, folder), plan.report(given))


def test_sources_that_are_not_read_are_not_stored(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    richer = stream_queries.corrected(spark, folder, ("health_factor", "health_factor_history"), states=("MASTECTOMY",))
    streams.states(richer).collect()
    assert set(os.listdir(shared)) == before


def test_codes_of_all_sites_are_not_held_by_each_task(spark, folder):
    t = stream_queries.inputs(spark, folder).tables
    joined = t["v_procedure"].join(t["cpt"], ["CPTSID", "Sta3n"])
    assert "SortMergeJoin [CPTSID" in physical(joined)


def test_site_replacement_builds_its_report_once(spark, folder, monkeypatch):
    built = []
    report = plan.report
    monkeypatch.setattr(plan, "report", lambda *a, **k: built.append(1) or report(*a, **k))
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    rows = stream_queries.replace_site_and_read(spark, folder)
    names = set(os.listdir(shared)) - before
    assert len(built) == 1 and any(n.startswith("report-rows") for n in names)
    assert rows.count() == rows.distinct().count() == stream_queries.report(spark, folder).count()
