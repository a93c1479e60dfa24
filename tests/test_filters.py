"""Filters of many keys, and what the driver holds of a query: nothing that grows with its tables."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import filters, sizing
from cohortloom.plans import report as plan
from cohortloom.plans import sections, streams
from cohortloom.testbed import stream_queries
from tests.clinic import Clinic

SF_DIR = "/root/testdata/sf0.001"


def plans(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def kept_settings(spark):
    names = [*sizing.filter_settings(1, 1), "spark.sql.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k) for k in names}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("bits", [filters.MAX_BITS, 20_000])
def test_a_filter_loses_no_key_and_drops_most_others(spark, bits):
    side = spark.range(5000).selectExpr("id * 7 AS a", "CAST(id % 3 AS INT) AS b")
    side = side.unionByName(side.limit(10)).unionByName(spark.sql("SELECT NULL AS a, 1 AS b"))
    found = filters.filter_of(side, ["a", "b"], 5011, "some-keys", bits)
    many = spark.range(35_000).selectExpr("CAST(id AS INT) AS a", "CAST((id DIV 7) % 3 AS BIGINT) AS b", "id AS more")
    passed = found.passing(many)
    assert passed.columns == many.columns
    kept = {r.a for r in passed.collect()}
    wrong = len(kept - set(range(0, 35_000, 7))) / 30_000
    assert set(range(0, 35_000, 7)) <= kept and wrong < (0.02 if bits > 20_000 else 0.3)
    assert passed.count() == len(kept)  # no row twice


def test_a_filter_of_too_many_keys_is_left_out(spark):
    assert filters.filter_of(spark.range(9).withColumnRenamed("id", "a"), ["a"], 10**9, "too-many") is None


def test_a_filter_of_no_keys_passes_nothing(spark):
    found = filters.filter_of(spark.range(0), ["id"], 0, "no-keys")
    assert found.passing(spark.range(100)).count() == 0


def test_many_keys_are_no_values_of_the_plan(spark, monkeypatch, kept_settings):
    """Catalyst's filters are for few keys; of many the driver would hold each filter several times a stage."""
    given = stream_queries.inputs(spark, SF_DIR)
    expected = sorted(map(str, plan.report(given).collect()))
    ranked = sorted(map(str, sections.all_events(given).collect()))
    measured = sizing.measured
    # Each key counted as many, so that filters have the bits of 40 real keys each.
    monkeypatch.setattr(sizing, "measured", lambda frames: {n: (r + 2_000_000, b + (1 << 30)) for n, (r, b) in measured(frames).items()})
    monkeypatch.setattr(streams, "filter_of", lambda side, keys, rows, name: filters.filter_of(side, keys, rows - 2_000_000, name))
    for key in ("autoBroadcastJoinThreshold", "optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"):
        spark.conf.set(f"spark.sql.{key}", "0")
    for make in (plan.limited, lambda i: plan.sized(i, of_persons=True)):
        inputs = make(given)
        assert {"eligible", "cytology_keys", "surgical_of_persons", "cpt"} <= inputs.filters.keys()
        rows = plan.report(inputs)
        text = plans(rows)
        assert "bloom_filter_agg" not in text and "might_contain" not in text
        assert text.count("getbit") >= 8
        assert sorted(map(str, rows.collect())) == expected
    rows = sections.all_events(plan.selected(given))
    assert "bloom_filter_agg" not in plans(rows)
    assert sorted(map(str, rows.collect())) == ranked


def test_a_filter_is_below_the_first_exchange(spark, monkeypatch, kept_settings):
    given = stream_queries.inputs(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    many = plan.selected(given)
    side = streams.with_filters(many, {"procedures_keys": many.keys["procedures"]}, {"procedures_keys": 1000})
    side = replace(side, run=replace(side.run, broadcast=frozenset()), large=frozenset({"procedures_keys"}))
    text = streams.diagnoses(side)._jdf.queryExecution().executedPlan().toString()
    assert "getbit" in text
    exact = text.index("SortMergeJoin")
    assert text.index("getbit") > exact + text[exact:].index("Exchange")


def test_persons_too_many_to_broadcast_are_sorted(spark, monkeypatch):
    """A small file may hold many persons, and their join repeats each per salt."""
    clinic = Clinic().person().code(7, "OBSTETRIC", "VISIT").procedure(7).diagnosis(1)
    few = plan.limited(clinic.inputs(spark))
    assert "eligible" not in few.large
    monkeypatch.setattr(sizing.broadcastable, "__defaults__", (3, sizing.MAX_BYTES, sizing.MAX_TOTAL_BYTES))
    many = plan.limited(clinic.inputs(spark))  # one person, four salts
    assert "eligible" in many.large and "eligible" in many.filters
    for inputs, broadcast in ((few, True), (many, False)):
        day = replace(inputs, grain=streams.REPORT, persons=inputs.eligible)
        rows = inputs.tables["lab_chem"].select("Sta3n", "PatientSID", F.lit(1).alias("n"))
        text = day.of_persons(rows, "labs", "n")._jdf.queryExecution().executedPlan().toString()
        exact = text.replace("LeftSemi", "")
        assert ("SortMergeJoin" not in exact) == broadcast
    assert sorted(map(str, plan.report(few).collect())) == sorted(map(str, plan.report(many).collect()))


def test_broadcasts_fit_a_small_driver():
    """A driver of 750 MB holds three times the sides of a query, and the filters of three streams."""
    assert 2 * 3 * sizing.MAX_TOTAL_BYTES + 3 * 5 * filters.MAX_BITS // 8 < 600 << 20
    assert sizing.filter_settings(10**7, 10**8)[f"{sizing._FILTER}.enabled"] == "false"
    assert sizing.filter_settings(10**5, 10**6)[f"{sizing._FILTER}.enabled"] == "true"
