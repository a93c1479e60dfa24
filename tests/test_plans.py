"""What the optimised plans look like, and that shortcuts change no result."""

from __future__ import annotations

from dataclasses import replace

import pytest
from clinic import Clinic
from pyspark.sql import functions as F

from cohortloom.operators import sizing
from cohortloom.operators.unions import united
from cohortloom.plans import report as plan
from cohortloom.plans import sections, streams
from cohortloom.testbed import stream_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return stream_queries.inputs(spark, SF_DIR)


def optimised(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_report_has_no_window_and_no_cross_join(inputs):
    report = plan.report(inputs)
    assert "Window" not in optimised(report)
    assert "Cartesian" not in physical(report)
    assert "NestedLoop" not in physical(report)


def test_report_equals_the_ranked_union_form(inputs):
    ranked = plan.report(inputs, show_rank=True).drop("recency").distinct()
    assert same_rows(plan.report(inputs), ranked)


def test_report_with_measured_sides_is_the_same(inputs):
    sized = plan.sized(inputs)
    assert {"eligible", *(f"{s}_keys" for s in streams.SELECTIONS)} <= sized.run.broadcast
    assert set(sized.selected) == set(streams.SELECTIONS)
    assert same_rows(plan.report(inputs), plan.report(sized))
    assert same_rows(plan.report(inputs, latest_only=True), plan.report(sized, latest_only=True))


@pytest.mark.parametrize("salts", [1, 16])
def test_report_is_the_same_for_any_salt(inputs, salts):
    other = replace(inputs, run=replace(inputs.run, person_salts=salts))
    assert same_rows(plan.report(inputs), plan.report(other))


def test_hot_ranks_are_the_same(inputs):
    hot = replace(inputs, run=replace(inputs.run, hot_rows=5))
    for stream in ("labs", "surgical"):
        assert same_rows(streams.ranked(inputs, stream), streams.ranked(hot, stream))


def test_sections_alone_equal_the_sections_together(inputs):
    apart = united([sections.section_table(inputs, n) for n in ("breast", "cervical")])
    assert same_rows(sections.all_events(inputs), apart)


def test_a_section_reads_only_its_own_sources(inputs):
    only = replace(inputs, spec=inputs.spec.only("breast"))
    assert "labs" not in streams.present(only.spec)
    text = optimised(streams.procedures(only))
    assert "LeftOuter" in text  # diagnoses and their descriptions
    assert "examined" not in text  # every row needs an exam: plain inner join


def test_type_lookup_is_an_inner_join(inputs):
    text = optimised(streams.observations(inputs))
    assert "Join Inner" in text
    assert "LeftOuter" not in text


def test_facts_are_read_once_for_both_sections(inputs):
    text = physical(streams.surgical(inputs))
    assert text.count("l_returnflag") > 0
    one = physical(streams.surgical(replace(inputs, spec=inputs.spec.only("breast"))))
    assert text.count("FileScan") == one.count("FileScan")


@pytest.mark.parametrize("sites", [None, (2,)])
def test_facts_are_reduced_before_they_are_shuffled(spark, sites):
    """Diagnoses, exams and morphologies: semi-join below the first exchange, by broadcast
    where the keys are few. Where they are many, the rows are the same."""
    given = stream_queries.inputs(spark, SF_DIR, sites=sites)
    sized = plan.sized(given)
    for rows in (streams.diagnoses(sized), streams.exam_results(sized)):
        assert "LeftSemi, BuildRight" in physical(rows)
    whole = physical(plan.report(sized))
    assert whole.count("LeftSemi, BuildRight") >= 4
    many = replace(sized, run=replace(sized.run, broadcast=frozenset()))
    assert same_rows(plan.report(given), plan.report(many))


def test_facts_met_by_many_keys_are_filtered_before_the_shuffle(spark, monkeypatch):
    """Where the keys of visits and cases are too many to broadcast, a Bloom filter of them is below the
    first exchange of diagnoses, exams and morphologies. Sizing fits the session's filters to the keys."""
    given = stream_queries.inputs(spark, SF_DIR)
    monkeypatch.setattr(sizing, "within", lambda *sizes: frozenset())
    names = [f"{sizing._FILTER}.{n}" for n in ("numBits", "applicationSideScanSizeThreshold")]
    settings = sizing.filter_settings(1, 1)
    before = {k: spark.conf.get(k) for k in [*settings, "spark.sql.autoBroadcastJoinThreshold"]}
    monkeypatch.setattr(sizing, "measured", lambda frames: {n: (200_000, 4_000_000) for n in frames})
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = plan.sized(given)
        assert spark.conf.get(names[0]) == "2000000"
        spark.conf.set(names[1], "0")  # these facts are tiny
        for rows in (streams.diagnoses(large), streams.exam_results(large)):
            text = physical(rows)
            assert "might_contain" in text and "BroadcastHashJoin" not in text
        whole = optimised(plan.report(large))
        assert whole.count("bloom_filter_agg") >= 4
        filtered = plan.report(large).collect()
        spark.conf.set(f"{sizing._FILTER}.enabled", "false")
        assert "might_contain" not in physical(streams.diagnoses(large))
        assert sorted(map(str, filtered)) == sorted(map(str, plan.report(given).collect()))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("few", [True, False])
def test_a_report_stages_only_what_its_persons_can_meet(spark, monkeypatch, few):
    clinic = Clinic().person().person(2, Gender="M").code(7, "OBSTETRIC", "VISIT")
    for sid in (1, 2):
        clinic.procedure(7, visit=sid, sid=sid).diagnosis(sid, visit=sid, sid=sid)
        clinic.cyto("CERVIX", sid=sid, findings=("DYSPLASIA",))
    given = clinic.inputs(spark)
    if not few:
        monkeypatch.setattr(sizing, "within", lambda *sizes: frozenset())
    whole, limited = plan.sized(given), [plan.limited(given), plan.sized(given, of_persons=True)]
    for stream in ("procedures", "cytology"):
        found = whole.selected[stream].count()
        assert found and found == 2 * limited[0].selected[stream].count() == 2 * limited[1].selected[stream].count()
    for one in limited:
        assert one.persons is None and ("eligible" in one.run.broadcast) == (few and one is limited[1])
        rows = sorted(map(str, plan.report(one).collect()))
        assert rows and rows == sorted(map(str, plan.report(given).collect()))


def test_sections_of_staged_rows_are_the_same(inputs):
    assert same_rows(sections.all_events(inputs), sections.all_events(plan.selected(inputs)))


def test_facts_are_filtered_by_large_code_dimensions(spark, inputs, monkeypatch):
    """The staged codes are sorted where they are not broadcast, and filter procedures and specimens below
    the first exchange."""
    names = [*sizing.filter_settings(1, 1), "spark.sql.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k) for k in names}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        monkeypatch.setattr(sizing, "within", lambda *sizes: frozenset())
        large = plan._fitted(streams.with_codes(inputs), {})
        for key, value in sizing.filter_settings(100_000, 1 << 20).items():
            spark.conf.set(key, "0" if key.endswith("ScanSizeThreshold") else value)
        for rows in (streams.coded_procedures, streams.cytology_specimens):
            text = physical(rows(large, [s for s in inputs.spec.sections]))
            assert "might_contain" in text
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_filters_have_a_bound():
    settings = sizing.filter_settings(10**12, 10**13)
    bits = {v for k, v in settings.items() if k.endswith("Bits")}
    assert bits == {str(sizing.MAX_FILTER_BITS)}


def test_ranks_need_two_jobs_a_stream(spark, inputs, monkeypatch):
    """Building a ranked stream writes it once and looks at its groups once."""
    calls = []
    from cohortloom.operators import ranking

    monkeypatch.setattr(streams, "staged", lambda df, name: calls.append(name) or df)
    monkeypatch.setattr(ranking, "staged", lambda df, name: calls.append(name) or df)
    for name in streams.BUILDERS:
        streams.ranked(inputs, name)
    assert calls == list(streams.BUILDERS)


def test_filters_and_columns_reach_the_scan(spark, inputs):
    scan = [
        line
        for line in physical(streams.exam_results(inputs)).splitlines()
        if "FileScan" in line and "o_orderdate" in line
    ]
    assert any("GreaterThan(o_orderdate,1998-08-01T10:00)" in line for line in scan)
    assert all("o_totalprice" not in line for line in scan)


def test_no_broadcast_hint_without_a_measure(inputs):
    spark = inputs.tables["cpt"].sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in physical(plan.report(inputs))
        marked = replace(inputs, run=replace(inputs.run, broadcast=frozenset({"cpt"})))
        assert "BroadcastExchange" in physical(
            streams.selected_procedures(marked, marked.spec.sections)
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_eligible_persons_equal_the_literal_joins(inputs):
    t = inputs.tables
    keys = ["Sta3n", "PatientSID"]
    literal = (
        t["patient"]
        .join(t["enrollment"], keys)
        .join(t["enrollment_status"], ["EnrollmentStatusSID", "Sta3n"])
        .where("PatientName NOT LIKE 'ZZ%' AND Gender = 'F' AND DeceasedFlag != 'Y'")
        .where("EnrollmentCategory = 'ENROLLED'")
        .select(*keys)
    )
    ours = plan.eligible_persons(inputs).select(*keys)
    assert same_rows(ours, literal.distinct())
    assert same_rows(plan.eligible_persons(inputs, repeats=True).select(*keys), literal)


def test_skewed_person_key(spark, inputs):
    """One person with most events: salted and unsalted joins agree, and the
    person's rows are spread over several tasks."""
    from cohortloom.operators.joins import salted_join

    many = spark.range(9000).select(
        F.when(F.col("id") < 6000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    one = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = salted_join(many, one, ["k"], 8, ["v"])
        assert same_rows(salted, many.join(one, "k"))
        tasks = salted.where("k = 1").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1
