"""One visit, case or person holding thousands of rows on every side of a join.

Joined row by row these fixtures give 10^10 rows and more; the report must come
from the distinct values of each side.
"""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.operators import skew
from cohortloom.plans import report as plan
from cohortloom.plans import streams
from cohortloom.plans.streams import Inputs
from cohortloom.sources.loader import Tables
from cohortloom.spec import DEFAULT, Run
from clinic import AS_OF, SITE, Clinic

COPIES = 5000
UNKNOWN = "IF(id < 0, 0, -1)"  # always -1, but no constant that the optimizer could join by


def rows(spark, table: str, n: int = COPIES, **values: str):
    """``n`` rows with the given SQL expressions over ``id``; the rest NULL."""
    values = {"Sta3n": str(SITE), **values}
    return spark.range(n).selectExpr(
        *[
            f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schemas.struct(table).fields
        ]
    )


def inputs(spark, clinic: Clinic, **hot) -> Inputs:
    places = {n: (lambda n=n: clinic.frame(spark, n)) for n in schemas.SOURCES} | hot
    return Inputs(Tables(spark, places, (SITE,)), Run.at(AS_OF, (SITE,)), DEFAULT)


def report(spark, clinic: Clinic, **hot):
    return plan.report(inputs(spark, clinic, **hot))


def hot_visit(spark) -> Inputs:
    clinic = Clinic().person().code(7, "BREAST MAMMOGRAPHY", "MAMMO")
    for key in range(3):
        clinic.add("icd10_description", ICD10SID=key, ICD10Description=f"D{key}")
        clinic.add(
            "radiology_diagnostic_code",
            RadiologyDiagnosticCodeSID=key,
            RadiologyDiagnosticCode=f"R{key}",
        )
    return inputs(
        spark,
        clinic,
        v_procedure=rows(
            spark,
            "v_procedure",
            PatientSID="1",
            VisitSID=UNKNOWN,
            CPTSID="7",
            VisitDateTime="timestamp_ntz'2023-05-01 00:00:00' + make_dt_interval(0, 0, 0, id)",
        ),
        v_diagnosis=rows(spark, "v_diagnosis", PatientSID="1", VisitSID=UNKNOWN, ICD10SID="id % 3"),
        radiology_exam=rows(
            spark,
            "radiology_exam",
            VisitSID=UNKNOWN,
            RadiologyRegisteredExamSID="id",
            RadiologyDiagnosticCodeSID="id % 3",
            RadiologyHoldCancelReasonSID="0",
        ),
        radiology_registered_exam=rows(
            spark,
            "radiology_registered_exam",
            RadiologyRegisteredExamSID="id",
            ExamDateTime="timestamp_ntz'2023-05-01 00:00:00'",
        ),
    )


def test_an_unknown_visit_does_not_multiply(spark):
    found = plan.report(hot_visit(spark))
    assert found.count() == 9
    assert found.select("event_date").distinct().count() == 1


def test_the_latest_event_of_an_unknown_visit(spark):
    found = plan.report(hot_visit(spark), latest_only=True).collect()
    assert [(r.code1, r.detail) for r in found] == [("ICD10 D0", "R0")]


def test_ranks_count_copies_without_joining_them(spark):
    clinic = Clinic().code(7, "OBSTETRIC", "VISIT").diagnosis(1).diagnosis(2)
    given = inputs(
        spark,
        clinic,
        v_procedure=rows(
            spark,
            "v_procedure",
            PatientSID="1",
            VisitSID="1",
            CPTSID="7",
            VisitDateTime="timestamp_ntz'2023-05-01 00:00:00'",
        ),
    )
    counted = streams.procedures(replace(given, grain=streams.COUNTED)).collect()
    assert sorted(r.copies for r in counted) == [COPIES, COPIES]
    ranked = streams.ranked(given, "procedures")
    by_code = ranked.groupBy("code1").agg(F.min("recency"), F.max("recency"), F.countDistinct("recency"))
    assert sorted(tuple(r) for r in by_code.collect()) == [
        ("ICD10 D1", 1, COPIES, COPIES),
        ("ICD10 D2", COPIES + 1, 2 * COPIES, COPIES),
    ]


def test_an_unknown_case_does_not_multiply(spark):
    clinic = Clinic().person()
    for key in range(3):
        clinic.add("topography", TopographyIEN=key, Topography=f"BREAST {key}", SNOMEDCode="T")
        clinic.add("morphology", MorphologyIEN=key, Morphology=f"M{key}", SnomedCode="M")
    case = {"CytopathologyIEN": "-1", "LabDataIEN": "-1"}
    found = report(
        spark,
        clinic,
        cytopathology=rows(
            spark,
            "cytopathology",
            PatientSID="1",
            DateTimeSpecimenTaken="timestamp_ntz'2023-05-01 00:00:00' + make_dt_interval(0, 0, 0, id)",
            **case,
        ),
        cyto_specimen=rows(
            spark, "cyto_specimen", CollectionSample="'S'", TopographyFieldIEN="id % 3", **case
        ),
        cyto_organ_morphology=rows(
            spark, "cyto_organ_morphology", MorphologyFieldIEN="id % 3", **case
        ),
    )
    assert found.count() == 9


def test_a_person_with_most_events_and_enrollments(spark):
    clinic = Clinic().person().person(2).enroll(1, "CANCELLED")
    clinic.add("lab_chem_test", LabChemTestSID=1, LabChemTestName="HPV")
    found = report(
        spark,
        clinic,
        enrollment=rows(
            spark, "enrollment", PatientSID="IF(id = 0, 2, 1)", EnrollmentStatusSID="1"
        ),
        lab_chem=rows(
            spark,
            "lab_chem",
            PatientSID="IF(id % 3 = 0, 2, 1)",
            LabChemTestSID="1",
            LabChemSpecimenDateTime="timestamp_ntz'2023-05-01 00:00:00'",
            LabChemResultValue="'v' || id",
        ),
    )
    assert found.count() == COPIES
    shares = {r["person_name"]: r["count"] for r in found.groupBy("person_name").count().collect()}
    assert shares == {"PERSON,1": COPIES - (COPIES + 2) // 3, "PERSON,2": (COPIES + 2) // 3}
    assert found.where(F.col("age_at_event") != 39).isEmpty()


@contextmanager
def without_help(spark):
    """No adaptive execution and no automatic broadcast: what a plan spreads, it spreads itself."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def largest_share(df) -> float:
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def by_shuffle(given: Inputs, heavy_rows: int | None) -> Inputs:
    """``given`` as sized, but with no persons, visits and cases few enough to broadcast."""
    found = plan.sized(given)
    dimensions = found.run.broadcast & set(schemas.DIMENSIONS)
    run = replace(found.run, broadcast=dimensions, heavy_rows=heavy_rows)
    return streams.with_heavy_keys(replace(found, run=run, heavy=None))


def test_heavy_keys_are_found_with_their_counts(spark):
    keys = [None] * 3000 + [7] * 2000 + [8] * 500 + list(range(1000, 3000))
    df = spark.createDataFrame([(1, k) for k in keys], "g int, k long")
    found = skew.heavy_keys([(df, {"k": ["k"], "both": ["g", "k"]}), (df.limit(0), {"none": ["k"]})], 600)
    counted = df.groupBy("k").agg(F.count("*").alias("n")).where("n > 600")
    exact = {r["h"]: -(-r["n"] // 600) for r in counted.select(F.xxhash64("k").alias("h"), "n").collect()}
    assert found["k"] == exact and sorted(exact.values()) == [4, 5]
    assert sorted(found["both"].values()) == [4, 5]
    assert found["none"] == {}


def test_more_heavy_keys_than_are_kept(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    found = skew.heavy_keys([(df, {"k": ["k"]})], 10, most=4)
    assert len(found["k"]) == 4 and set(found["k"].values()) == {10}


def test_nothing_to_look_for(spark):
    assert skew.heavy_keys([], 10) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_joins_equal_plain_joins(spark, how):
    """Null keys, keys of one side only, repeated rows, several rows a key on both sides."""
    many = spark.createDataFrame(
        [(1, i % 50) for i in range(400)] + [(None, i) for i in range(300)] + [(2, 5), (2, 5), (3, 1)], "k long, v long"
    )
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (4, "d"), (None, "e")], "k int, w string")
    slices = skew.heavy_keys([(many, {"k": ["k"]})], 100)["k"]
    assert sorted(slices.values()) == [3, 4]
    found = skew.sliced_join(many, one, ["k"], slices, ["v"], how)
    assert found.columns == ["k", "v", "w"]
    assert same_rows(found, many.join(one, "k", how))
    assert same_rows(skew.sliced_join(many, one, ["k"], {}, ["v"], how), many.join(one, "k", how))


def test_null_keys_of_a_left_join_are_spread(spark):
    many = spark.range(4000).select(F.when(F.col("id") % 100 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    one = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    slices = skew.heavy_keys([(many, {"k": ["k"]})], 100)["k"]
    with without_help(spark):
        assert largest_share(many.join(one, "k", "left")) > 0.9
        assert largest_share(skew.sliced_join(many, one, ["k"], slices, ["v"], "left")) < 0.5


def test_an_unknown_visit_is_dealt_to_tasks(spark):
    """Its procedures, distinct by second here, meet diagnoses and exams in several tasks
    without adaptive execution; without slices all meet in one."""
    given = hot_visit(spark)
    sliced, plain = by_shuffle(given, 100), by_shuffle(given, None)
    assert plain.heavy is None
    assert {k: list(v.values()) for k, v in sliced.heavy.items() if k.startswith("procedures")} == {
        "procedures_visits": [50],
        "procedures_person_visits": [50],
        "procedures_persons": [50],
    }
    grain = {"grain": streams.THIN, "persons": plan.eligible_persons(given)}
    with without_help(spark):
        found, one_task = (streams.procedures(replace(i, **grain)) for i in (sliced, plain))
        assert largest_share(one_task) == 1
        assert largest_share(found) < 0.5
        assert found.count() == 9 * COPIES
        assert same_rows(found, one_task)
    assert same_rows(plan.report(sliced), plan.report(given))


def test_an_unknown_case_and_its_person_are_dealt_to_tasks(spark):
    clinic = Clinic().person()
    for key in range(3):
        clinic.add("topography", TopographyIEN=key, Topography=f"BREAST {key}", SNOMEDCode="T")
        clinic.add("morphology", MorphologyIEN=key, Morphology=f"M{key}", SnomedCode="M")
    case = {"CytopathologyIEN": UNKNOWN, "LabDataIEN": UNKNOWN}
    given = inputs(
        spark,
        clinic,
        cytopathology=rows(
            spark,
            "cytopathology",
            PatientSID="1",
            DateTimeSpecimenTaken="timestamp_ntz'2023-05-01 00:00:00' + make_dt_interval(0, 0, 0, id)",
            **case,
        ),
        cyto_specimen=rows(spark, "cyto_specimen", CollectionSample="'S'", TopographyFieldIEN="id % 3", **case),
        cyto_organ_morphology=rows(spark, "cyto_organ_morphology", MorphologyFieldIEN="id % 3", **case),
    )
    sliced = by_shuffle(given, 100)
    assert list(sliced.heavy["cytology_cases"].values()) == [50]
    with without_help(spark):
        found = streams.cytology(replace(sliced, grain=streams.THIN, persons=plan.eligible_persons(given)))
        assert found.count() == 9 * COPIES
        assert largest_share(found) < 0.5
    for options in ({}, {"latest_only": True}):
        assert same_rows(plan.report(sliced, **options), plan.report(given, **options))


def test_copies_are_counted_alike_in_slices(spark):
    """The counted grain, on which ranks rest: heavy keys change no count."""
    clinic = Clinic().code(7, "OBSTETRIC", "VISIT").diagnosis(1).diagnosis(2)
    given = inputs(
        spark,
        clinic,
        v_procedure=rows(
            spark,
            "v_procedure",
            PatientSID="1",
            VisitSID="IF(id % 2 = 0, 1, NULL)",
            CPTSID="7",
            VisitDateTime="timestamp_ntz'2023-05-01 00:00:00' + make_dt_interval(0, 0, 0, id % 10)",
        ),
    )
    found = [
        streams.procedures(replace(i, grain=streams.COUNTED)) for i in (given, by_shuffle(given, 50), by_shuffle(given, None))
    ]
    counts = [Counter(tuple(r) for r in f.select("event_ts", "code1", "copies").collect()) for f in found]
    assert counts[0] == counts[1] == counts[2]
    assert sum(n * r[2] for r, n in counts[0].items()) == COPIES // 2 * 3


def test_a_person_with_most_labs_is_dealt_to_tasks(spark):
    clinic = Clinic().person().person(2)
    clinic.add("lab_chem_test", LabChemTestSID=1, LabChemTestName="HPV")
    given = inputs(
        spark,
        clinic,
        lab_chem=rows(
            spark,
            "lab_chem",
            PatientSID="IF(id % 10 = 0, 2, 1)",
            LabChemTestSID="1",
            LabChemSpecimenDateTime="timestamp_ntz'2023-05-01 00:00:00'",
            LabChemResultValue="'v' || id",
        ),
    )
    sliced = by_shuffle(given, 1000)
    assert list(sliced.heavy["labs_persons"].values()) == [5]  # the other person stays whole
    with without_help(spark):
        found = streams.labs(replace(sliced, persons=plan.eligible_persons(given)))
        assert largest_share(found) < 0.7 and found.count() == COPIES
    for options in ({}, {"show_rank": True}, {"person_rank": True}):
        assert same_rows(plan.report(sliced, **options), plan.report(given, **options))
