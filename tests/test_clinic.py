"""Hand-worked cases: what each stream and the report do at the edges."""

from __future__ import annotations

import datetime as dt

import pytest

from cohortloom.plans import report as plan
from cohortloom.plans import sections, streams
from cohortloom.spec import DEFAULT
from clinic import Clinic, ts

PROC = {"exact": "BREAST MAMMOGRAPHY", "cervical": "FEMALE GENITAL SYSTEM"}


def events(spark, clinic, stream, **more):
    return streams.ranked(clinic.inputs(spark, **more), stream).collect()


def report(spark, clinic, spec=DEFAULT, **more):
    options = {k: more.pop(k) for k in ("show_rank", "person_rank", "latest_only") if k in more}
    return plan.report(clinic.inputs(spark, spec, **more), **options).collect()


@pytest.mark.parametrize(
    "category, name, section",
    [
        ("BREAST MAMMOGRAPHY", "ANYTHING", "breast"),
        ("BREAST MAMMOGRAPHY", None, "breast"),
        ("PATIENT", "MASTECTOMY PARTIAL", "breast"),
        ("PATIENT", "OFFICE VISIT", None),
        ("*Missing*", "MAMMO SCREEN", "breast"),
        ("xMissingx", "MAMMO SCREEN", None),
        ("PATIENT", "OB ULTRASOUND", "cervical"),
        ("PATIENT", "OBSERVATION", None),
        ("PATIENT", "TRANSVAGINAL US", "cervical"),
        ("PATIENT", "C/V SMEAR", "cervical"),
        ("PATIENT", None, None),
        (None, "MAMMO SCREEN", None),
        ("OBSTETRIC", "VISIT", "cervical"),
    ],
)
def test_procedure_code_sets(spark, category, name, section):
    clinic = Clinic().code(7, category, name).procedure(7)
    given = clinic.inputs(spark)
    found = streams.selected_procedures(given, given.spec.sections).collect()
    assert [r.section for r in found] == ([section] if section else [])


def test_visit_fan_out_counts_every_combination(spark):
    clinic = Clinic().code(7, PROC["exact"], "MAMMO LEFT").code(8, PROC["exact"], "MAMMO RIGHT")
    clinic.procedure(7).procedure(8)
    clinic.diagnosis(1).diagnosis(2).diagnosis(3)
    clinic.exam("BI-RADS CATEGORY 4").exam("BI-RADS CATEGORY 1")
    rows = events(spark, clinic, "procedures")
    assert len(rows) == 12
    assert sorted(r.recency for r in rows) == list(range(1, 13))
    assert {r.label for r in rows} == {"CPT MAMMO LEFT", "CPT MAMMO RIGHT"}
    assert {r.code1 for r in rows} == {"ICD10 D1", "ICD10 D2", "ICD10 D3"}


def test_thin_grain_drops_copies_before_the_fan_out(spark):
    clinic = Clinic().person().code(7, PROC["exact"], "MAMMO LEFT")
    for _ in range(3):
        clinic.procedure(7)
    clinic.exam("BI-RADS CATEGORY 4")
    clinic.rows["radiology_exam"] *= 3
    assert len(events(spark, clinic, "procedures")) == 9
    assert streams.procedures(clinic.inputs(spark, grain=streams.REPORT)).count() == 1
    assert len(report(spark, clinic)) == 1


def test_procedure_without_diagnosis_is_kept(spark):
    clinic = Clinic().code(7, PROC["cervical"], "PAP").procedure(7, Comments="note")
    (row,) = events(spark, clinic, "procedures")
    assert (row.section, row.detail, row.code1, row.code2, row.flag) == (
        "cervical",
        "note",
        None,
        None,
        None,
    )


def test_breast_procedure_without_exam_is_dropped(spark):
    clinic = Clinic().code(7, PROC["exact"], "MAMMO").procedure(7, Comments="note")
    assert events(spark, clinic, "procedures") == []


def test_procedure_in_both_sections(spark):
    clinic = Clinic().code(7, "DIAGNOSTIC ULTRASOUND", "BREAST AND VAGINAL US")
    clinic.procedure(7, Comments="note").exam("MINOR ABNORMALITY")
    rows = {r.section: r for r in events(spark, clinic, "procedures")}
    assert (rows["breast"].detail, rows["breast"].flag) == ("MINOR ABNORMALITY", "Y")
    assert (rows["cervical"].detail, rows["cervical"].flag) == ("note", None)


@pytest.mark.parametrize(
    "when, cancel, kept",
    [
        ("2021-02-28 10:00:00", 0, False),
        ("2021-02-28 10:00:01", 0, True),
        (None, 0, False),
        ("2023-01-01 00:00:00", -1, True),
        ("2023-01-01 00:00:00", 5, False),
        ("2023-01-01 00:00:00", None, False),
    ],
)
def test_exam_look_back_and_cancel_reason(spark, when, cancel, kept):
    clinic = Clinic().code(7, PROC["exact"], "MAMMO").procedure(7)
    clinic.exam("NEGATIVE", when=when, cancel=cancel)
    assert len(events(spark, clinic, "procedures")) == int(kept)


@pytest.mark.parametrize(
    "result, flag",
    [
        ("BI-RADS CATEGORY 4", "Y"),
        ("Admin see case completion", "Y"),
        ("BI-RADS CATEGORY 1", "N"),
        (None, "N"),
    ],
)
def test_exam_flags(spark, result, flag):
    clinic = Clinic().code(7, PROC["exact"], "MAMMO").procedure(7).exam(result)
    (row,) = events(spark, clinic, "procedures")
    assert (row.detail, row.flag) == (result, flag)


@pytest.mark.parametrize(
    "kind, category, section, flag",
    [
        ("HFT WH BILATERAL MASTECTOMY", "OUTSIDE RESULTS", "breast", "MASTECTOMY"),
        ("WH BILATERAL MASTECTOMY", "OUTSIDE RESULTS", "breast", None),
        ("HFT WH OUTSIDE ABNL MAMMOGRAM", "WH MAMMOGRAM", "breast", "Y"),
        ("OUTSIDE CERVICAL HPV TESTING POSITIVE", "OUTSIDE RESULTS", "cervical", "HPV POS"),
        ("WH HYSTERECTOMY W/CERVIX REMOVED", "PROCEDURES", "cervical", "HYSTERECTOMY"),
        ("WH PAP SMEAR SCREEN FREQ - 6M", "WH PAP SMEAR", "cervical", "Y"),
        ("ANY", "HFC MATERNITY CARE", "cervical", None),
    ],
)
def test_observation_flags(spark, kind, category, section, flag):
    clinic = Clinic().factor(kind, category, Comments="note")
    (row,) = events(spark, clinic, "observations")
    assert (row.section, row.flag, row.detail) == (section, flag, "note")
    assert (row.label, row.code1, row.code2) == (f"HFT {kind}", f"HFC {category}", None)


def test_observation_without_type_row_or_outside_sets(spark):
    clinic = Clinic().factor("MAMMO", "MATERNITY CARE").factor("COLON", "REMINDER FACTORS")
    clinic.add("health_factor", PatientSID=1, HealthFactorTypeSID=99)
    assert events(spark, clinic, "observations") == []


@pytest.mark.parametrize(
    "finding, flag", [("NORMAL TISSUE MORPHOLOGY", None), ("DYSPLASIA", "Y"), (None, None)]
)
def test_cytology_flags(spark, finding, flag):
    clinic = Clinic().cyto("VAGINA", findings=[finding])
    (row,) = events(spark, clinic, "cytology")
    assert (row.label, row.detail, row.flag) == ("SMEAR VAGINA", finding, flag)
    assert (row.code1, row.code2) == ("SNOMED T-1", "Morph M-1")


def test_cytology_without_morphology_is_kept_and_m_by_s_fan_out(spark):
    assert len(events(spark, Clinic().cyto("CERVIX"), "cytology")) == 1
    clinic = Clinic().cyto("CERVIX", findings=["A", "B"])
    clinic.add("cyto_specimen", CytopathologyIEN=1, LabDataIEN=1, CollectionSample="SWAB", TopographyFieldIEN=1)
    assert len(events(spark, clinic, "cytology")) == 4


@pytest.mark.parametrize(
    "topography, found",
    [
        ("LEFT OVARY", {"cervical"}),
        ("OVARY, LEFT", set()),
        ("FEMALE BREAST, NOS", {"breast", "cervical"}),
        ("MALE BREAST", {"breast"}),
        ("CERVICAL CYTOLOGIC MATERIAL", {"cervical"}),
        ("CERVICAL CYTOLOGIC MATERIALS", set()),
        ("VAGINA AND CERVIX, CS", {"cervical"}),
    ],
)
def test_topography_sets(spark, topography, found):
    rows = events(spark, Clinic().cyto(topography), "cytology")
    assert {r.section for r in rows} == found


def test_shown_time_falls_back_to_received_but_rank_does_not(spark):
    clinic = Clinic().cyto("CERVIX", taken=None, received="2023-12-01 00:00:00")
    clinic.cyto("CERVIX", taken="2020-01-01 00:00:00")
    ranks = {r.event_ts: r.recency for r in events(spark, clinic, "cytology")}
    assert ranks == {ts("2023-12-01 00:00:00"): 2, ts("2020-01-01 00:00:00"): 1}


def test_surgical_ranks_oldest_first_with_unknown_first(spark):
    clinic = Clinic()
    for taken in ("2022-01-01", "2021-01-01", "2023-01-01"):
        clinic.surgery("LEFT BREAST", taken=f"{taken} 00:00:00")
    clinic.surgery("LEFT BREAST", taken=None, received="2024-01-01 00:00:00")
    ranks = {r.event_ts.year: r.recency for r in events(spark, clinic, "surgical")}
    assert ranks == {2024: 1, 2021: 2, 2022: 3, 2023: 4}


def test_surgical_fan_out_keeps_cases_without_morphology(spark):
    clinic = Clinic().surgery("CERVIX").surgery("OVARY", findings=["X", "Y"])
    rows = events(spark, clinic, "surgical")
    assert {(r.label, r.detail, r.code1) for r in rows} == {
        ("ACC1 CERVIX", None, None),
        ("ACC1 OVARY", "X", "SNOMED S-1"),
        ("ACC1 OVARY", "Y", "SNOMED S-2"),
    }


def test_missing_accession_number_voids_the_label(spark):
    clinic = Clinic().person().surgery("LEFT BREAST", number=None)
    assert [r.label for r in events(spark, clinic, "surgical")] == [None]
    assert report(spark, clinic) == []


def test_labs(spark):
    clinic = Clinic().lab("PREGNANCY TEST", "POSITIVE").lab("HPV DNA", "pos").lab("GLUCOSE", "POS")
    rows = {r.label: (r.detail, r.flag) for r in events(spark, clinic, "labs")}
    assert rows == {"LAB PREGNANCY TEST": ("POSITIVE", "HPV POS"), "LAB HPV DNA": ("pos", None)}


def test_lab_rank_follows_the_completion_time(spark):
    clinic = Clinic().lab("HPV", "a", "2023-01-01 00:00:00", "2023-03-01 00:00:00")
    clinic.lab("HPV", "b", "2023-02-01 00:00:00", "2023-02-02 00:00:00")
    assert {r.detail: r.recency for r in events(spark, clinic, "labs")} == {"a": 1, "b": 2}


@pytest.mark.parametrize(
    "values",
    [
        {"PatientName": "ZZTEST,A"},
        {"PatientName": None},
        {"DeceasedFlag": "Y"},
        {"DeceasedFlag": None},
        {"Gender": "M"},
        {"enrolled": False},
        {"Sta3n": 640},
    ],
)
def test_persons_left_out(spark, values):
    clinic = Clinic().person(**values).factor("X", "WH MAMMOGRAM")
    assert report(spark, clinic, sites=None) == []


def test_any_enrolled_row_keeps_a_person_once(spark):
    clinic = Clinic().person().enroll(1, "CANCELLED").enroll(1, "ENROLLED")
    clinic.factor("X", "WH MAMMOGRAM")
    assert len(report(spark, clinic)) == 1


def test_order_labels_are_left_out(spark):
    clinic = Clinic().person().factor("MAMMO ORDERED", "WH MAMMOGRAM").factor("X", "WH MAMMOGRAM")
    assert [r.label for r in report(spark, clinic)] == ["HFT X"]


def test_age_counts_year_boundaries_and_unknown_time_is_kept(spark):
    clinic = Clinic().person().factor("A", "WH MAMMOGRAM", "2023-12-31 23:00:00")
    clinic.factor("B", "WH MAMMOGRAM", None)
    rows = {r.label: (r.age_at_event, r.event_date) for r in report(spark, clinic)}
    assert rows == {"HFT A": (39, dt.date(2023, 12, 31)), "HFT B": (None, None)}


def test_events_of_one_day_and_of_both_sections_appear_once(spark):
    clinic = Clinic().person().cyto("FEMALE BREAST, NOS")
    clinic.factor("X", "WH MAMMOGRAM", "2023-05-01 08:00:00")
    clinic.add(
        "health_factor", PatientSID=1, HealthFactorTypeSID=1, HealthFactorDateTime=ts("2023-05-01 09:00:00")
    )
    assert sorted(r.label for r in report(spark, clinic)) == ["HFT X", "SMEAR FEMALE BREAST, NOS"]


def test_equal_rows_of_two_sections_unite(spark):
    clinic = Clinic().cyto("FEMALE BREAST, NOS")
    given = clinic.inputs(spark)
    assert sections.ranked_events(given).count() == 2
    assert sections.all_events(given).count() == 1


def test_events_join_persons_of_their_own_site(spark):
    clinic = Clinic().person(Sta3n=612).person(Sta3n=640, PatientName="OTHER,1")
    clinic.factor("X", "WH MAMMOGRAM", Sta3n=640)
    assert [(r.site, r.person_name) for r in report(spark, clinic, sites=None)] == [(640, "OTHER,1")]
    assert report(spark, clinic, sites=(612,)) == []


def test_rank_columns_and_latest_only(spark):
    clinic = Clinic().person().enroll(1, "ENROLLED")
    for day in (1, 2, 3):
        clinic.factor("X", "WH MAMMOGRAM", f"2023-05-0{day} 08:00:00")
    latest = report(spark, clinic, latest_only=True)
    assert [r.event_date for r in latest] == [dt.date(2023, 5, 3)]
    shown = report(spark, clinic, show_rank=True)
    assert {r.event_date.day: r.recency for r in shown} == {3: 1, 2: 2, 1: 3}
    # A second enrolled row doubles what the person rank counts.
    numbered = report(spark, clinic, person_rank=True)
    assert sorted((r.event_date.day, r.person_rank) for r in numbered) == [
        (1, 5), (1, 6), (2, 3), (2, 4), (3, 1), (3, 2),
    ]


def test_person_listed_twice_is_not_ranked_twice(spark):
    clinic = Clinic().person().person(PatientName="ALIAS,1", enrolled=False)
    clinic.factor("X", "WH MAMMOGRAM", "2023-05-01 08:00:00").factor("X", "WH MAMMOGRAM", "2023-05-02 08:00:00")
    rows = report(spark, clinic, show_rank=True)
    assert sorted((r.person_name, r.recency) for r in rows) == [
        ("ALIAS,1", 1), ("ALIAS,1", 2), ("PERSON,1", 1), ("PERSON,1", 2),
    ]


def test_client_names(spark):
    clinic = Clinic().person().factor("X", "WH MAMMOGRAM")
    named = plan.client_names(plan.report(clinic.inputs(spark)))
    assert named.columns == [
        "Sta3n", "PatientName", "PatientSSN", "AgeAtEvent", "EventDate",
        "ProcedureName", "Diagnosis", "Code1", "Code2", "Abnormal",
    ]
