"""Corrections that are off by default."""

from __future__ import annotations

import pytest

from cohortloom.plans import report as plan
from cohortloom.plans import streams
from cohortloom.spec import DEFAULT
from clinic import Clinic, ts


def rows(spark, clinic, stream, **switches):
    given = clinic.inputs(spark, DEFAULT.switched(**switches))
    return streams.ranked(given, stream).collect()


@pytest.mark.parametrize("on, flags", [(False, [None]), (True, ["MASTECTOMY"])])
def test_prefixed_type_values(spark, on, flags):
    clinic = Clinic().factor("WH BILATERAL MASTECTOMY", "OUTSIDE RESULTS")
    assert [r.flag for r in rows(spark, clinic, "observations", prefixed_values=on)] == flags


@pytest.mark.parametrize("on, count", [(False, 0), (True, 1)])
def test_prefixed_category_values(spark, on, count):
    clinic = Clinic().factor("ANY", "MATERNITY CARE")
    assert len(rows(spark, clinic, "observations", prefixed_values=on)) == count


def test_positive_only_for_named_tests(spark):
    clinic = Clinic().lab("PREGNANCY TEST", "POS").lab("HPV DNA", "POS")
    found = rows(spark, clinic, "labs", positive_only_for=("%HPV%",))
    assert {r.label: r.flag for r in found} == {"LAB PREGNANCY TEST": None, "LAB HPV DNA": "HPV POS"}


def test_surgical_newest_first(spark):
    clinic = Clinic().surgery("BREAST", taken="2020-01-01 00:00:00").surgery("BREAST")
    found = rows(spark, clinic, "surgical", surgical_newest_first=True)
    assert {r.event_ts.year: r.recency for r in found} == {2023: 1, 2020: 2}


def test_rank_by_shown_time(spark):
    clinic = Clinic().cyto("CERVIX", taken=None, received="2023-12-01 00:00:00")
    clinic.cyto("CERVIX", taken="2020-01-01 00:00:00")
    found = rows(spark, clinic, "cytology", rank_by_shown_time=True)
    assert {r.event_ts.year: r.recency for r in found} == {2023: 1, 2020: 2}


def test_lookback_on_every_stream(spark):
    clinic = Clinic().person()
    for when in ("2021-02-28 10:00:00", "2021-03-01 00:00:00"):
        clinic.lab("HPV", "x", when).cyto("CERVIX", taken=when).surgery("CERVIX", taken=when)
        clinic.factor("X", "WH MAMMOGRAM", when)
    for stream in ("labs", "cytology", "surgical", "observations"):
        found = rows(spark, clinic, stream, lookback_all=True)
        assert [r.event_ts for r in found] == [ts("2021-03-01 00:00:00")], stream
    report = plan.report(clinic.inputs(spark, DEFAULT.switched(lookback_all=True))).collect()
    assert {r.event_date.month for r in report} == {3}


def test_lookback_has_a_time_of_day_also_in_the_report(spark):
    clinic = Clinic().person().code(7, "OBSTETRIC", "VISIT")
    for when in ("2021-02-28 09:00:00", "2021-02-28 11:00:00"):
        clinic.procedure(7, when=when, Comments=when).lab("HPV", when, when)
    rows = plan.report(clinic.inputs(spark, DEFAULT.switched(lookback_all=True))).collect()
    assert [r.detail for r in rows] == ["2021-02-28 11:00:00"] * 2


def test_partial_labels(spark):
    clinic = Clinic().person().surgery("BREAST", number=None).cyto("CERVIX", sample=None)
    given = clinic.inputs(spark, DEFAULT.switched(keep_partial_labels=True))
    assert {r.label for r in plan.report(given).collect()} == {"BREAST", "CERVIX"}


@pytest.mark.parametrize("on, codes", [(False, ["ICD10 D1"]), (True, [None])])
def test_unknown_visits_do_not_join(spark, on, codes):
    clinic = Clinic().code(7, "OBSTETRIC", "VISIT").procedure(7, visit=-1).diagnosis(1, visit=-1)
    assert [r.code1 for r in rows(spark, clinic, "procedures", drop_missing_ids=on)] == codes


@pytest.mark.parametrize(
    "rule, shown",
    [("any", {"PERSON,1", "PERSON,2", "PERSON,3"}), ("every", {"PERSON,1"}), ("newest", {"PERSON,1", "PERSON,3"})],
)
def test_one_enrollment_status_per_person(spark, rule, shown):
    clinic = Clinic()
    dated = {1: [("ENROLLED", "2020")], 2: [("ENROLLED", "2020"), ("CANCELLED", "2021")], 3: [("REJECTED", None), ("ENROLLED", "2019"), ("PENDING", "2018")], 4: [("CANCELLED", None)]}
    for sid, rows_of in dated.items():
        clinic.person(sid, enrolled=False).factor("X", "WH MAMMOGRAM", sid=sid)
        for category, year in rows_of:
            clinic.enroll(sid, category)
            clinic.rows["enrollment"][-1]["EnrollmentDateTime"] = ts(f"{year}-05-01 08:00:00") if year else None
    given = clinic.inputs(spark, DEFAULT.switched(enrollment=rule))
    assert {r.person_name for r in plan.report(given).collect()} == shown
    assert {r.person_name for r in plan.report(plan.sized(given), person_rank=True).collect()} == shown


def test_enrollment_without_dates_is_decided_by_any_row(spark):
    clinic = Clinic().person(1).enroll(1, "CANCELLED").factor("X", "WH MAMMOGRAM")
    assert plan.report(clinic.inputs(spark, DEFAULT.switched(enrollment="newest"))).count() == 1
    with pytest.raises(ValueError):
        DEFAULT.switched(enrollment="sometimes")


@pytest.mark.parametrize("on, codes", [(False, {"ICD10 OLD", "ICD10 NEW", "ICD10 LATER"}), (True, {"ICD10 NEW"})])
def test_newest_description_at_the_event(spark, on, codes):
    clinic = Clinic().person().code(7, "OBSTETRIC", "VISIT").procedure(7, when="2023-05-01 08:00:00")
    clinic.add("v_diagnosis", PatientSID=1, VisitSID=1, ICD10SID=5, ICD9SID=6)
    versions = [("OLD", None), ("NEW", "2023-05-01 12:00:00"), ("LATER", "2023-05-02 00:00:00")]
    for text, since in versions:
        clinic.add("icd10_description", ICD10SID=5, ICD10Description=text, EffectiveDateTime=ts(since))
    clinic.add("icd9_description", ICD9SID=6, ICD9Description="TOO LATE", EffectiveDateTime=ts("2024-01-01 00:00:00"))
    given = clinic.inputs(spark, DEFAULT.switched(newest_description=on))
    found = rows(spark, clinic, "procedures", newest_description=on)
    assert {r.code1 for r in found} == codes and len(found) == len(codes)
    assert {r.code2 for r in found} == {None if on else "ICD9 TOO LATE"}
    for form in (given, plan.sized(given)):  # in days, the event and the version are of one day
        assert {r.code1 for r in plan.report(form).collect()} == codes


def test_states_come_from_all_years(spark):
    clinic = Clinic().person().factor("X", "WH MAMMOGRAM")
    clinic.factor("WH HYSTERECTOMY W/CERVIX REMOVED", "PROCEDURES", "2022-01-01 08:00:00")
    kinds = {r["HealthFactorType"]: r["HealthFactorTypeSID"] for r in clinic.rows["health_factor_type"]}
    old = kinds["WH HYSTERECTOMY W/CERVIX REMOVED"]
    history = [dict(r) for r in clinic.rows["health_factor"]]
    for year in (1999, 2001):
        history.append(dict(history[-1], HealthFactorTypeSID=old, HealthFactorDateTime=ts(f"{year}-01-01 08:00:00")))
    clinic.rows["health_factor"] = clinic.rows["health_factor"][:1]  # the rolling years have none
    clinic.rows["health_factor_history"] = history[:1] + history[2:]
    states = dict(states=("MASTECTOMY", "HYSTERECTOMY"), lookback_all=True)
    given = clinic.inputs(spark, DEFAULT.switched(**states))
    for form in (given, plan.sized(given)):
        got = plan.report(form).collect()
        assert {(r.label, r.event_date.year, r.flag) for r in got if r.flag} == {("HFT WH HYSTERECTOMY W/CERVIX REMOVED", 2001, "HYSTERECTOMY")}
        assert any(r.label == "HFT X" for r in got)
    assert "states" not in streams.present(DEFAULT) and "states" in streams.present(given.spec)
    latest = plan.report(given, latest_only=True).collect()
    assert [r.event_date.year for r in latest if r.flag] == [2001]
    del clinic.rows["health_factor_history"]  # without the full table, the newest of what there is
    assert not [r for r in plan.report(clinic.inputs(spark, DEFAULT.switched(**states))).collect() if r.flag]


def test_persons_who_left_the_region_long_ago(spark):
    clinic, moves = Clinic(), {1: [], 2: [(False, "2020-01-01")], 3: [(False, "2023-01-01")], 4: [(False, "2019-01-01"), (True, "2020-01-01")], 5: [(None, "2020-01-01")], 6: [(False, "2022-02-28"), (True, "2022-02-28")]}
    clinic.rows["address"] = []
    for sid, changes in moves.items():
        clinic.person(sid).factor("X", "WH MAMMOGRAM", sid=sid)
        for inside, when in changes:
            clinic.add("address", PatientSID=sid, InRegion=inside, ChangedDateTime=ts(f"{when} 08:00:00"))
    shown = lambda **s: {r.person_name for r in plan.report(clinic.inputs(spark, DEFAULT.switched(**s))).collect()}
    assert len(shown()) == 6 and shown(region_years=2) == {f"PERSON,{i}" for i in (1, 3, 4, 5, 6)}
