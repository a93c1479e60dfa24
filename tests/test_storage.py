"""Loading, staging, sizing, the stored report and the job."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.jobs import nightly
from cohortloom.operators import sizing
from cohortloom.operators.staging import run_folder, shared_folder, staged
from cohortloom.plans import report as plan
from cohortloom.plans import streams
from cohortloom.sinks.report_table import read_report, replace_report
from cohortloom.sinks.versions import VersionedFolder
from cohortloom.sources.loader import Tables
from clinic import Clinic


def stored(spark, folder) -> set[tuple]:
    return {tuple(r) for r in read_report(spark, folder).collect()}


def two_sites() -> Clinic:
    clinic = Clinic()
    for site in (612, 640):
        clinic.person(Sta3n=site, PatientName=f"PERSON,{site}")
        clinic.factor("X", "WH MAMMOGRAM", Sta3n=site)
    return clinic


@pytest.mark.parametrize("place", ["{tmp}/report", "stored_report"])
def test_rebuilding_one_site_leaves_the_other(spark, tmp_path, place):
    folder = place.format(tmp=tmp_path)
    clinic = two_sites()
    replace_report(plan.report(clinic.inputs(spark, sites=None)), folder)
    before = stored(spark, folder)
    assert {row[0] for row in before} == {612, 640}

    clinic.factor("NEW", "WH MAMMOGRAM")
    for _ in range(2):  # a rerun changes nothing
        replace_report(plan.report(clinic.inputs(spark)), folder, (612,))
        after = stored(spark, folder)
        assert {r for r in after if r[0] == 640} == {r for r in before if r[0] == 640}
        assert {r[5] for r in after if r[0] == 612} == {"HFT X", "HFT NEW"}


@pytest.mark.parametrize("place", ["{tmp}/report", "emptied_report"])
def test_a_site_without_rows_is_emptied(spark, tmp_path, place):
    folder = place.format(tmp=tmp_path)
    replace_report(plan.report(two_sites().inputs(spark, sites=None)), folder)
    replace_report(plan.report(Clinic().inputs(spark, sites=(612,))), folder, (612,))
    assert {row[0] for row in stored(spark, folder)} == {640}


def test_read_back_has_the_report_schema(spark, tmp_path):
    folder = str(tmp_path / "report")
    report = plan.report(two_sites().inputs(spark, sites=None))
    replace_report(report, folder)
    back = read_report(spark, folder)
    report = plan.client_names(report)
    assert back.columns == report.columns == [schemas.CLIENT_NAMES[c] for c in schemas.REPORT_COLUMNS]
    assert [f.dataType for f in back.schema] == [f.dataType for f in report.schema]
    assert back.exceptAll(report).isEmpty() and report.exceptAll(back).isEmpty()


def test_site_filter_prunes_partitions(spark, tmp_path):
    places = {}
    for site in (612, 640):
        clinic = two_sites()
        clinic.frame(spark, "patient").where(F.col("Sta3n") == site).write.mode("append").partitionBy(
            "Sta3n"
        ).parquet(str(tmp_path / "patient"))
    places["patient"] = str(tmp_path / "patient")
    tables = Tables(spark, places, sites=(640,))
    text = tables["patient"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Sta3n" in text and "(Sta3n#" in text
    assert [r.PatientName for r in tables["patient"].collect()] == ["PERSON,640"]


def test_catalog_tables_and_unknown_names(spark):
    Clinic().person().frame(spark, "patient").createOrReplaceTempView("their_patients")
    tables = Tables(spark, {"patient": "their_patients"})
    assert tables["patient"].count() == 1
    with pytest.raises(ValueError):
        Tables(spark, {"patients": "their_patients"})


def test_caseless_comparison(spark):
    clinic = Clinic().person(Gender="f ").lab("hpv dna ", "pos").factor("x", "wh mammogram")
    assert plan.report(clinic.inputs(spark)).isEmpty()
    rows = plan.report(plan.sized(clinic.inputs(spark, caseless=True))).collect()
    assert {(r.label, r.flag) for r in rows} == {("LAB hpv dna", "HPV POS"), ("HFT x", None)}


@pytest.mark.parametrize("hot_rows", [None, 100, 1])
def test_caseless_ranks(spark, hot_rows):
    clinic = Clinic().person()
    for day, name in enumerate(["HPV", "hpv", "Hpv "], 1):
        clinic.lab(name, "x", f"2023-05-0{day} 08:00:00")
        clinic.surgery("left breast", taken=f"2023-05-0{day} 08:00:00", findings=[name])
    given = clinic.inputs(spark, caseless=True, hot_rows=hot_rows)
    for stream, days in (("labs", [3, 2, 1]), ("surgical", [1, 2, 3])):
        rows = sorted(streams.ranked(given, stream).collect(), key=lambda r: r.recency)
        assert [r.event_ts.day for r in rows] == days
        assert [r.recency for r in rows] == [1, 2, 3]


@pytest.mark.parametrize("hot_rows", [None, 100, 1])
def test_spellings_are_rows_of_their_own(spark, hot_rows):
    clinic = Clinic().person()
    for value in ("POS", "pos", "POS"):
        clinic.lab("HPV", value, "2023-05-01 08:00:00")
    given = clinic.inputs(spark, caseless=True, hot_rows=hot_rows)
    rows = streams.ranked(given, "labs").collect()
    assert sorted((r.detail, r.recency) for r in rows) == [("POS", 1), ("POS", 2), ("pos", 3)]


def test_caseless_report_is_stored_as_plain_text(spark, tmp_path):
    folder = str(tmp_path / "report")
    clinic = Clinic().person().factor("x", "wh mammogram")
    replace_report(plan.report(clinic.inputs(spark, caseless=True)), folder, (612,))
    assert dict(read_report(spark, folder).dtypes)["ProcedureName"] == "string"


def test_staging_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5).withColumn("t", F.lit("a"))
    back = staged(df, "five")
    assert all(shared_folder(spark) in f for f in back.inputFiles())
    assert sorted(r.id for r in back.collect()) == list(range(5))


def test_sizes_are_measured_before_a_broadcast(spark):
    small = spark.range(10).withColumn("t", F.lit("abcd"))
    wide = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert sizing.measured({"small": small, "wide": wide}) == {"small": (10, 360), "wide": (10, 10320)}
    frames = {"small": small, "wide": wide, "long": spark.range(1000)}
    assert sizing.broadcastable(frames, max_rows=100, max_bytes=1000) == {"small"}
    assert sizing.broadcastable(frames) == {"small", "wide", "long"}
    assert sizing.broadcastable(frames, max_total=10_700) == {"small", "wide"}


def test_arrays_and_binaries_are_measured_by_content(spark):
    rows = spark.range(100).select("id", F.array_repeat(F.lit(123456789), 1000).alias("numbers"))
    packed = spark.range(100).select(F.repeat(F.lit("x"), 5000).cast("binary").alias("raw"))
    nested = spark.range(100).select(F.struct(F.repeat(F.lit("x"), 5000).alias("t"), "id").alias("s"))
    sizes = sizing.measured({"rows": rows, "packed": packed, "nested": nested})
    assert all(size > 100 * 4000 for _, size in sizes.values())
    assert sizing.broadcastable({"rows": rows, "packed": packed}, max_bytes=400_000) == frozenset()


def test_first_build_of_a_table_keeps_to_its_sites(spark):
    replace_report(plan.report(two_sites().inputs(spark, sites=None)), "first_report", (640,))
    assert {row[0] for row in stored(spark, "first_report")} == {640}


def test_many_visits_are_not_broadcast(spark, monkeypatch):
    clinic = Clinic().person().code(7, "OBSTETRIC", "VISIT")
    for visit in range(1, 6):
        clinic.procedure(7, visit=visit).diagnosis(visit, visit=visit)
    assert "procedures_keys" in plan.sized(clinic.inputs(spark)).run.broadcast
    monkeypatch.setattr(sizing.broadcastable, "__defaults__", (4, sizing.MAX_BYTES, sizing.MAX_TOTAL_BYTES))
    many = plan.sized(clinic.inputs(spark))
    assert "procedures_keys" not in many.run.broadcast and "procedures" in many.selected
    assert {r.code1 for r in plan.report(many).collect()} == {f"ICD10 D{v}" for v in range(1, 6)}


def test_staged_rows_are_removed_at_the_end_of_a_run(spark):
    with pytest.raises(ValueError), run_folder(spark) as folder:
        assert staged(spark.range(3), "names").count() == 3
        assert [name.startswith("names-") for name in os.listdir(folder)] == [True]
        raise ValueError
    assert not os.path.exists(folder)
    assert staged(spark.range(3), "names").count() == 3


def test_nightly_job(spark, tmp_path):
    clinic = two_sites()
    for name in schemas.SOURCES:
        clinic.frame(spark, name).write.parquet(str(tmp_path / "in" / name))
    run = ["--tables", str(tmp_path / "in"), "--out", str(tmp_path / "out")]
    run += ["--as-of", "2024-02-29T10:00:00"]
    nightly.main([*run, "--sites", "612"])
    assert {row[0] for row in stored(spark, str(tmp_path / "out"))} == {612}
    nightly.main([*run, "--sites", "612,640"])
    assert {row[0] for row in stored(spark, str(tmp_path / "out"))} == {612, 640}
    nightly.main([*run, "--place", f"health_factor={tmp_path}/in/lab_chem/../health_factor"])
    assert {row[0] for row in stored(spark, str(tmp_path / "out"))} == {612, 640}


class Dies(Exception):
    pass


def test_a_reader_sees_the_old_or_the_new_rows_only(spark, tmp_path):
    folder = str(tmp_path / "report")
    clinic = two_sites()
    replace_report(plan.report(clinic.inputs(spark, sites=None)), folder)
    opened = read_report(spark, folder)  # a reader that began before the rebuild
    before = stored(spark, folder)
    clinic.factor("NEW", "WH MAMMOGRAM").factor("NEW", "WH MAMMOGRAM", Sta3n=640)
    replace_report(plan.report(clinic.inputs(spark, sites=None)), folder, (612, 640))
    after = stored(spark, folder)
    assert {tuple(r) for r in opened.collect()} == before and len(after) == len(before) + 2
    assert "Aggregate" not in read_report(spark, folder)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("stage", ["rows", "log"])
def test_a_killed_rebuild_changes_nothing(spark, tmp_path, monkeypatch, stage):
    folder = str(tmp_path / "report")
    clinic = two_sites()
    replace_report(plan.report(clinic.inputs(spark, sites=None)), folder)
    before = stored(spark, folder)
    clinic.factor("NEW", "WH MAMMOGRAM")
    store = VersionedFolder(spark, folder, "Sta3n")

    if stage == "rows":  # after some partitions have been written

        def add(self, number, entry):
            raise Dies

        monkeypatch.setattr(VersionedFolder, "_add", add)
        with pytest.raises(Dies):
            replace_report(plan.report(clinic.inputs(spark, sites=None)), folder, (612, 640))
        monkeypatch.undo()
    else:  # in the middle of the log file
        (tmp_path / "report" / "log" / f"{store.numbers()[0] + 1:020d}.json").write_text('{"partitions": {"612"')
    assert stored(spark, folder) == before
    replace_report(plan.report(clinic.inputs(spark)), folder, (612,))
    assert len(stored(spark, folder)) == len(before) + 1
    gone = store.drop_old(keep=1)
    assert bool(gone) == (stage == "rows") and len(stored(spark, folder)) == len(before) + 1


def test_two_writers_of_different_sites_both_count(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "report")
    clinic = two_sites()
    replace_report(plan.report(clinic.inputs(spark, sites=None)), folder)
    clinic.factor("NEW", "WH MAMMOGRAM").factor("NEW", "WH MAMMOGRAM", Sta3n=640)
    first, add = [], VersionedFolder._add

    def late(self, number, entry):
        if not first:  # the other site's writer comes in between
            first.append(number)
            replace_report(plan.report(clinic.inputs(spark, sites=(640,))), folder, (640,))
        return add(self, number, entry)

    monkeypatch.setattr(VersionedFolder, "_add", late)
    replace_report(plan.report(clinic.inputs(spark)), folder, (612,))
    monkeypatch.undo()
    assert {(r[0], r[5]) for r in stored(spark, folder)} == {(612, "HFT X"), (612, "HFT NEW"), (640, "HFT X"), (640, "HFT NEW")}


def test_repeated_rows_are_stored_once_and_old_folders_are_read(spark, tmp_path):
    rows = plan.report(two_sites().inputs(spark, sites=None))
    replace_report(rows.unionByName(rows), str(tmp_path / "twice"))
    assert read_report(spark, str(tmp_path / "twice")).count() == rows.count()
    old = plan.client_names(rows)
    old.unionByName(old).write.partitionBy("Sta3n").parquet(str(tmp_path / "old"))
    assert stored(spark, str(tmp_path / "old")) == stored(spark, str(tmp_path / "twice"))
