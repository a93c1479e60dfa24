"""Sources that store text where ids and times should be, some of it unreadable."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clinic import AS_OF, SITE, Clinic
from cohortloom.jobs import nightly
from cohortloom.plans import report as plan
from cohortloom.plans.streams import Inputs
from cohortloom.sources.loader import Tables
from cohortloom.spec import DEFAULT, Run


def clinic() -> Clinic:
    return Clinic().person().code(7, "OBSTETRIC", "VISIT").procedure(7).diagnosis(1).procedure(7, visit=2)


def as_text(df):
    return df.select(*[F.col(c).cast("string") for c in df.columns])


def stored(spark):
    """The clinic's tables as text, and three procedures of which no part can be right."""
    places = {n: as_text(clinic().frame(spark, n)) for n in clinic().rows}
    rows = places["v_procedure"]
    good = rows.limit(1)
    bad = (
        good.withColumn("VisitDateTime", F.lit("2023-02-30 08:00:00"))
        .unionByName(good.withColumn("PatientSID", F.lit("unknown")).withColumn("VisitSID", F.lit("9" * 30)))
        .unionByName(good.withColumn("Sta3n", F.lit("six")))
        .unionByName(good.withColumn("Sta3n", F.lit("999")).withColumn("CPTSID", F.lit("x")))  # another site's
    )
    return places | {"v_procedure": rows.unionByName(bad)}


def shown(tables):
    inputs = Inputs(tables, Run.at(AS_OF, (SITE,), hot_rows=None), DEFAULT)
    return sorted(map(str, plan.report(inputs).collect()))


def test_the_report_is_that_of_the_readable_rows(spark):
    typed = shown(clinic().inputs(spark).tables)
    assert typed
    assert shown(Tables(spark, stored(spark), (SITE,), tolerant=True)) == typed
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shown(Tables(spark, stored(spark), (SITE,)))


def test_rejected_rows_have_reasons(spark):
    found = Tables(spark, stored(spark), (SITE,), tolerant=True).all_rejects().collect()
    assert {r["table"] for r in found} == {"v_procedure"}
    reasons = sorted([(x["column"], x["value"], x["wanted"]) for x in r["reasons"]] for r in found)
    assert reasons == [
        [("PatientSID", "unknown", "bigint"), ("VisitSID", "9" * 30, "bigint")],
        [("Sta3n", "six", "int")],
        [("VisitDateTime", "2023-02-30 08:00:00", "timestamp_ntz")],
    ]
    assert all(json.loads(r["row"])["CPTSID"] == "7" for r in found)


def test_every_row_is_kept_or_rejected(spark):
    places = stored(spark)
    tables = Tables(spark, places, tolerant=True)
    kept, rejected = tables["v_procedure"].count(), tables.rejects("v_procedure").count()
    assert (kept, rejected) == (2, 4)
    assert kept + rejected == places["v_procedure"].count()


def test_a_null_is_no_bad_value(spark):
    rows = spark.sql("SELECT '1' AS PatientSID, string(null) AS EnrollmentStatusSID, '612' AS Sta3n")
    tables = Tables(spark, {"enrollment": rows}, tolerant=True)
    assert [(r.PatientSID, r.EnrollmentStatusSID) for r in tables["enrollment"].collect()] == [(1, None)]
    assert tables.all_rejects().isEmpty()


def test_typed_sources_are_not_tested(spark):
    places = {n: clinic().frame(spark, n) for n in clinic().rows}
    tables = Tables(spark, places, (SITE,), tolerant=True)
    assert tables.all_rejects().isEmpty()
    text = tables["v_procedure"]._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in text.lower()


def test_the_job_stores_what_it_left_out(spark, tmp_path):
    for name, df in stored(spark).items():
        df.write.parquet(f"{tmp_path}/in/{name}")
    args = ["--tables", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--as-of", AS_OF.replace(" ", "T")]
    nightly.main([*args, "--sites", str(SITE), "--rejects", f"{tmp_path}/bad"])
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 3
