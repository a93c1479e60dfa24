"""Stream, section and report queries over the analogue sources."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.jobs.nightly import configure
from cohortloom.operators.staging import shared_folder, staged
from cohortloom.plans import report as plan
from cohortloom.plans import sections, streams
from cohortloom.sinks.report_table import read_report, replace_report
from cohortloom.testbed import analogue

Query = Callable[[SparkSession, str], DataFrame]


def inputs(
    spark: SparkSession, sf_dir: str, *names: str, sites: tuple[int, ...] | None = None, stored: bool = False
) -> streams.Inputs:
    """The analogue as builder inputs, restricted to some sections or sites if named; ``stored`` for
    queries of several facts."""
    configure(spark)
    spec = analogue.SPEC.only(*names) if names else analogue.SPEC
    tables = analogue.Analogue(spark, sf_dir, stored).tables(sites=sites)
    return streams.Inputs(tables, analogue.run(sites=sites), spec)


def _stream(name: str, *only: str) -> Query:
    return lambda spark, sf_dir: streams.ranked(inputs(spark, sf_dir, *only, stored=True), name)


def _section(name: str) -> Query:
    return lambda spark, sf_dir: sections.section_table(plan.selected(inputs(spark, sf_dir, name, stored=True)), name)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.report(plan.limited(inputs(spark, sf_dir, stored=True)))


def replace_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    replace_report(report(spark, sf_dir), folder, unique=True)
    return read_report(spark, folder)


def nightly(spark: SparkSession, sf_dir: str, sites: tuple[int, ...] | None = None) -> DataFrame:
    """The report as the job builds it: with measured join sides."""
    return plan.report(plan.sized(inputs(spark, sf_dir, sites=sites, stored=True), of_persons=True))


def replace_site_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site 2 is stored with old labels and built again; the rows of other sites that the
    second build brings along are not to be stored. Both store the rows of one report."""
    folder = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    rows, own = staged(report(spark, sf_dir), "report-rows"), F.col("site") == 2
    changed = F.concat(F.lit("OLD "), "label")
    # A site's labels all change or none does, so rows stay unique.
    first = rows.withColumn("label", F.when(own, changed).otherwise(F.col("label")))
    again = rows.withColumn("label", F.when(own, F.col("label")).otherwise(changed))
    replace_report(first, folder, unique=True)
    replace_report(again, folder, (2,), unique=True)
    return read_report(spark, folder)


def corrected(
    spark: SparkSession, sf_dir: str, names: tuple[str, ...], sections: tuple[str, ...] = (), **switches
) -> streams.Inputs:
    """The analogue with the richer sources ``names`` and some corrections turned on."""
    configure(spark)
    spec = (analogue.SPEC.only(*sections) if sections else analogue.SPEC).switched(**switches)
    return streams.Inputs(analogue.Analogue(spark, sf_dir, stored=True).corrected(*names), analogue.run(), spec)


def corrected_report(spark: SparkSession, sf_dir: str, names: tuple[str, ...], **switches) -> DataFrame:
    return plan.report(plan.sized(corrected(spark, sf_dir, names, **switches), of_persons=True))


_STATES = ("MASTECTOMY", "HYSTERECTOMY")
_HISTORY = ("health_factor", "health_factor_history")


def queries() -> dict[str, Query]:
    return {
        "stream_described_as_of": lambda s, d: streams.ranked(
            corrected(s, d, ("icd10_description",), ("cervical",), newest_description=True), "procedures"
        ),
        "stream_states": lambda s, d: streams.ranked(corrected(s, d, _HISTORY, states=_STATES), "states"),
        "report_newest_enrollment": lambda s, d: corrected_report(s, d, ("enrollment",), enrollment="newest"),
        "report_states_in_region": lambda s, d: corrected_report(
            s, d, (*_HISTORY, "address"), states=_STATES, region_years=2
        ),
        "report_nightly": nightly,
        "report_one_site": lambda s, d: nightly(s, d, (2,)),
        "sink_replace_site": replace_site_and_read,
        "stream_radiology": _stream("procedures", "breast"),
        "stream_procedure": _stream("procedures", "cervical"),
        "stream_observation": _stream("observations"),
        "stream_lab": _stream("labs"),
        "stream_cytology": _stream("cytology"),
        "stream_surgical": _stream("surgical"),
        "section_breast": _section("breast"),
        "section_cervical": _section("cervical"),
        "section_union": lambda s, d: sections.all_events(plan.selected(inputs(s, d, stored=True))),
        "report_eligible_events": report,
        "report_ordered": lambda s, d: plan.ordered(report(s, d)),
        "report_latest_only": lambda s, d: plan.report(plan.limited(inputs(s, d, stored=True)), latest_only=True),
        "report_with_ranks": lambda s, d: plan.report(
            inputs(s, d, stored=True), show_rank=True, person_rank=True
        ),
        "sink_replace_read": replace_and_read,
    }
