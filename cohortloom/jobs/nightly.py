"""Command line job: build or rebuild the report of some sites.

    spark-submit --conf spark.checkpoint.dir=<shared folder> \\
        cohortloom/jobs/nightly.py --tables <folder> --out <folder> \\
        --as-of 2024-02-29T10:00:00 --sites 612,640
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cohortloom.operators.staging import run_folder
from cohortloom.plans import report as plan
from cohortloom.plans.streams import Inputs
from cohortloom.sinks.report_table import replace_report
from cohortloom.sources.loader import Tables
from cohortloom.spec import DEFAULT, ReportSpec, Run

# Skewed joins are split even where that costs a further shuffle: the specimen
# joins share one partitioning, which AQE would otherwise not break up.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(tables: Tables, run: Run, out: str, spec: ReportSpec = DEFAULT, **options: bool) -> None:
    """Store the report; ``options`` are those of ``plans.report.report``."""
    with run_folder(SparkSession.active()):  # staged names and ids do not outlive the job
        inputs = plan.sized(Inputs(tables, run, spec), of_persons=True)
        replace_report(plan.report(inputs, **options), out, run.sites, unique=True)


def main(argv: Sequence[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Build the cohort event report.")
    args.add_argument("--tables", required=True, help="folder with one table per name")
    args.add_argument(
        "--place",
        action="append",
        default=[],
        metavar="NAME=PLACE",
        help="a table that is elsewhere: its folder, or its name in the catalog",
    )
    args.add_argument("--out", required=True, help="folder or catalog table of the report")
    args.add_argument("--as-of", required=True, help="the moment the report speaks of, ISO 8601")
    args.add_argument("--sites", help="comma-separated station ids; default: all")
    args.add_argument("--caseless", action="store_true", help="compare text ignoring case")
    args.add_argument("--latest-only", action="store_true", help="each person's newest event of a kind")
    args.add_argument("--show-rank", action="store_true", help="with the event's rank")
    args.add_argument("--person-rank", action="store_true", help="with the rank in the person's report")
    args.add_argument("--time-zone", default="UTC", help="of stored times that have a zone; default: UTC")
    args.add_argument(
        "--rejects",
        help="leave out rows with values of a wrong type, and write them to this folder, which is overwritten; default: fail",
    )
    given = args.parse_args(argv)

    sites = tuple(int(s) for s in given.sites.split(",")) if given.sites else None
    spark = configure(SparkSession.builder.appName("cohort-event-report").getOrCreate())
    spark.conf.set("spark.sql.session.timeZone", given.time_zone)
    places = Tables.places_under(given.tables) | dict(p.split("=", 1) for p in given.place)
    tables = Tables(spark, places, sites=sites, caseless=given.caseless, tolerant=given.rejects is not None)
    if given.rejects is not None:
        tables.all_rejects().write.mode("overwrite").parquet(given.rejects)
    options = {k: getattr(given, k) for k in ("latest_only", "show_rank", "person_rank")}
    build(tables, Run.at(dt.datetime.fromisoformat(given.as_of), sites), given.out, **options)


if __name__ == "__main__":
    main()
