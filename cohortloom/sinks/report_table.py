"""The persisted report, under the names report clients expect: replaced per site, read back whole.

A place is a folder (it contains a slash) or the name of a catalog table. A folder holds versions
(sinks/versions.py): a rebuild of any sites shows all at once or not at all, also while it is read, and
the rows are known to be unique when they are read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.sinks.versions import VersionedFolder

_SITE = schemas.CLIENT_NAMES["site"]


def replace_report(
    rows: DataFrame, place: str, sites: tuple[int, ...] | None = None, unique: bool = False
) -> None:
    """Replace the stored rows of ``sites`` (all if None) by ``rows``. Other
    sites' rows are not touched, and a rerun gives the same stored report. ``unique`` says that no two
    rows are equal, as the report's are not; else a folder's are made so."""
    spark = rows.sparkSession
    rows = _storable(rows).withColumnsRenamed(schemas.CLIENT_NAMES)
    if "/" in place:
        wanted = rows if sites is None else rows.where(F.col(_SITE).isin(*sites))
        VersionedFolder(spark, place, _SITE).replace(_packed(wanted if unique else wanted.distinct()), sites, True)
    elif sites is None or not spark.catalog.tableExists(place):
        kept = rows if sites is None else rows.where(F.col(_SITE).isin(*sites))
        writer = _packed(kept).write.mode("overwrite").partitionBy(_SITE)
        writer.format("parquet").saveAsTable(place)
    else:
        described = spark.sql(f"DESCRIBE EXTENDED {place}").where("col_name = 'Location'")
        _replace_folders(rows, described.first()["data_type"], sites)
        spark.catalog.recoverPartitions(place)
        spark.catalog.refreshTable(place)


def read_report(spark: SparkSession, place: str) -> DataFrame:
    """All stored rows, unique, in the report's column order."""
    unique = False
    if "/" in place and (folder := VersionedFolder(spark, place, _SITE)).exists():
        stored, unique = folder.read()
    else:  # also a folder that was stored without versions
        stored = spark.read.parquet(place) if "/" in place else spark.table(place)
    ours = [c for c in schemas.CLIENT_NAMES.values() if c in stored.columns]
    found = stored.select(*ours).withColumn(_SITE, F.col(_SITE).cast("int"))
    return found if unique else found.distinct()


def _storable(rows: DataFrame) -> DataFrame:
    """Text without a collation."""
    text = [c for c, kind in rows.dtypes if kind.startswith("string")]
    return rows.withColumns({c: F.col(c).cast("string") for c in text})


def _packed(rows: DataFrame) -> DataFrame:
    """The rebalance hint lets AQE split a large site over several files and
    pack small ones; sorting within files lets a search by name skip row groups."""
    return rows.hint("rebalance", _SITE).sortWithinPartitions(
        _SITE, F.col("PatientName").asc_nulls_first(), F.col("EventDate").desc_nulls_last()
    )


def _replace_folders(rows: DataFrame, folder: str, sites: tuple[int, ...]) -> None:
    """The partitions of a catalog table, site by site."""
    seen = Observation()
    out = _packed(rows.where(F.col(_SITE).isin(*sites))).observe(
        seen, F.collect_set(_SITE).alias("sites")
    )
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_SITE)
        .parquet(folder)
    )
    # A dynamic overwrite leaves the old folder of a site that has no rows now.
    empty = rows.sparkSession.createDataFrame([], rows.drop(_SITE).schema)
    for site in sorted(set(sites) - set(seen.get["sites"] or [])):
        empty.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{_SITE}={site}")
