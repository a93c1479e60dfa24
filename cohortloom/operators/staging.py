"""Cutting lineage: write an intermediate to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUN_FOLDER = "cohortloom.run.folder"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only in local mode, where driver and executors
    are one machine; on a cluster the setting is required.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortloom-"))
    return context.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later passes and lost executors
    start from the files and not from the sources.

    The shuffles of the write are of no use once the table stands; their files go at once
    and not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    folder = spark.conf.get(_RUN_FOLDER, None) or shared_folder(spark)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Everything staged meanwhile lies below one folder of its own, which is removed at the
    end, also after a failure. Results must be stored elsewhere by then."""
    path = f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    spark.conf.set(_RUN_FOLDER, path)
    try:
        yield path
    finally:
        spark.conf.unset(_RUN_FOLDER)
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
