"""Folders whose content changes all at once: version folders, and a log of which of them count.

    <place>/data/version=<id>/<partition>=<value>/   files, written once and never changed
    <place>/log/<number>.json                        which version holds each partition's rows

A change writes its partitions into a version folder of its own and then adds the next file of the
log. That file alone makes the change: before it a reader sees the old partitions, after it the new
ones, all together. A writer that dies leaves at most files no log names. Each number can be
created once, so of two writers one finds its number taken, and adds its partitions to what the other left.
Log files are small: a line per partition.

This needs a file system whose create-if-absent is exclusive (HDFS, a POSIX file system; an object
store with conditional writes).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructType

_END = "end"  # last key of a complete log file; a writer may die while it writes one


class VersionedFolder:
    """One such folder, partitioned by the integer column ``partition``."""

    def __init__(self, spark: SparkSession, place: str, partition: str):
        self._spark, self._place, self._partition = spark, place.rstrip("/"), partition
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self._place, *parts)))

    def exists(self) -> bool:
        return self._fs.exists(self._path("log"))

    def numbers(self) -> list[int]:
        """The log's numbers, newest first."""
        if not self.exists():
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path("log"))]
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _entry(self, number: int) -> dict | None:
        """What a log file says; None if it is incomplete."""
        stream = self._fs.open(self._path("log", f"{number:020d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
        except ValueError:
            return None
        return found if found.get(_END) else None

    def current(self) -> dict:
        """The newest complete log entry: ``partitions`` (value to version), ``schema``, ``unique``."""
        for number in self.numbers():
            found = self._entry(number)
            if found:
                return found
        return {"partitions": {}, "schema": None, "unique": True}

    def replace(self, rows: DataFrame, values: Iterable[int] | None, unique: bool) -> str:
        """Replace the partitions ``values`` (all if None) by the rows of them in ``rows``; a value without
        rows has none from then on. ``unique`` says that no two rows are equal. The new version's id."""
        version = uuid.uuid4().hex
        target = f"{self._place}/data/version={version}"
        rows.write.partitionBy(self._partition).parquet(target)
        path = self._path("data", f"version={version}")
        names = [s.getPath().getName() for s in self._fs.listStatus(path)]
        # A row without a value has no partition to be replaced with: int() refuses its folder's name.
        found = [int(n.partition("=")[2]) for n in names if n.startswith(f"{self._partition}=")]
        schema = rows.drop(self._partition).schema.json()
        while True:
            before = self.current()
            kept = {} if values is None else {k: v for k, v in before["partitions"].items() if int(k) not in set(values)}
            entry = {
                "partitions": kept | {str(v): version for v in found},
                "schema": schema,
                "unique": unique and (before["unique"] or not kept),
                _END: True,
            }
            if self._add(max(self.numbers(), default=0) + 1, entry):
                return version

    def _add(self, number: int, entry: Mapping) -> bool:
        """Write a log file; False if another writer was first."""
        self._fs.mkdirs(self._path("log"))
        path = self._path("log", f"{number:020d}.json")
        try:
            stream = self._fs.create(path, False)
        except Exception:
            if self._fs.exists(path):
                return False
            raise
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        return True

    def read(self) -> tuple[DataFrame, bool]:
        """The rows that count now, and whether they are known to be unique. The files
        stay the same however often the partitions are replaced meanwhile."""
        entry = self.current()
        schema = StructType.fromJson(json.loads(entry["schema"]))
        whole = StructType([*schema.fields]).add(self._partition, IntegerType())
        base = f"{self._place}/data"
        paths = [f"{base}/version={v}/{self._partition}={k}" for k, v in sorted(entry["partitions"].items())]
        if not paths:
            return self._spark.createDataFrame([], whole), True
        return self._spark.read.schema(whole).option("basePath", base).parquet(*paths), entry["unique"]

    def drop_old(self, keep: int = 2) -> list[str]:
        """Remove the versions that none of the newest ``keep`` log entries names, and older log files. Not to be
        run beside a writer; readers of a version that is removed fail. The ids of removed versions."""
        numbers = [n for n in self.numbers() if self._entry(n)]
        wanted = {v for n in numbers[:keep] for v in self._entry(n)["partitions"].values()}
        for number in numbers[keep:]:
            self._fs.delete(self._path("log", f"{number:020d}.json"), False)
        if not self._fs.exists(self._path("data")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path("data"))]
        gone = [n.partition("=")[2] for n in names if n.startswith("version=") and n.partition("=")[2] not in wanted]
        for version in gone:
            self._fs.delete(self._path("data", f"version={version}"), True)
        return gone
