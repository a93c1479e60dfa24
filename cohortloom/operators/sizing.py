"""Broadcast decisions from measured sizes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

# The driver collects, hashes and serializes a broadcast side: about three times these bytes.
MAX_ROWS = 2_000_000
MAX_BYTES = 32 * 1024 * 1024
MAX_TOTAL_BYTES = 64 * 1024 * 1024
MAX_FILTER_BITS = 1 << 22  # 0.5 MB: the driver holds some ten copies a stage

_FILTER = "spark.sql.optimizer.runtime.bloomFilter"


def measured(frames: Mapping[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """Rows and approximate bytes of each frame, in one Spark job.

    Only for lookup tables: every frame is read in full, text and binaries by length, and
    arrays, maps and structs by their length as JSON.
    """
    parts = []
    for name, df in frames.items():
        content = [
            F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in map(_content, df.schema.fields) if c is not None
        ]
        width = reduce(lambda a, b: a + b, content, F.lit(16 * len(df.columns)).cast("long"))
        parts.append(
            df.agg(
                F.lit(name).alias("name"),
                F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(width), F.lit(0).cast("long")).alias("bytes"),
            )
        )
    if not parts:
        return {}
    rows = reduce(DataFrame.unionByName, parts).collect()  # one row per frame
    return {r["name"]: (r["n"], r["bytes"]) for r in rows}


def _content(column: StructField) -> Column | None:
    """What has no fixed width, as text or bytes."""
    if isinstance(column.dataType, (StringType, BinaryType)):
        return F.col(f"`{column.name}`")
    if isinstance(column.dataType, (ArrayType, MapType, StructType)):
        return F.to_json(F.struct(F.col(f"`{column.name}`").alias("c")))
    return None


def broadcastable(
    frames: Mapping[str, DataFrame],
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    max_total: int = MAX_TOTAL_BYTES,
    *,
    sizes: Mapping[str, tuple[int, int]] | None = None,
) -> frozenset[str]:
    """Names of the frames whose size (measured here, unless ``sizes`` are given) is within both
    bounds, the smallest first as long as all of them together, which the driver and each executor
    hold, stay within ``max_total``. The others get no hint and join by shuffle, with AQE splitting skew."""
    return within(measured(frames) if sizes is None else sizes, max_rows, max_bytes, max_total)


def within(
    sizes: Mapping[str, tuple[int, int]],
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    max_total: int = MAX_TOTAL_BYTES,
) -> frozenset[str]:
    """As ``broadcastable``, of sizes that are already measured."""
    chosen, total = set(), 0
    for name, (rows, size) in sorted(sizes.items(), key=lambda m: (m[1][1], m[0])):
        if rows <= max_rows and size <= max_bytes and total + size <= max_total:
            chosen.add(name)
            total += size
    return frozenset(chosen)


def filter_settings(rows: int, size: int) -> dict[str, str]:
    """Session settings with which Catalyst filters a large fact by a Bloom filter of up to ``rows``
    keys (``size`` bytes) before it shuffles the fact for a join with them.

    A filter has ten bits a key, 1 % of other rows pass, up to a bound: it is a value in the plan, which the driver
    and each task of its stages hold. Beyond the bound there is none; ``filters`` has those.
    """
    bits = min(max(10 * rows, 1 << 20), MAX_FILTER_BITS)
    return {
        f"{_FILTER}.enabled": str(filterable(rows)).lower(),
        f"{_FILTER}.applicationSideScanSizeThreshold": "64m",
        f"{_FILTER}.creationSideThreshold": f"{max(2 * size, 10 << 20)}b",
        f"{_FILTER}.expectedNumItems": str(bits // 10),
        f"{_FILTER}.maxNumItems": str(bits // 10),
        f"{_FILTER}.numBits": str(bits),
        f"{_FILTER}.maxNumBits": str(bits),
    }


def filterable(rows: int) -> bool:
    """Whether Catalyst's filters may hold that many keys."""
    return 10 * rows <= MAX_FILTER_BITS
