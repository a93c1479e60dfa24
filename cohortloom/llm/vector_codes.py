"""Compressing vectors to short codes: product quantisation by active-entry Lloyd rounds.

A vector is scaled to integers and cut into equal consecutive parts. Each part position
has a codebook of its own, which begins as that part of the vectors with the smallest
ids. A round assigns every part to the nearest entry and then moves each entry to the
floor of its parts' mean; an entry without parts stays.

Every row carries its entries and their exact distances from round to round. Where the
entry a part lies with did not move, the stored distance still holds, so only the
entries that did move are compared with it; the other parts look at all entries. Equal
distances go to the lower index both ways. When no entry moved, later rounds change nothing.

A round is one pass: a task writes its rows with their new entries and, beside them, its
sums per entry, which Spark adds up. The driver holds codebooks only: parts x entries x width.

Defined results: a null vector, or one with a null or non-finite component, is left out, and so is
one whose length is not the usual one (the length most vectors have, the shorter if tied, of those
that are multiples of ``parts``). Scaled components are held within +-2**27, so that distances are
exact in 64 bits. A repeated id begins one entry, from the least of its vectors; null ids begin none. With
fewer ids than entries the codebooks are that much smaller; with none, codes and errors are null. Equal rows are coded each
for itself; no row gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import new_folder, remove_folder
from cohortloom.operators import sizing
from cohortloom.operators.staging import staged

_MOST = 1 << 27
_ROWS = 4096  # rows of one step inside a task


def finite(column: str) -> Column:
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad


def scaled(vectors: DataFrame, parts: int, scale: int, column: str) -> DataFrame:
    """vec_id, label and the integer vector ``v`` of each row that takes part."""
    kept = vectors.select(F.col("vec_id").cast("long"), "label", F.col(column).alias("v")).where(finite("v"))
    sizes = kept.groupBy(F.size("v").alias("n")).count().where(f"n > 0 AND n % {parts} = 0")
    usual = sizes.orderBy(F.desc("count"), "n").first()
    if usual is None:
        return kept.limit(0).withColumn("v", F.lit(None).cast("array<int>"))
    whole = lambda x: F.greatest(F.lit(float(-_MOST)), F.least(F.lit(float(_MOST)), F.floor(x.cast("double") * scale).cast("double")))
    return kept.where(F.size("v") == usual["n"]).withColumn("v", F.transform("v", lambda x: whole(x).cast("int")))


def first_entries(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The codebooks before the first round: (parts, entries, width)."""
    named = rows.where("vec_id IS NOT NULL")
    ids = [r[0] for r in named.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    least = named.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v"))
    found = [r["v"] for r in least.orderBy("vec_id").collect()] if ids else []
    book = np.array(found, np.int64).reshape(len(found), parts, -1 if found else 0)
    return book.transpose(1, 0, 2).copy()


def nearest(
    part: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, distance: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row of ``part`` (n, width), lower index first.

    ``code`` and ``distance`` are those of the round before, None in the first.
    """

    def look(rows: np.ndarray, entries: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        for j in entries.tolist():
            d = ((rows - book[j]) ** 2).sum(axis=1)
            better = (d < best) | ((d == best) & (j < at))
            best[better], at[better] = d[better], j

    everything = np.arange(len(book))
    best, at = np.full(len(part), np.iinfo(np.int64).max), np.full(len(part), len(book))
    if code is None:
        look(part, everything, best, at)
        return at, best
    rescan = moved[code]
    b, a = best[rescan], at[rescan]
    look(part[rescan], everything, b, a)
    best[rescan], at[rescan] = b, a
    b, a = distance[~rescan].copy(), code[~rescan].copy()
    look(part[~rescan], np.flatnonzero(moved), b, a)
    best[~rescan], at[~rescan] = b, a
    return at, best


def assigned(rows: DataFrame, book: np.ndarray, moved: np.ndarray, state: bool) -> DataFrame:
    """One pass: rows with ``code`` and ``distance`` (kind 0), and the task's sums per part and
    entry, the count last (kind 1)."""
    parts, entries, width = book.shape
    label = rows.schema["label"].dataType.simpleString()
    schema = f"kind int, vec_id long, label {label}, v array<int>, code binary, distance array<long>, slot int, sums array<long>"

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        n, w = values.shape
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * w, pa.int32()), pa.array(values.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                n = batch.num_rows
                v = batch.column("v").flatten().to_numpy().astype(np.int64).reshape(n, parts, width)
                codes, distances = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
                if state:
                    old = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                    known = batch.column("distance").flatten().to_numpy().reshape(n, parts)
                for p in range(parts):
                    before = (old[:, p].astype(np.int64), known[:, p]) if state else (None, None)
                    at, distances[:, p] = nearest(v[:, p], book[p], moved[p], *before)
                    codes[:, p] = at
                    np.add.at(total[p, :, :width], at, v[:, p])
                    total[p, :, width] += np.bincount(at, minlength=entries)
                column = {
                    "kind": pa.array(np.zeros(n), pa.int32()),
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "v": batch.column("v"),
                    "code": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "distance": lists(distances, pa.int64()),
                    "slot": pa.nulls(n, pa.int32()),
                    "sums": pa.nulls(n, pa.list_(pa.int64())),
                }
                labels = column["label"].type
                yield pa.RecordBatch.from_arrays(list(column.values()), list(column))
        used = np.flatnonzero(total[:, :, width].ravel())
        if len(used):
            m = len(used)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(m), pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, labels),
                    pa.nulls(m, pa.list_(pa.int32())), pa.nulls(m, pa.binary()), pa.nulls(m, pa.list_(pa.int64())),
                    pa.array(used, pa.int32()), lists(total.reshape(-1, width + 1)[used], pa.int64()),
                ],
                list(column),
            )

    return rows.mapInArrow(run, schema)


def moved_entries(sums: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after a round, from the sums of all tasks."""
    width = book.shape[2]
    added = sums.select("slot", F.posexplode("sums").alias("i", "x")).groupBy("slot", "i").agg(F.sum("x").alias("x"))
    total = np.zeros((book.shape[0] * book.shape[1], width + 1), np.int64)
    for r in added.collect():  # parts x entries x (width + 1) numbers, whatever the input
        total[r["slot"], r["i"]] = r["x"]
    count = total[:, width]
    new = book.reshape(-1, width).copy()
    used = count > 0
    new[used] = total[used, :width] // count[used, None]
    return new.reshape(book.shape)


def coded(
    vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, column: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, ``v``, ``code`` (a byte per part) and ``distance`` (per part) of each row, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is one byte")
    spark = vectors.sparkSession
    folder = new_folder(spark, "vector-codes")
    place = f"{folder}/scaled"
    scaled(vectors, parts, scale, column).write.parquet(place)
    rows = spark.read.parquet(place)
    book = first_entries(rows, parts, entries)
    if book.shape[1] == 0:
        unknown = {"code": F.lit(None).cast("binary"), "distance": F.lit(None).cast("array<long>")}
        return rows.withColumns(unknown), book
    moved, state = np.ones(book.shape[:2], bool), False
    for step in range(rounds + 1):
        # The rows of the round before are read once more, and go when the new ones stand.
        target = f"{folder}/round-{step}"
        assigned(rows, book, moved, state).write.partitionBy("kind").parquet(target)
        remove_folder(spark, place)
        place, state = target, True
        written = spark.read.parquet(target)
        rows = written.where("kind = 0").select("vec_id", "label", "v", "code", "distance")
        if step < rounds:
            new = moved_entries(written.where("kind = 1"), book)
            moved = (new != book).any(axis=2)
            book = new
            if not moved.any():
                break
    return rows, book


def fingerprint(book: np.ndarray) -> str:
    """SHA-256 of all entries' components in order, as decimal text with commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def digest(rows: DataFrame, book: np.ndarray) -> DataFrame:
    """vec_id, code as hex text, error, the error summed over equal labels, and the codebooks' fingerprint."""
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, b: a + b)
    flat = rows.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), error.alias("error"))
    sums = staged(flat.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if sizing.broadcastable({"sums": sums}):
        sums = F.broadcast(sums)
    same = F.col("r.label").eqNullSafe(F.col("s.label"))
    return flat.alias("r").join(sums.alias("s"), same, "left").select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(book)).alias("codebooks_sha256")
    )
