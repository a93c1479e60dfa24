"""Token counts from flat token files: where documents end, found without an index.

A token file is nothing but 16-bit ids, each document's followed by one
end-of-document id. Files are read in blocks of a fixed size. A block is
searched for the id in one vectorised comparison. A document that begins in an
earlier block is stitched by a prefix scan over the blocks' summaries (number
of ends, place of the last end), done in two levels so that a file of any
length is summed by many tasks.

Defined results: an empty document is an end without ids; ids after the last
end are a document with ``closed`` false; a half id at the end of a file does not
count; an empty file or folder has no documents; a null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import STEP_BYTES, new_folder, open_file, steps
from cohortloom.llm.tokens import PartEncoder
from cohortloom.operators.staging import staged

_BLOCKS_TOGETHER = 1024  # blocks whose summaries one window row group adds up
_SCANNED = "path string, block long, ends array<long>, n_ends long, last_end long, open boolean"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Ids of ``docs.text`` as flat files, one per input partition, in row order.

    The text writer puts its line separator after each row; with the
    separator set to the end id's two bytes, its files are flat token files.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(tokenizer)
        for whole in batches:
            for batch in steps(whole, "text", 2 * STEP_BYTES):
                ids, ends = encoder.encode(batch.column("text"))
                data = pa.py_buffer(ids.astype("<u2").tobytes())
                offsets = pa.py_buffer((2 * ends).astype(np.int32).tobytes())
                rows = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, data])
                yield pa.RecordBatch.from_arrays([rows], ["ids"])

    (
        docs.select("text")
        .mapInArrow(encode, "ids binary")
        .select(F.col("ids").cast("string"))
        .write.option("encoding", "UTF-16LE")
        .option("lineSep", chr(end_id))
        .text(path)
    )


def scan_blocks(spark: SparkSession, path: str, end_id: int, block_ids: int = 1 << 20) -> DataFrame:
    """A row per block: the ids' places at which documents end."""
    step = F.lit(2 * block_ids).cast("long")
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length >= 2")
    blocks = files.select(
        "path",
        (F.col("length") / 2).cast("long").alias("n_ids"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 2, step)).alias("at"),
    ).repartition("path", "at")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as f:
                    first = row["at"] // 2
                    ids = np.frombuffer(f.read_at(2 * min(block_ids, row["n_ids"] - first), row["at"]), "<u2")
                ends = first + np.flatnonzero(ids == end_id)
                last = first + len(ids) == row["n_ids"]
                open_end = bool(last and ids[-1] != end_id)
                if open_end:  # the last document has no end: it ends with the file
                    ends = np.append(ends, row["n_ids"])
                yield pa.RecordBatch.from_pylist(
                    [{
                        "path": row["path"], "block": first // block_ids, "ends": ends, "n_ends": len(ends),
                        "last_end": int(ends[-1]) if len(ends) else None, "open": open_end,
                    }],
                    schema,
                )

    schema = pa.schema(
        [("path", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int64())), ("n_ends", pa.int64()), ("last_end", pa.int64()), ("open", pa.bool_())]
    )
    return blocks.mapInArrow(search, _SCANNED)


def stitched(scanned: DataFrame) -> DataFrame:
    """A row per document of each file: ``ordinal``, ``start`` (ids before it, ends
    included), ``n_tokens`` (without the end) and ``closed``.

    ``scanned`` is read three times: pass a written table.
    """
    light = scanned.select("path", "block", "n_ends", "last_end").withColumn(
        "super", F.floor(F.col("block") / _BLOCKS_TOGETHER)
    )
    supers = light.groupBy("path", "super").agg(
        F.sum("n_ends").alias("n"), F.max("last_end").alias("last")
    )
    before = Window.partitionBy("path").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select(
        "path", "super", F.sum("n").over(before).alias("n_outer"), F.max("last").over(before).alias("last_outer")
    )
    inner = (
        Window.partitionBy("path", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        light.withColumn("n_inner", F.sum("n_ends").over(inner))
        .withColumn("last_inner", F.max("last_end").over(inner))
        .join(supers, ["path", "super"])
        .select(
            "path",
            "block",
            (F.coalesce("n_outer", F.lit(0)) + F.coalesce("n_inner", F.lit(0))).alias("ordinals"),
            F.coalesce("last_inner", "last_outer", F.lit(-1)).alias("carry"),
        )
    )
    ends = scanned.where("n_ends > 0").join(carried, ["path", "block"])
    previous = F.when(F.col("i") == 0, F.col("carry")).otherwise(F.element_at("ends", F.greatest("i", F.lit(1))))
    return ends.select(
        "*", F.posexplode("ends").alias("i", "end")
    ).select(
        "path",
        (F.col("ordinals") + F.col("i")).alias("ordinal"),
        (previous + 1).alias("start"),
        (F.col("end") - previous - 1).alias("n_tokens"),
        (~F.col("open") | (F.col("i") + 1 < F.col("n_ends"))).alias("closed"),
    )


def count_tokens(spark: SparkSession, path: str, end_id: int, block_ids: int = 1 << 20) -> DataFrame:
    """Documents of all token files below ``path`` with their token counts."""
    return stitched(staged(scan_blocks(spark, path, end_id, block_ids), "token-blocks"))


def ordinals(docs: DataFrame) -> DataFrame:
    """doc_id of each place in the files that ``write_token_files`` makes of ``docs``:
    the number of the input partition, which the file's name holds, and the row in it."""
    placed = F.monotonically_increasing_id()
    return docs.select("doc_id", placed.alias("at")).select(
        "doc_id",
        F.shiftright("at", 33).cast("int").alias("file_no"),
        F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal"),
    )


def document_counts(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = 1 << 20) -> DataFrame:
    """Write ``docs`` as token files, count from the files alone, and name the documents.

    The rows of a file are in the order of the partition it was written from, so a
    place in a file names a row. Each file must hold as many documents as its partition;
    if not (an input that does not read the same twice), an error is raised.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    counted = count_tokens(spark, folder, end_id, block_ids).withColumn(
        "file_no", F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    )
    whole = F.col("path").isNotNull() & F.col("closed") & F.col("named")
    named = ordinals(docs).withColumn("named", F.lit(True)).join(counted, ["file_no", "ordinal"], "full")
    return named.select(
        "doc_id",
        "file_no",
        F.col("ordinal").cast("long"),
        F.col("start").cast("long"),
        F.when(F.coalesce(whole, F.lit(False)), F.col("n_tokens"))
        .otherwise(F.raise_error(F.lit("files and rows do not match")).cast("long"))
        .alias("n_tokens"),
    )
