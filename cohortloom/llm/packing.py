"""Packing documents into training sequences: first-fit decreasing over a tournament tree.

A document is its token ids and one closing id. Whole sequences' worth of ids are
cut off its front; what remains is an item to pack. Items go to randomised
groups (by a hash of the row and its place in the input task, so that equal
rows spread), and in each group the longest item first takes the first bin with
room, which a tournament tree over the bins' free space finds in log time. The
group size is a parameter, so no group grows with the corpus.

Only lengths and checksums are shuffled; ``sequences`` carries the ids as well.

Defined results: ids are those of the tokenizer as its file gives it, so a special token's
literal in a text becomes its id. A null text is empty, so its document is the closing id
alone; a null doc_id stays null; equal rows are packed each for itself; no row
gives no sequence. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import STEP_BYTES, giving_back, mixed, new_folder, steps
from cohortloom.llm.tokens import PartEncoder

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, spread long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, with_ids: bool = False, step_bytes: int = STEP_BYTES
) -> DataFrame:
    """A row per piece of at most ``capacity`` ids; only a document's last piece is shorter. Less
    text at once (``step_bytes``) takes less memory and more time, and gives the same rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = PartEncoder(tokenizer, special_as_text=False), 0
        task = np.uint64(TaskContext.get().partitionId()) << np.uint64(40)
        for whole in batches:
            for batch in steps(whole, "text", step_bytes):
                ids, ends = encoder.encode(batch.column("text"))
                n = np.diff(ends) + 1
                counts = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), counts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * capacity
                length = np.minimum(capacity, n[row] - start)
                # The closing ids in place: id i of document r stands at ends[r] + r + i.
                closed = np.full(int(n.sum()), end_id, np.uint32)
                closed[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                at = (ends[:-1] + np.arange(len(n)))[row] + start
                raw = memoryview(closed.tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(at.tolist(), length.tolist())]
                place = task + np.arange(rows, rows + len(row), dtype=np.uint64)
                rows += len(row)
                columns = [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(n[row], pa.int64()),
                    pa.array(mixed(place).astype(np.int64)),
                ]
                if with_ids:
                    bounds = np.concatenate([[0], np.cumsum(length)])
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(closed.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(cut), schema)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. The tree's leaves are the bins' free space, a
    node is the larger of its children; going left where there is room finds the
    first bin that fits."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    free = [capacity] * (2 * leaves)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - free[node]
        free[node] -= size
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins, offsets


def pack(pieces: DataFrame, *, capacity: int = 2048, group_docs: int = 8192) -> DataFrame:
    """Sequence and offset of each piece. ``pieces`` is read twice: pass a written table."""
    total = pieces.count()
    groups = max(1, math.ceil(total / group_docs))
    extra = [f for f in pieces.schema.fields if f.name not in ("spread", *_names(_PACKED))]
    schema = ", ".join([_PACKED, *(f"{f.name} {f.dataType.simpleString()}" for f in extra)])
    keep = [c for c in _names(schema) if c not in ("sequence_id", "offset")]

    def fill(key, group):
        # A fixed order, so that a task run again gives the same sequences.
        group = group.sort_by([("length", "descending"), ("spread", "ascending")])
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        ids = (np.int64(key[0].as_py()) << np.int64(32)) + bins
        columns = {c: group.column(c) for c in keep}
        columns |= {"sequence_id": pa.array(ids), "offset": pa.array(offsets)}
        return pa.table({c: columns[c] for c in _names(schema)})

    grouped = pieces.withColumn("bin_group", F.pmod("spread", F.lit(groups)))
    return grouped.groupBy("bin_group").applyInArrow(fill, schema)


def packed(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, group_docs: int = 8192, step_bytes: int = STEP_BYTES
) -> DataFrame:
    """Where each piece of each document lies."""
    spark = docs.sparkSession
    folder = new_folder(spark, "pieces")
    cut_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, step_bytes=step_bytes).write.parquet(folder)
    return pack(spark.read.parquet(folder), capacity=capacity, group_docs=group_docs)


def padded_length(used: int, capacity: int) -> int:
    """A sequence is padded to ``capacity`` unless its length is a power of two."""
    return used if used & (used - 1) == 0 else capacity


def sequences(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, group_docs: int = 8192, pad_id: int = 0
) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (padded), doc_ids and where each piece starts."""
    spark = docs.sparkSession
    folder = new_folder(spark, "pieces")
    cut_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=True).write.parquet(folder)
    placed = pack(spark.read.parquet(folder), capacity=capacity, group_docs=group_docs)
    # A sequence holds at most ``capacity`` ids, so its pieces are bounded too.
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    fill = F.when(power, F.lit(0)).otherwise(F.lit(capacity) - F.col("used")).cast("int")
    return whole.select(
        "sequence_id",
        F.concat(F.flatten("parts.ids"), F.array_repeat(F.lit(pad_id), fill)).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("offsets"),
    )


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]
