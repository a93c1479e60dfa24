"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, Cauchy-Schwarz pruning.

Vectors become integers floor(scale * x). Rows are cut into blocks by descending
length. The directions that hold most of the table's energy (the right singular
vectors, from the Gram matrix that Spark sums up) become the first coordinates of a
rotation, so a partial sum over a few of them plus the product of the
residual lengths bounds an inner product tightly. A pair whose bound is below
the query's k-th best score so far is dropped; a block whose largest length
cannot reach it is not joined at all. What is left is scored by the integers.

First all query blocks meet the first block, which sets a threshold per query,
then the blocks that can still matter. Queries and rows meet in pairs of blocks of
bounded size; a pair sends on at most k rows per query.

Defined results: a vector that is null or holds null, NaN or infinity takes no
part, nor does one without id. Rows equal in id and integer vector are one row;
rows of one id are never compared with each other. A shorter vector counts as
filled with zeros. An empty vector scores 0. A score beyond 64 bits is the
nearest long. Ties go to the smaller id. Only id and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.staging import staged

_HITS = "query_row long, query_id long, vec_id long, score long"
_EXACT = 2**53  # up to here doubles hold integers exactly
_BLOCK_ROWS, _QUERY_ROWS = 8192, 2048
_STEP = 512  # rows of a block that are bounded at once


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id, v (array<long>) and norm2 (double) of the rows that take part."""
    doubles = F.col(vector_column).cast("array<double>")
    finite = F.forall(
        doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(doubles, lambda x: F.least(F.greatest(F.floor(x * scale).cast("double"), F.lit(-9.2e18)), F.lit(9.2e18)).cast("long"))
    used = vectors.where(F.col(id_column).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = used.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v")).distinct()
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow list column as int64, filled with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Orthonormal directions by descending energy: the right singular vectors of the table.

    Every task sums its rows' products; Spark adds the width x width sums.
    """
    if width == 0:
        return np.zeros((0, 0))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column(0).slice(start, 4096), width).astype(float)
                total += x.T @ x
        at = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "value"])

    sums = rows.select("v").mapInArrow(products, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    gram = np.zeros(width * width)
    for r in sums.collect():  # width x width numbers, whatever the rows
        gram[r["at"]] = r["value"]
    gram = np.nan_to_num(gram.reshape(width, width))
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _blocks(rows: DataFrame, total: int, size: int, name: str) -> DataFrame:
    """Rows with a block number, lengths descending from block to block."""
    parts = max(1, math.ceil(total / size))
    placed = rows.repartitionByRange(parts, F.col("norm2").desc(), F.col("vec_id"), F.col("v"))
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # A range may come out larger than asked for: it is cut again.
    block = F.spark_partition_id().cast("long") * F.lit(1 << 32) + F.floor(inside / size)
    return staged(placed.withColumn("block", block), name)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id and score. ``is_query`` is a condition on vec_id."""
    rows = staged(integers(vectors, id_column, vector_column, scale), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.count_if(is_query).alias("q")).first()
    if not size["q"]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(0, size["width"])
    turned = rotation(rows, width)
    stored = _blocks(rows, size["n"], _BLOCK_ROWS, "vector-blocks")
    asked = _blocks(rows.where(is_query), size["q"], _QUERY_ROWS, "query-blocks")
    asked = asked.select("block", F.col("vec_id").alias("query_id"), "v", "norm2").withColumn(
        "query_row", F.xxhash64("query_id", "v")
    )
    longest = stored.groupBy("block").agg(F.sqrt(F.max("norm2")).alias("longest"))
    seed = longest.agg(F.min("block")).first()[0]

    none = F.lit(float("-inf"))
    to_seed = asked.select(F.col("block").alias("query_block")).distinct().withColumn("block", F.lit(seed))
    first = staged(_scored(asked.withColumn("least", none), stored, to_seed, turned, width, k), "first-hits")
    kth = first.groupBy("query_row", "query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least")
    )
    known = staged(
        asked.join(kth, ["query_row", "query_id"], "left").withColumn("least", F.coalesce("least", none)),
        "thresholds",
    )
    # The rows of a block are at most ``longest`` long: a query needs it only if
    # |q| * longest can reach its threshold. One row per block on either side.
    hopeless = F.lit(float("inf"))
    need = F.when(F.col("norm2") > 0, F.col("least") / F.sqrt("norm2")).otherwise(
        F.when(F.col("least") <= 0, none).otherwise(hopeless)
    )
    needs = known.groupBy("block").agg(F.min(need).alias("need")).withColumnRenamed("block", "query_block")
    others = longest.where(F.col("block") != F.lit(seed))
    pairs = needs.join(others, F.col("need") <= F.col("longest") * (1 + 1e-9) + 1e-6).select("query_block", "block")
    rest = _scored(known, stored, staged(pairs, "block-pairs"), turned, width, k)

    order = Window.partitionBy("query_row", "query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _scored(asked: DataFrame, stored: DataFrame, pairs: DataFrame, turned: np.ndarray, width: int, k: int) -> DataFrame:
    """The k best rows of each stored block for each query of a block paired with it."""
    queries = asked.withColumnRenamed("block", "query_block").join(pairs, "query_block")
    stored = stored.join(pairs, "block")

    def score(key, left, right):
        return best_of(left, right, turned, width, k)

    return (
        queries.groupBy("query_block", "block")
        .cogroup(stored.groupBy("query_block", "block"))
        .applyInArrow(score, _HITS)
    )


def best_of(asked: pa.Table, rows: pa.Table, turned: np.ndarray, width: int, k: int) -> pa.Table:
    """Up to k hits per query of ``asked`` among ``rows``, none below the query's ``least``."""
    qid, cid = asked.column("query_id").to_numpy(), rows.column("vec_id").to_numpy()
    least = asked.column("least").to_numpy().copy()
    q, c = _matrix(asked.column("v"), width), _matrix(rows.column("v"), width)
    order = np.argsort(-rows.column("norm2").to_numpy(), kind="stable")
    cid, c = cid[order], c[order]
    qf, cf = q.astype(float), c.astype(float)
    lead = max(1, width // 4)
    qr, cr = qf @ turned, cf @ turned
    q_rest, c_rest = (np.sqrt((x[:, lead:] ** 2).sum(1)) for x in (qr, cr))
    q_len, c_len = (np.sqrt((x**2).sum(1)) for x in (qf, cf))
    # Rounding of the rotated sums, far above what doubles lose and far below 1 for usual lengths.
    slack = 1e-9 * q_len * (c_len.max() if len(c_len) else 0.0) + 1e-6
    exact = len(q) and len(c) and q_len.max() * c_len.max() < _EXACT

    held = [np.zeros(0, np.int64) for _ in range(3)]  # query, id, score
    for at in range(0, len(c), _STEP):
        part = slice(at, at + _STEP)
        if not (q_len * c_len[at] + slack >= least).any():
            break  # lengths only get smaller
        bound = qr[:, :lead] @ cr[part, :lead].T + np.outer(q_rest, c_rest[part]) + slack[:, None]
        qi, ci = np.nonzero((bound >= least[:, None]) & (qid[:, None] != cid[part][None, :]))
        if not len(qi):
            continue
        if exact and len(qi) * 4 > bound.size:
            score = (qf @ cf[part].T)[qi, ci].astype(np.int64)
        elif exact:
            score = np.einsum("ij,ij->i", qf[qi], cf[part][ci]).astype(np.int64)
        else:
            score = _large(q[qi], c[part][ci])
        new = (qi, cid[part][ci], score)
        held = [np.concatenate([a, b]) for a, b in zip(held, new)]
        by = np.lexsort((held[1], ~held[2], held[0]))  # ~ turns the order without overflow
        held = [a[by] for a in held]
        starts = np.searchsorted(held[0], np.arange(len(q)))
        place = np.arange(len(by)) - starts[held[0]]
        best = place < k
        last = place == k - 1
        least[held[0][last]] = np.maximum(least[held[0][last]], held[2][last])
        held = [a[best] for a in held]
    query_row = asked.column("query_row").to_numpy()
    return pa.table(
        {"query_row": query_row[held[0]], "query_id": qid[held[0]], "vec_id": held[1], "score": held[2]}
    )


def _large(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows too long for doubles, by Python integers."""
    top, bottom = 2**63 - 1, -(2**63)
    sums = (sum(int(x) * int(y) for x, y in zip(r, s)) for r, s in zip(a, b))
    return np.array([min(max(x, bottom), top) for x in sums], np.int64)
