"""Text quality by regularised quadratic discriminant analysis.

Each text becomes a vector of transformed statistics (lengths, shares of character
kinds, repetition). Spark sums the vectors and their products per class over all labelled
rows; a class covariance is shrunk towards the pooled one and its diagonal, and its
Cholesky factor is kept in the model. A score is the difference of the two
Mahalanobis log densities, put through a logistic curve.

Defined results: null text counts as empty; empty texts have a vector and so a score.
Labels other than 0 and 1 and null labels teach nothing; conflicting labels
count each. If a class has no row, every score is 1 or 0 for the other class, and
without any labelled row 0.5. Equal rows get equal scores; no label, language,
source or id enters a vector. Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import byte_view, giving_back, numbered, split_words, steps

_KINDS = ("lower", "upper", "digit", "space", "line", "stop", "comma", "cry", "symbol", "other")


def _kind_table() -> np.ndarray:
    table = np.full(256, _KINDS.index("symbol"), np.uint8)
    for name, members in (
        ("lower", range(ord("a"), ord("z") + 1)),
        ("upper", range(ord("A"), ord("Z") + 1)),
        ("digit", range(ord("0"), ord("9") + 1)),
        ("space", b" \t\r\x0b\x0c"),
        ("line", b"\n"),
        ("stop", b"."),
        ("comma", b",;:'\"()-"),
        ("cry", b"!?"),
        ("other", range(128, 256)),
    ):
        table[list(members)] = _KINDS.index(name)
    return table


_KIND = _kind_table()


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of transformed statistics per text."""
    n = len(texts)
    texts = pc.fill_null(texts, "")
    data, ends = byte_view(texts)
    sizes = np.diff(ends)
    per_kind = np.bincount(
        np.repeat(np.arange(n, dtype=np.int32) * len(_KINDS), sizes) + _KIND[data], minlength=n * len(_KINDS)
    ).reshape(n, len(_KINDS))
    kind = {name: per_kind[:, i].astype(float) for i, name in enumerate(_KINDS)}

    words, bounds = split_words(texts, lower=True)
    distinct, index = numbered(words)
    count = np.diff(bounds).astype(float)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(float)
    again = np.zeros(len(index))
    again[1:] = (index[1:] == index[:-1]) & (owner[1:] == owner[:-1])
    pairs, uses = np.unique(owner * max(1, len(distinct)) + index, return_counts=True)
    pair_owner = pairs // max(1, len(distinct))
    most = np.zeros(n)
    np.maximum.at(most, pair_owner, uses)
    letters_of_words, word_ends = byte_view(words)
    last = _KIND[letters_of_words[word_ends[1:] - 1]]

    def of_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, n)

    def share(part: np.ndarray, whole: np.ndarray, weight: float) -> np.ndarray:
        """A share that a short text cannot drive to an extreme, on a scale of even spread."""
        return np.arcsin(np.sqrt(np.clip(part / (whole + weight), 0, 1)))

    letters = kind["lower"] + kind["upper"] + kind["other"]
    columns = [
        np.log1p(sizes),
        np.log1p(count),
        np.log((of_words(lengths) + 20) / (count + 4)),
        np.log((of_words(lengths**2) + 150) / (count + 4)),
        share(kind["upper"], letters, 20),
        share(kind["digit"], sizes, 20),
        share(kind["stop"], sizes, 20),
        share(kind["comma"], sizes, 20),
        share(kind["cry"], sizes, 20),
        share(kind["symbol"], sizes, 20),
        share(kind["line"], sizes, 20),
        share(of_words(again), count, 10),
        share(most, count, 10),
        np.log((np.bincount(pair_owner, minlength=n) + 10) / (count + 10)),
        share(of_words((last == _KINDS.index("symbol")) | (last == _KINDS.index("cry"))), count, 10),
        share(of_words(lengths <= 1), count, 10),
        share(of_words(lengths >= 25), count, 10),
    ]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Model:
    """Per class: mean, inverse Cholesky factor of the covariance, log determinant and log prior."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    rows: tuple[int, int]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the vector of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text"):
                x = statistics(batch.column("text"))
                bounds = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(x.ravel()))], ["doc_id", "x"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(work), "doc_id long, x array<double>")


def train(vectors: DataFrame, labels: DataFrame, *, label: str = "quality", shrink: float = 0.1, flatten: float = 0.05) -> Model:
    """Fit to all rows of ``vectors`` (doc_id, x) that ``labels`` (doc_id, label) names.

    ``shrink`` moves a class covariance towards the pooled one, ``flatten`` towards a diagonal.
    """
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).distinct()
    rows = vectors.join(marks, "doc_id").select("y", "x")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            y = batch.column("y").to_numpy()
            x = _vectors(batch.column("x"))
            x = np.hstack([np.ones((len(x), 1)), x])
            for c in np.unique(y):
                total[c] = total.get(c, 0) + x[y == c].T @ x[y == c]
        for c, t in total.items():
            at = np.arange(t.size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(t.size, c, np.int32)), pa.array(at), pa.array(t.ravel())], ["y", "at", "value"]
            )

    summed = rows.mapInArrow(giving_back(sums), "y int, at int, value double").groupBy("y", "at").agg(F.sum("value").alias("value"))
    found = summed.collect()  # two matrices, whatever the rows
    width = int(round((max([r["at"] for r in found]) + 1) ** 0.5)) if found else 1
    moments = np.zeros((2, width * width))
    for r in found:
        moments[r["y"], r["at"]] = r["value"]
    return _fit(moments.reshape(2, width, width), shrink, flatten)


def _fit(moments: np.ndarray, shrink: float, flatten: float) -> Model:
    n = moments[:, 0, 0]
    dim = moments.shape[1] - 1
    counts = (int(n[0]), int(n[1]))
    if min(counts) == 0:
        return Model(np.zeros((2, dim)), np.zeros((2, dim, dim)), np.zeros(2), counts)
    means = moments[:, 0, 1:] / n[:, None]
    scatter = moments[:, 1:, 1:] - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / max(1.0, n.sum() - 2)
    pooled += np.eye(dim) * max(1e-6, 1e-3 * np.trace(pooled) / dim)
    factors, offsets = [], []
    for c in (0, 1):
        # With few rows a class has little say against the pooled covariance.
        weight = shrink + (1 - shrink) * dim / (dim + n[c])
        own = (1 - weight) * scatter[c] / max(1.0, n[c] - 1) + weight * pooled
        own = (1 - flatten) * own + flatten * np.diag(np.diag(own))
        root = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(root))
        offsets.append(np.log(n[c] / n.sum()) - np.log(np.diag(root)).sum())
    return Model(means, np.array(factors), np.array(offsets), counts)


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    """Between 0 and 1, over 0.5 where class 1 has the larger density times its share."""
    if min(model.rows) == 0:
        only = 0.5 if max(model.rows) == 0 else float(model.rows[1] > 0)
        return np.full(len(x), only)
    logs = [
        model.offsets[c] - 0.5 * (((x - model.means[c]) @ model.factors[c].T) ** 2).sum(1) for c in (0, 1)
    ]
    # Divided by the dimension: the statistics are not independent, and far rows stay apart.
    return 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / x.shape[1], -500, 500)))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def score_vectors(vectors: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of rows from ``with_statistics``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scores(_vectors(batch.column("x")), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return vectors.select("doc_id", "x").mapInArrow(giving_back(work), "doc_id long, score double")


def score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with a score column, in one pass over the texts."""
    kept = [f for f in docs.schema.fields if f.name.lower() != name.lower()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text"):
                found = pa.array(scores(statistics(batch.column("text")), model))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    schema = T.StructType([*kept, T.StructField(name, T.DoubleType())])
    return docs.select([f"`{f.name}`" for f in kept]).mapInArrow(giving_back(work), schema)
