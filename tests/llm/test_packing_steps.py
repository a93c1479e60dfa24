"""How much text packing takes at once: results do not depend on it, time and memory do."""

from __future__ import annotations

import pytest

import corpus_pipeline
from cohortloom.llm import packing, queries

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def docs(spark):
    rows = [(i, None if i % 50 == 0 else f"text {i} " * (1 + i % 30)) for i in range(2500)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_op7_takes_larger_steps_than_the_default(spark, docs, tmp_path, monkeypatch):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    seen, packed = [], packing.packed
    monkeypatch.setattr(packing, "packed", lambda *a, **k: seen.append(k["step_bytes"]) or packed(*a, **k))
    rows = queries.op7_packing(spark, str(tmp_path))
    assert seen == [16 << 20]
    small = packed(docs, queries.tokenizer_path(), step_bytes=10_000)
    assert rows.count() == small.count() >= 2500
    assert rows.exceptAll(small).isEmpty()


def test_packing_in_the_pipeline_takes_small_batches(spark, docs):
    before = spark.conf.get(_BATCH_ROWS)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    try:
        corpus_pipeline.pack(spark, docs, "")
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= 1000
    finally:
        spark.conf.set(_BATCH_ROWS, before)
