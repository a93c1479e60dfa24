"""The corpus pipeline: five stages, each a written table that the next one reads.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents`` for the rows they keep. Rows are told apart by
doc_id and text, so a repeated id with another text is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontamination, language_id, near_dedup, packing, quality
from cohortloom.llm.common import new_folder, remainder, table, text_key
from cohortloom.llm.queries import tokenizer_path
from cohortloom.operators import sizing
from cohortloom.operators.staging import staged


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language; rejected are texts without letters, or with none in a script that
    a learned language uses (score 0)."""
    model = language_id.train(docs)
    return language_id.label(docs, model).where("lang_pred <> 'und' AND lang_score > 0").select(_names(docs))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are likelier of label 1 than 0."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    known = labels.select("doc_id").distinct()
    if sizing.broadcastable({"labels": known}):
        known = F.broadcast(known)
    labelled = docs.join(known, "doc_id", "left_semi")
    model = quality.train(quality.with_statistics(labelled), labels)
    return quality.score(docs, model, "quality_score_").where("quality_score_ >= 0.5").select(_names(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    found = staged(near_dedup.near_duplicates(docs).where("kept"), "kept-documents")
    # A component whose smallest id is repeated has several such rows: the smallest text key stays.
    full = found.where("n_shingles > 0")
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    chosen = full.groupBy("root").agg(first).select("first.doc_id", "first.text_key")
    chosen = chosen.unionByName(found.where("n_shingles = 0").select("doc_id", "text_key").distinct())
    kept = _matching(docs, chosen, "left_semi")
    repeated = full.groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    once = _matching(kept, repeated, "left_anti")
    return once.unionByName(_matching(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"), verbatim=True)
    return _matching(docs, found.select("doc_id", "text_key").distinct(), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences. Small steps and batches:
    executors still hold what the stages before have taken."""
    spark.conf.set(_BATCH_ROWS, "1000")  # a batch stands in the JVM and in the worker at once
    return packing.packed(docs, tokenizer_path(), step_bytes=2 << 20)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

STAGES = [
    ("language", keep_known_language),
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark_texts),
    ("packing", pack),
]

#: Trained models, minhash links and token ids are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder, batch_rows = new_folder(spark, "pipeline"), spark.conf.get(_BATCH_ROWS)
    try:
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    finally:
        spark.conf.set(_BATCH_ROWS, batch_rows)
    return docs


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` whose (doc_id, text) is, or with ``left_anti`` is not, among ``keys``."""
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & text_key("l.text").eqNullSafe(F.col("r.text_key"))
    return docs.alias("l").join(keys.alias("r"), same, how)
