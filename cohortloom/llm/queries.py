"""The registered query of each operator, and its DuckDB statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    chat,
    decontamination,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality,
    spelling,
    suffix_dedup,
    token_counts,
    topk,
    vector_codes,
    warc,
)
from cohortloom.llm.common import new_folder, remainder, table
from cohortloom.operators.staging import staged

BYTE_BPE = "byte_bpe_50k.json"
#: <|endoftext|> of that vocabulary; no text has it, as special tokens are encoded as text.
END_OF_TEXT = 50256


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


def op1_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) != 2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(remainder("doc_id", 5) != 0))
    labelled = language_id.label(docs.select("doc_id", "text"), model)
    return labelled.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    read = warc.read_archive(spark, folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), verbatim=True)
    return found.drop("text_key")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = staged(quality.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    scored = quality.score_vectors(vectors, quality.train(vectors, labels))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Large steps: parts repeat, and each is encoded once per step.
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path(), step_bytes=16 << 20)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(table(spark, sf_dir, "documents"), tokenizer_path(), END_OF_TEXT)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.coded(table(spark, sf_dir, "embeddings")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hmm_lm": op1_hmm_lm,
        "op2_language_id": op2_language_id,
        "op3_warc": op3_warc,
        "op4_decontamination": op4_decontamination,
        "op5_quality": op5_quality,
        "op6_chat": op6_chat,
        "op7_packing": op7_packing,
        "op8_token_counts": op8_token_counts,
        "op9_near_dedup": op9_near_dedup,
        "op10_topk": op10_topk,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_vector_codes": op13_vector_codes,
    }


_SQL_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), s AS (
  SELECT page_id, strlen(body) AS n, sha256(body) AS digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM s
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first_id THEN first_id END AS refers_to,
       'ok' AS status
FROM f
"""

_SQL_CHAT = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text, sha256(text) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT *, row_number() OVER w AS i,
         string_agg(coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)), chr(3)) OVER w AS prefix,
         string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '')
           OVER w AS rendered
  FROM t
  WINDOW w AS (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, role NULLS FIRST, digest NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), c AS (
  SELECT conv_id, max(i) AS n_turns, arg_max(prefix, i) AS whole, arg_max(rendered, i) AS rendered
  FROM r GROUP BY conv_id
), u AS (
  SELECT whole, n_turns, min(conv_id) AS conv_id, count(*) AS copies, any_value(rendered) AS rendered
  FROM c GROUP BY whole, n_turns
), shorter AS (
  SELECT DISTINCT r.prefix FROM r JOIN c ON r.conv_id = c.conv_id WHERE r.i < c.n_turns
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, CAST(copies AS BIGINT) AS copies, rendered
FROM u WHERE whole NOT IN (SELECT prefix FROM shorter)
"""

_SQL_TOPK = """
WITH v AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


_SQL_SUFFIX_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM d WHERE n >= 100)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1
), g AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM r
), c AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g) GROUP BY doc_id, span
), k AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM c
), m AS (
  SELECT d.doc_id, any_value(d.n) AS n, CAST(coalesce(sum(k.b - k.a), 0) AS BIGINT) AS gone, count(k.a) AS spans,
         coalesce(string_agg(substr(d.h, 2 * k.before + 1, 2 * (k.a - k.before)), '' ORDER BY k.a), '')
           || substr(any_value(d.h), 2 * coalesce(max(k.b), 0) + 1) AS kept
  FROM d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id
)
SELECT doc_id, n AS n_bytes, gone AS n_removed, spans AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM m
"""

_CODE_PARTS, _CODE_ENTRIES, _CODE_ROUNDS = 8, 16, 6


def _sql_vector_codes() -> str:
    """The rounds written out one after another; every round compares all parts with all entries."""
    places = range(1, 1 + 64 // _CODE_PARTS)  # a part of the test tables' vectors has eight components
    distance = " + ".join(f"(p.x[{i}] - b.x[{i}]) * (p.x[{i}] - b.x[{i}])" for i in places)
    sums = ", ".join(f"CAST(sum(x[{i}]) AS BIGINT) AS s{i}" for i in places)
    means = ", ".join(f"CAST(floor((s{i} - ((s{i} % n) + n) % n) / n) AS BIGINT)" for i in places)
    text = " || ',' || ".join(f"CAST(x[{i}] AS VARCHAR)" for i in places)

    def assign(r: int, book: str) -> str:
        return f"""a{r} AS (
  SELECT vec_id, label, part, x, entry, d FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS nth FROM (
      SELECT p.vec_id, p.label, p.part, p.x, b.entry, {distance} AS d FROM p JOIN {book} AS b ON p.part = b.part))
  WHERE nth = 1)"""

    steps, book = [], "b0"
    for r in range(1, _CODE_ROUNDS + 1):
        steps.append(assign(r, book))
        steps.append(f"m{r} AS (SELECT part, entry, count(*) AS n, {sums} FROM a{r} GROUP BY part, entry)")
        steps.append(f"""b{r} AS (
  SELECT o.part, o.entry, CASE WHEN m.n IS NULL THEN o.x ELSE [{means}] END AS x
  FROM {book} AS o LEFT JOIN m{r} AS m ON o.part = m.part AND o.entry = m.entry)""")
        book = f"b{r}"
    steps.append(assign(_CODE_ROUNDS + 1, book))
    return f"""
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT vec_id, label, part, v[part * {len(places)} + 1 : (part + 1) * {len(places)}] AS x
  FROM v, (SELECT unnest(range({_CODE_PARTS})) AS part) AS parts
), b0 AS (
  SELECT p.part, f.entry, p.x
  FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) AS f ON p.vec_id = f.vec_id
  WHERE f.entry < {_CODE_ENTRIES}
), {", ".join(steps)}, coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{_CODE_ROUNDS + 1} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg({text}, ',' ORDER BY part, entry)) FROM {book}) AS codebooks_sha256
FROM coded
"""


def oracle() -> dict[str, str]:
    return {
        "op3_warc": _SQL_WARC,
        "op6_chat": _SQL_CHAT,
        "op10_topk": _SQL_TOPK,
        "op12_suffix_dedup": _SQL_SUFFIX_DEDUP,
        "op13_vector_codes": _sql_vector_codes(),
    }
