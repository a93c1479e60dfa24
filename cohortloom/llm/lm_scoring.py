"""Language model scoring with a hidden Markov model over all words of the corpus.

A text is its words and one end token. Every token has a class: the end, each of the
most frequent words (a class of its own) and spelling classes of the rest
(hashed ending and length). The states emit classes; a rare word is then drawn
from its class by its training count plus one, with one more place for all unseen
words. So the model covers every word, what has to be known per state stays
bounded, and the counts of all words stay in a distributed table.

Training. Spark counts all words of the training texts. Baum-Welch begins with hashed noise and
runs over all training texts ``iterations`` times, by the incremental form of the algorithm: the texts are
dealt into ``shards`` by a hash of id and text; a step takes expected counts over one shard (a task adds
up its rows, Spark sums tasks by class), replaces that shard's former counts, and sets the states from the
counts of all shards. An iteration reads each text once, whole, and the states move on ``shards``
times. Texts are cut into runs of ``run_tokens`` tokens, and a run that is not a
text's first starts from a state distribution of its own. Sums are taken in doubles, so a score
does not depend on how the input is partitioned, but for rounding.

Scoring runs the scaled forward recursion over each whole text, uncut, in doubles.
Counts of the ``known_words`` most frequent words are at hand in each task; rarer words
are joined to the table of counts, one row per text and word.

Defined results: a null or empty text is its end token. A null id counts as empty
text for the split. Equal rows are scored each for itself. Without any training
row every token has the base probability 1, and the model's classes are equally
likely. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import byte_view, mixed, new_folder, numbered, split_words, steps
from cohortloom.operators.staging import staged

_END = 0  # the class of the end token
_SPELLINGS = 1024
_FIRST_WORD = 1 + _SPELLINGS  # the class of the most frequent word
_SMOOTH = 30.0  # expected counts a state gets from the overall distribution
_STEP_TOKENS = 1 << 18  # tokens of one step inside a task; one longer text is a step by itself
_BUCKETS = 16  # per doubling of a count, where the frequent words are cut off


@dataclass(frozen=True)
class Words:
    """The frequent words, most frequent first, their counts, and what spelling classes hold."""

    words: list[str]
    counts: np.ndarray
    own_class: int  # this many have a class of their own
    class_counts: np.ndarray  # training tokens of each class
    class_words: np.ndarray  # distinct training words of each spelling class not among ``own_class``
    total: int  # N
    distinct: int  # V
    texts: int


@dataclass(frozen=True)
class States:
    first: np.ndarray
    again: np.ndarray  # start of a run that continues a text
    moves: np.ndarray
    emits: np.ndarray  # class x state


def spelling_classes(words: pa.Array) -> np.ndarray:
    """The spelling class of each word: its last three bytes and length, hashed."""
    data, offsets = byte_view(words)
    lengths = np.diff(offsets)
    code = np.minimum(lengths, 24).astype(np.uint64) // np.uint64(3)
    for back in (1, 2, 3):
        at = np.maximum(offsets[1:] - back, offsets[:-1])
        code = code * np.uint64(257) + np.where(lengths >= back, data[np.minimum(at, max(0, len(data) - 1))] if len(data) else 0, 256).astype(np.uint64)
    return 1 + (mixed(code) % np.uint64(_SPELLINGS)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """word and its count over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text", 32 << 20):
                found = split_words(batch.column("text"))[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


def learn_words(counts: DataFrame, texts: int, *, known_words: int, own_class: int) -> Words:
    """``counts`` is read three times: pass a written table."""
    # Cut off by a histogram of counts, so that no sort of all words is needed.
    bucket = F.floor(F.log2("c") * _BUCKETS).cast("int")
    histogram = counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))
    sizes = sorted(histogram.collect(), key=lambda r: -r["bucket"])  # a few hundred rows
    total, distinct = sum(r["c"] for r in sizes), sum(r["n"] for r in sizes)
    least, held = None, 0
    for r in sizes:
        if held + r["n"] > known_words:
            break
        least, held = r["bucket"], held + r["n"]
    head: list = []
    if least is not None:
        head = counts.where(bucket >= least).collect()  # at most known_words rows
        head.sort(key=lambda r: (-r["c"], r["word"]))
    own = min(own_class, len(head))
    words = [r["word"] for r in head]
    counted = np.array([r["c"] for r in head], np.int64)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = spelling_classes(batch.column("word"))
            c = batch.column("c").to_numpy().astype(float)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(_FIRST_WORD, dtype=np.int32)),
                    pa.array(np.bincount(cls, c, _FIRST_WORD).astype(float)),
                    pa.array(np.bincount(cls, minlength=_FIRST_WORD).astype(float)),
                ],
                ["class", "c", "n"],
            )

    sums = counts.mapInArrow(classes, "class int, c double, n double").groupBy("class").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    class_counts = np.zeros(_FIRST_WORD + own)
    class_words = np.zeros(_FIRST_WORD)
    for r in sums.collect():  # a row per spelling class
        class_counts[r["class"]], class_words[r["class"]] = r["c"], r["n"]
    if own:  # these words are not in spelling classes
        cls = spelling_classes(pa.array(words[:own], pa.string()))
        np.subtract.at(class_counts, cls, counted[:own])
        np.subtract.at(class_words, cls, 1)
        class_counts[_FIRST_WORD:] = counted[:own]
    class_counts[_END] = texts
    ends = 1 if texts else 0
    return Words(words, counted, own, class_counts, class_words, total + texts, distinct + ends, texts)


def encode(docs: DataFrame, known: Words, training: Column, shards: int) -> DataFrame:
    """A row per text with its classes, the sums over its frequent words, and its rare words.

    row, doc_id, held_out, shard (-1 if held out), n_tokens, classes; n_known and log_counts (sum of
    log10(c + 1)) over the end and frequent words; class_loss (sum of log10 of the
    class sizes of words drawn from a class); rare and rare_n.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(known))  # at most known_words words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Words(**shared.value)
        frequent = pa.array(own.words, pa.string())
        log_counts = np.log10(own.counts + 1.0)
        sizes = np.log10(own.class_counts[:_FIRST_WORD] + own.class_words + 1.0)
        task, rows = TaskContext.get().partitionId() << 40, 0
        for whole in batches:
            for batch in steps(whole, "text"):
                n = batch.num_rows
                words, ends = split_words(batch.column("text"))
                distinct, index = numbered(words)
                place = pc.fill_null(pc.index_in(distinct, value_set=frequent), -1).to_numpy(zero_copy_only=False)
                drawn = (place < 0) | (place >= own.own_class)  # from a spelling class
                cls = np.where(drawn, spelling_classes(distinct), _FIRST_WORD + place)
                logs = np.append(log_counts, 0.0)[place]
                owner = np.repeat(np.arange(n), np.diff(ends))

                def per_row(of_word: np.ndarray, owner=owner, index=index, n=n) -> np.ndarray:
                    return np.bincount(owner, of_word[index], n).astype(float)

                rare = np.flatnonzero(place[index] < 0)
                pairs, uses = np.unique(owner[rare] * max(1, len(distinct)) + index[rare], return_counts=True)
                rare_owner, rare_word = np.divmod(pairs, max(1, len(distinct)))
                per_text = np.concatenate([[0], np.cumsum(np.bincount(rare_owner, minlength=n))])
                rare_words = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), distinct.take(pa.array(rare_word)))
                rare_uses = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.array(uses.astype(np.int32)))
                # The end token after each text's words.
                closed = np.zeros(len(index) + n, np.int32)
                closed[np.arange(len(index)) + owner] = cls[index]
                bounds = ends + np.arange(n + 1)
                held = batch.column("held_out")
                columns = {
                    "row": pa.array(task + rows + np.arange(n)),
                    "doc_id": batch.column("doc_id"),
                    "held_out": held,
                    "shard": batch.column("shard"),
                    "n_tokens": pa.array(np.diff(bounds)),
                    "classes": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(closed)),
                    "n_known": pa.array(np.bincount(owner, place[index] >= 0, n).astype(np.int64) + (own.texts > 0)),
                    "log_counts": pa.array(per_row(logs) + np.log10(own.texts + 1.0)),
                    "class_loss": pa.array(per_row(np.where(drawn, sizes[np.minimum(cls, _FIRST_WORD - 1)], 0.0))),
                    "drawn_log": pa.array(per_row(np.where(drawn, logs, 0.0))),
                    "rare": rare_words,
                    "rare_n": rare_uses,
                }
                rows += n
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        "row long, doc_id long, held_out boolean, shard int, n_tokens long, classes array<int>, n_known long, "
        "log_counts double, class_loss double, drawn_log double, rare array<string>, rare_n array<int>"
    )
    dealt = F.when(training, F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))).otherwise(-1).cast("int")
    kept = docs.select(F.col("doc_id").cast("long"), "text", (~training).alias("held_out"), dealt.alias("shard"))
    return kept.mapInArrow(work, schema)


def runs_of(column: pa.Array, run_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes end to end, the runs' offsets, and whether a run is a text's first."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    codes = column.flatten().to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    lengths = np.diff(bounds)
    counts = -(-lengths // run_tokens)
    starts = np.repeat(bounds[:-1], counts) + run_tokens * (
        np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    )
    first = np.isin(starts, bounds[:-1])
    return codes, np.append(starts, len(codes)), first


def expected_counts(codes: np.ndarray, offsets: np.ndarray, first: np.ndarray, states: States) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of all runs: starts (first, again), moves, class x state.

    All runs advance together; probabilities are scaled at every token.
    """
    k = len(states.first)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    emits, moves = states.emits, states.moves
    forward = np.empty((len(codes), k))
    scale = np.empty(len(codes))
    alpha = np.where(first[order][:, None], states.first, states.again)
    for t in range(longest):
        n = active[t]
        rows = starts[:n] + t
        a = (alpha[:n] @ moves if t else alpha[:n]) * emits[codes[rows]]
        total = a.sum(1)
        a /= total[:, None]
        alpha[:n], forward[rows], scale[rows] = a, a, total
    moved = np.zeros((k, k))
    beta = np.ones((len(sizes), k))
    for t in range(longest - 1, 0, -1):
        n = active[t]
        rows = starts[:n] + t
        ahead = emits[codes[rows]] * beta[:n] / scale[rows][:, None]
        before = forward[rows - 1]
        moved += before.T @ ahead
        forward[rows] *= beta[:n]
        beta[:n] = ahead @ moves.T
    at_start = starts[sizes > 0]
    forward[at_start] *= beta[: len(at_start)]
    opening = forward[at_start]
    is_first = first[order][sizes > 0]
    per_class = np.stack([np.bincount(codes, forward[:, j], len(emits)) for j in range(k)], axis=1)
    return opening[is_first].sum(0), opening[~is_first].sum(0), moved * states.moves, per_class


def log_likelihoods(codes: np.ndarray, offsets: np.ndarray, states: States) -> np.ndarray:
    """log10 probability of each class sequence by the scaled forward recursion."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    alpha = np.repeat(states.first[None, :], len(sizes), axis=0)
    logs = np.zeros(len(sizes))
    for t in range(longest):
        n = active[t]
        a = (alpha[:n] @ states.moves if t else alpha[:n]) * states.emits[codes[starts[:n] + t]]
        total = a.sum(1)
        alpha[:n] = a / total[:, None]
        logs[:n] += np.log10(total)
    out = np.zeros(len(sizes))
    out[order] = logs
    return out


def maximised(first: np.ndarray, again: np.ndarray, moved: np.ndarray, per_class: np.ndarray, background: np.ndarray) -> States:
    """States from expected counts, smoothed so that nothing is impossible."""
    k = len(first)

    def normal(x: np.ndarray) -> np.ndarray:
        return x / x.sum(-1, keepdims=True)

    mass = per_class.sum(0)
    emits = (per_class + _SMOOTH * background[:, None]) / (mass + _SMOOTH)
    return States(normal(first + 1.0), normal(again + 1.0), normal(moved + 1.0 + 10.0 * np.eye(k)), emits)


def start_states(known: Words, k: int) -> States:
    """States of hashed noise around the classes' shares."""
    background = (known.class_counts + 1.0) / (known.class_counts + 1.0).sum()
    place = np.arange(len(background) * k, dtype=np.uint64)
    noise = mixed(place + np.uint64(1)).astype(np.float64).reshape(-1, k) / 2.0**64
    emits = background[:, None] * (0.5 + noise)
    emits /= emits.sum(0)
    return States(np.full(k, 1 / k), np.full(k, 1 / k), np.full((k, k), 0.02 / k) + 0.98 * np.eye(k), emits)


def expected_totals(texts: DataFrame, states: States, run_tokens: int) -> np.ndarray:
    """Expected counts over all rows of ``texts``: a row per class, the two starts, and the moves."""
    cells, k = states.emits.shape
    shared = texts.sparkSession.sparkContext.broadcast(vars(states))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = States(**shared.value)
        total = np.zeros((cells + 2 + k, k))
        for batch in batches:
            for part in _parts(batch.column("classes"), _STEP_TOKENS):
                first, again, moved, per_class = expected_counts(*runs_of(part, run_tokens), own)
                total[:cells] += per_class
                total[cells] += first
                total[cells + 1] += again
                total[cells + 2 :] += moved
        at = np.flatnonzero(total.any(1))
        arrays = [pa.array(at.astype(np.int32)), *(pa.array(total[at, j]) for j in range(k))]
        yield pa.RecordBatch.from_arrays(arrays, ["at", *(f"s{j}" for j in range(k))])

    columns = ", ".join(f"s{j} double" for j in range(k))
    added = (F.sum(f"s{j}").alias(f"s{j}") for j in range(k))
    found = texts.select("classes").mapInArrow(count, f"at int, {columns}").groupBy("at").agg(*added).toArrow()
    shared.unpersist()
    total = np.zeros((cells + 2 + k, k))  # bounded by the model, not by the corpus
    total[found["at"].to_numpy()] = np.stack([found[f"s{j}"].to_numpy() for j in range(k)], axis=1)
    return total


def train_states(encoded: DataFrame, known: Words, *, k: int = 8, shards: int = 4, iterations: int = 3, run_tokens: int = 256) -> States:
    """Baum-Welch over all training rows of ``encoded``, a table written by shard."""
    background = (known.class_counts + 1.0) / (known.class_counts + 1.0).sum()
    states = start_states(known, k)
    cells = len(background)
    totals = np.zeros((shards, cells + 2 + k, k))
    for step in range(shards * iterations):
        shard = step % shards
        totals[shard] = expected_totals(encoded.where(F.col("shard") == shard), states, run_tokens)
        total = totals.sum(0)
        if total.any():  # the first shards of a few texts may have none
            states = maximised(total[cells], total[cells + 1], total[cells + 2 :], total[:cells], background)
    return states


def _parts(column: pa.Array, tokens: int) -> Iterator[pa.Array]:
    """Slices of a list column of about ``tokens`` items, at least one row each."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + tokens, side="right")) - 1)
        yield column.slice(start, stop - start)
        start = stop


def score_texts(encoded: DataFrame, counts: DataFrame, known: Words, states: States) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each text."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(vars(states))
    passed = ["row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "class_loss", "drawn_log"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = States(**shared.value)
        for batch in batches:
            logs = []
            for part in _parts(batch.column("classes"), _STEP_TOKENS):
                bounds = part.offsets.to_numpy().astype(np.int64)
                logs.append(log_likelihoods(part.flatten().to_numpy(), bounds - bounds[0], own))
            found = np.concatenate(logs) if logs else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(found)], [*passed, "states_log"])

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, "
        "class_loss double, drawn_log double, states_log double"
    )
    scored = encoded.select(*passed, "classes").mapInArrow(work, schema)
    pairs = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("p"))
    pairs = pairs.select("row", F.col("p.rare").alias("word"), F.col("p.rare_n").alias("n"))
    # A word not in the table has c = 0: it adds log10(1) and is not known.
    rare = (
        pairs.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"))
    )
    base = float(np.log10(known.total + 1.0 * (known.distinct + 1)))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + rare_log - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("states_log") + F.col("drawn_log") + rare_log - F.col("class_loss")).alias("score"),
    )


def score(
    docs: DataFrame, training: Column, *, known_words: int = 1 << 18, own_class: int = 1 << 15, k: int = 8, shards: int = 4, iterations: int = 3
) -> DataFrame:
    """Learn from the rows where ``training`` holds and score all rows."""
    spark = docs.sparkSession
    learned = docs.where(training)
    counts = staged(count_words(learned), "word-counts")
    known = learn_words(counts, learned.count(), known_words=known_words, own_class=own_class)
    written = encode(docs, known, training, shards)
    folder = new_folder(spark, "encoded-texts")
    written.write.partitionBy("shard").parquet(folder)
    encoded = spark.read.schema(written.schema).parquet(folder)
    states = train_states(encoded, known, k=k, shards=shards, iterations=iterations)
    return score_texts(encoded, counts, known, states)
