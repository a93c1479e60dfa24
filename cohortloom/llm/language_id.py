"""Language identification of whole texts and of spans in mixed-language text.

A word is what is left of a white-space token from its first letter on without what is neither letter
nor mark; marks alone are no word. Its script (by the code point range of its first letter) narrows the
languages to those that use the script for at least a hundredth of their letters in the training rows (less
is foreign words). Among them it is scored by hashed byte n-grams of the word. A
Viterbi pass over a text's words, with a penalty for each change of language,
labels the words; runs of a label are spans, and the language with most letters
is the text's.

The n-gram counts are summed by Spark over all labelled rows. The model is languages x 2**``bits`` numbers.
Beside it a task holds a bounded number of scores: texts go in smaller steps the more languages there are, and
one long text in slices, with the Viterbi values carried on and a bit per word and language kept.

Defined results: null text, or text without a letter, is ``und`` with score 0
and no spans. Words in a script that no learned language uses count for none; a
text of only such words gets the most frequent language with score 0. Rows with null language
teach nothing; with nothing to learn from, every text is ``und``. Equal rows
get equal results, and columns named like the results are replaced.
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

from cohortloom.llm.common import STEP_BYTES, byte_view, giving_back, numbered, segment_sums, split_words, steps

#: First code points of script ranges and their script.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1D00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFF20, "latin"),
    (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_FIRST = np.array([p for p, _ in SCRIPT_RANGES])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])
_GRAMS = (1, 2, 3, 4)
_LEAST_SHARE = 0.01  # of a language's letters, for a script to be one of its own
_SCORES = 1 << 22  # scores of words x languages that are held at once
_WEIGHT = 0.4  # n-grams of one word overlap: their evidence is not independent


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_probs: np.ndarray  # feature x language
    candidates: np.ndarray  # script x language: whether the language uses the script
    bits: int
    most_frequent: int


def letters_of(words: pa.Array) -> pa.Array:
    """Words in lower case from their first letter on, without anything but letters and marks."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"^[^\p{L}]+|[^\p{L}\p{M}]+", "")


def scripts_of(words: pa.Array) -> np.ndarray:
    """The script of each non-empty word's first letter."""
    first = "".join(pc.utf8_slice_codeunits(words, 0, 1).to_pylist())
    points = np.frombuffer(first.encode("utf-32-le"), np.uint32)
    return _SCRIPT[np.searchsorted(_FIRST, points, side="right") - 1]


def features_of(words: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the hashed n-grams of all words end to end, and len + 1
    offsets. A word's ends are bytes of their own."""
    framed = pc.binary_join_element_wise("\x02", words, "\x03", "")
    data, offsets = byte_view(framed)
    sizes = np.diff(offsets)
    ends = np.repeat(offsets[1:], sizes)
    place = np.arange(len(data))
    code = np.zeros(len(data), np.uint64)
    for n in range(1, max(_GRAMS) + 1):
        code *= np.uint64(0x100000001B3)
        code[: len(data) - n + 1] += data[n - 1 :] + np.uint64(n)
        inside = place + n <= ends
        mixed = (code[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        yield mixed.astype(np.int64), np.concatenate([[0], np.cumsum(np.maximum(sizes - n + 1, 0))])


def _some(words: pa.Array, columns: int) -> Iterator[slice]:
    """Slices of words, so few that a number per n-gram and column stays small."""
    size = max(500, 80_000 // max(4, columns))
    for start in range(0, len(words), size):
        yield slice(start, min(start + size, len(words)))


def train(docs: DataFrame, *, language: str = "lang", bits: int = 17) -> Model:
    """Learn from ``docs`` (text and language); the rows' other columns are not read."""
    known = docs.where(F.col("text").isNotNull() & F.col(language).isNotNull())
    known = known.select("text", F.col(language).cast("string").alias("language"))
    counts = {r["language"]: r["count"] for r in known.groupBy("language").count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros((1 << bits, 0)), np.zeros((len(SCRIPTS), 0), bool), bits, 0)
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((len(place), (1 << bits) + len(SCRIPTS)), np.uint32)  # a task's counts stay far below
        for whole in batches:
            for batch in steps(whole, "text"):
                words, offsets = split_words(batch.column("text"), lower=False)
                distinct, index = numbered(words)
                clean = letters_of(distinct)
                kept = np.flatnonzero(pc.greater(pc.binary_length(clean), 0).to_numpy(zero_copy_only=False))
                clean = clean.take(pa.array(kept))
                if not len(clean):
                    continue
                of_text = np.array([place[x] for x in batch.column("language").to_pylist()])
                owner = np.repeat(of_text, np.diff(offsets))
                pairs, uses = np.unique(owner * len(distinct) + index, return_counts=True)
                lang_of, word_of = np.divmod(pairs, len(distinct))
                position = np.full(len(distinct), -1)
                position[kept] = np.arange(len(kept))
                word_of = position[word_of]
                # Language by language, so that no table of languages x words is made.
                for lang in np.unique(lang_of).tolist():
                    mine = (lang_of == lang) & (word_of >= 0)
                    own, n = clean.take(pa.array(word_of[mine])), uses[mine]
                    if not len(own):
                        continue
                    letters = pc.utf8_length(own).to_numpy(zero_copy_only=False)
                    both[lang, 1 << bits :] += np.bincount(scripts_of(own), n * letters, len(SCRIPTS)).astype(np.uint32)
                    for part in _some(own, 1):
                        for grams, bounds in features_of(own[part.start : part.stop], bits):
                            uses_of = np.bincount(grams, np.repeat(n[part], np.diff(bounds)), 1 << bits)
                            both[lang, : 1 << bits] += uses_of.astype(np.uint32)
        # Once per task: what is shuffled does not grow with the task's texts.
        for lang, row in enumerate(both):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.float64))],
                ["lang", "at", "n"],
            )

    summed = known.mapInArrow(giving_back(count), "lang int, at int, n double").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # at most languages x (2**bits + scripts) rows
    uses = np.zeros(((1 << bits) + len(SCRIPTS), len(languages)))
    uses[found["at"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    grams, letters = uses[: 1 << bits], uses[1 << bits :]
    log_probs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * (1 << bits))).astype(np.float32)
    uses_script = letters >= _LEAST_SHARE * np.maximum(letters.sum(0), 1)
    return Model(languages, log_probs, uses_script, bits, int(np.argmax([counts[x] for x in languages])))


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each row of ``scores`` (row x label) when every change
    of label within a text costs ``penalty``. All texts advance together."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    value = np.zeros((len(sizes), scores.shape[1]), scores.dtype)
    stays = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int32)
    for t in range(longest):
        n = active[t]
        rows, v = starts[:n] + t, value[:n]
        best = v.argmax(1)
        changed = v[np.arange(n), best] - penalty
        stay = v >= changed[:, None]
        stays[rows], source[rows] = stay, best
        value[:n] = np.where(stay, v, changed[:, None]) + scores[rows]
    labels = np.zeros(len(scores), np.int64)
    state = value.argmax(1) if len(sizes) else np.zeros(0, np.int64)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        labels[rows] = state[:n]
        state[:n] = np.where(stays[rows, state[:n]], state[:n], source[rows])
    return labels


def viterbi_in_slices(scores_of, length: int, labels: int, penalty: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``viterbi`` for one long text, whose scores are made for ``size`` rows at a time.

    The values are carried from slice to slice; what is kept of a row is a bit per label and the
    best label before. ``scores_of(start, stop)`` gives scores, and which rows count; both are
    returned: labels and whether they count.
    """
    value = np.zeros(labels, np.float32)
    kept, source, counts = [], np.zeros(length, np.int32), np.zeros(length, bool)
    for start in range(0, length, size):
        scores, counts[start : start + size] = scores_of(start, min(start + size, length))
        stays = np.zeros(scores.shape, bool)
        for t, row in enumerate(scores):
            best = int(value.argmax())
            changed = value[best] - penalty
            stays[t] = value >= changed
            source[start + t] = best
            value = np.where(stays[t], value, changed) + row
        kept.append(np.packbits(stays, axis=1))
    found, state = np.zeros(length, np.int64), int(value.argmax())
    for start in reversed(range(0, length, size)):
        stays = np.unpackbits(kept.pop(), axis=1, count=labels).astype(bool)
        for t in range(len(stays) - 1, -1, -1):
            found[start + t] = state
            if not stays[t, state]:
                state = int(source[start + t])
    return found, counts


def word_scores(words: pa.Array, model: Model) -> np.ndarray:
    """Score of each distinct, non-empty word in each language."""
    count = len(model.languages)
    scores = np.zeros((len(words), count))
    for part in _some(words, count):
        for grams, bounds in features_of(words[part.start : part.stop], model.bits):
            scores[part] += segment_sums(model.log_probs[grams].astype(np.float64), bounds)
    scores *= _WEIGHT
    can = model.candidates[scripts_of(words)]
    # Languages that do not use the script lose by far; if none does, the word is for none.
    scores = np.where(can, scores, scores.min(1, keepdims=True) - 50.0)
    scores[~can.any(1)] = 0.0
    return scores.astype(np.float32)


def predict(texts: pa.Array, model: Model, penalty: float, spans: bool, most: int = _SCORES) -> dict[str, pa.Array]:
    """lang_pred, lang_score and, if asked for, lang_spans of each text. One text of more than ``most``
    scores (words x languages) is worked on in slices."""
    n = len(texts)
    words, offsets = split_words(texts, lower=False)
    distinct, index = numbered(words)
    clean = letters_of(distinct)
    has = pc.greater(pc.binary_length(clean), 0).to_numpy(zero_copy_only=False)
    used = clean.filter(pa.array(has))
    position = np.cumsum(has) - 1
    keep = np.flatnonzero(has[index]) if len(index) else np.zeros(0, np.int64)
    code = position[index[keep]] if len(keep) else keep
    bounds = np.searchsorted(keep, offsets)
    count = len(model.languages)
    text_of = np.repeat(np.arange(n), np.diff(bounds))
    share = np.zeros((n, count))
    labels = np.zeros(len(keep), np.int64)
    if count and len(used):
        if n == 1 and len(code) * count > most:

            def scores_of(start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
                some, again = np.unique(code[start:stop], return_inverse=True)
                table = word_scores(used.take(pa.array(some)), model)
                return table[again], table.any(1)[again]

            labels, counts = viterbi_in_slices(scores_of, len(code), count, penalty, max(1, most // count))
        else:
            table = word_scores(used, model)
            counts = table.any(1)[code]
            labels = viterbi(table[code], bounds, penalty)
        letters = pc.utf8_length(used).to_numpy(zero_copy_only=False)[code] * counts
        share = np.bincount(text_of * count + labels, letters, n * count).reshape(n, count)
    total = share.sum(1)
    lettered = (np.diff(bounds) > 0) & (count > 0)
    best = np.where(total > 0, share.argmax(1) if count else 0, model.most_frequent)
    names = np.array([*model.languages, "und"], object)
    score = np.where(total > 0, share.max(1, initial=0) / np.maximum(total, 1), 0.0)
    out = {
        "lang_pred": pa.array(names[np.where(lettered, best, count)], pa.string()),
        "lang_score": pa.array(np.where(lettered, score, 0.0)),
    }
    if spans:
        begins = np.ones(len(keep), bool)
        begins[1:] = (text_of[1:] != text_of[:-1]) | (labels[1:] != labels[:-1])
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(keep))[: len(first)] - 1
        inside = keep - offsets[:-1][text_of] if len(keep) else keep
        names_of = names[labels[first]] if count else np.full(len(first), "und", object)
        parts = pa.StructArray.from_arrays(
            [pa.array(names_of, pa.string()), pa.array(inside[first], pa.int64()), pa.array(inside[last], pa.int64())],
            ["lang", "first_word", "last_word"],
        )
        per_text = np.concatenate([[0], np.cumsum(np.bincount(text_of[first], minlength=n))])
        out["lang_spans"] = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), parts)
    return out


def label(docs: DataFrame, model: Model, *, penalty: float = 8.0, spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred, lang_score and, if asked for, lang_spans: the spans as
    places of their first and last word among the text's white-space tokens."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    if spans:
        span = T.StructType().add("lang", "string").add("first_word", "long").add("last_word", "long")
        added.append(T.StructField("lang_spans", T.ArrayType(span)))
    taken = {f.name.lower() for f in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # languages x 2**bits numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        most = max(1 << 16, 4 * STEP_BYTES // max(4, len(own.languages)))  # the more languages, the fewer texts at once
        for whole in batches:
            for batch in steps(whole, "text", most):
                new = predict(batch.column("text"), own, penalty, spans)
                yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*batch.schema.names, *new])

    return docs.select([f"`{f.name}`" for f in kept]).mapInArrow(giving_back(work), T.StructType([*kept, *added]))
