"""Benchmark contamination by templates: also questions asked again with other numbers or names.

A token is lower-cased and freed of outer punctuation; in scripts without spaces each character is
a token. Numbers, in digits or as a word of ``NUMBER_WORDS``, units after a number
and names (capitalised words inside a sentence) become typed placeholders. Windows
of ``window`` template tokens with at least ``literals`` plain words are hashed and
joined between documents and benchmark. Aligned windows of a document and an item
are one match if their slots agree: the same benchmark value always stands for the same
document value. Words put into or left out of a copy shift what follows, so the alignments of a document and an item
that match different places of the item are pieces of one copy, whose slots must agree together; where a place of
the item is matched twice, there are several copies, and each alignment is looked at by itself. With ``verbatim`` (as the registered query and the pipeline ask), windows whose
slots all equal the item's match whatever conflicts elsewhere. A document is contaminated by an item if its consistent matches cover
``tokens`` benchmark tokens in aligned windows (or the whole item, if shorter).

A bit table of a fixed size over the benchmark's window hashes lets tasks drop
windows that cannot join; the join itself decides, whatever the benchmark's size.

Windows of fewer plain words, and items of fewer than ``shortest`` tokens, are hashed and joined
as written: without placeholders. So are windows whose first token may be a name or unit in one
text and a plain word in the other.

Defined results: null and empty texts have no window. Items of fewer than ``window`` tokens are
one window of their own length. Quoted inside a sentence, an item's capitalised
first word looks like a name; its first window is known in both forms. Equal rows give equal results,
one per row; null ids are kept. Only ids and texts are read.
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

from cohortloom.llm.common import STEP_BYTES, giving_back, mixed, numbered, split_words, steps, string_hashes, text_key
from cohortloom.operators import sizing
from cohortloom.operators.staging import staged

#: Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg t lb lbs oz pound pounds ounce ounces "
    "gram grams kilogram kilograms ton tons ml l liter liters litre litres gallon gallons s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years percent % dollar dollars cent cents "
    "euro euros usd eur degree degrees c f k hz khz mhz w kw kwh v a j kj kcal cal mph kmh meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters"
).split()

#: Numbers as words.
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen"
).split()

#: Characters of scripts that are written without spaces.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"

_NUMBER, _UNIT, _NAME, _AMOUNT = (np.uint64(x) for x in (11, 13, 17, 19))
_LITERAL = np.uint64(1 << 32)  # sets hashes of tokens as written apart
_BITS = 22  # 2**22 bits: the size of the bit table
_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)
_OUTER = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


@dataclass(frozen=True)
class Tokens:
    codes: np.ndarray  # template code of each token
    words: np.ndarray  # its code without placeholders
    plain: np.ndarray  # whether it is a plain word
    unsteady: np.ndarray  # whether what stands before it decides if it is plain
    bounds: np.ndarray  # the texts' offsets
    forms: pa.Array  # distinct lower-cased tokens
    index: np.ndarray  # each token's place among them: its slot value


def templates(texts: pa.Array, inside: bool = False) -> Tokens:
    """The tokens of all texts.

    A text's first token opens a sentence, or does not if the text stands ``inside`` one.
    """
    unspaced = pc.match_substring_regex(texts, _UNSPACED)
    if pc.any(unspaced).as_py():
        texts = pc.if_else(unspaced, pc.replace_substring_regex(texts, _UNSPACED, r" \1 "), texts)
    words, bounds = split_words(texts, lower=False)
    raw, index = numbered(words)
    core = pc.replace_substring_regex(raw, _OUTER, "")
    lower = pc.utf8_lower(core)

    def flag(values) -> np.ndarray:
        return values.to_numpy(zero_copy_only=False).astype(bool)[index]

    full = flag(pc.greater(pc.binary_length(core), 0))
    number = flag(pc.or_(pc.match_substring_regex(core, r"^\p{N}+([.,:/]\p{N}+)*$"), pc.is_in(lower, value_set=pa.array(NUMBER_WORDS))))
    amount = flag(pc.match_substring_regex(core, r"^\p{N}+([.,]\p{N}+)*\p{L}{1,3}$"))
    title = flag(pc.match_substring_regex(core, r"^\p{Lu}[\p{Ll}'’-]+$"))
    unit = flag(pc.is_in(lower, value_set=pa.array(UNITS)))
    stops = flag(pc.match_substring_regex(raw, r"[.!?:]\W*$"))
    codes = string_hashes(lower, seed=5)[index] if len(index) else np.zeros(0, np.uint64)

    starts = np.zeros(len(index) + 1, bool)
    starts[bounds[:-1]] = True
    opening = np.full(len(index), False) if inside else starts[: len(index)].copy()
    opening[1:] |= stops[:-1] & ~starts[1 : len(index)]
    after_number = np.zeros(len(index), bool)
    after_number[1:] = number[:-1] & ~starts[1 : len(index)]
    unsteady = title | unit
    unit &= after_number & full
    name = title & ~opening
    plain = ~(number | amount | unit | name)
    as_written = codes.copy()
    for mask, code in ((name, _NAME), (amount, _AMOUNT), (number, _NUMBER), (unit, _UNIT)):
        codes[mask] = code
    kept = np.concatenate([[0], np.cumsum(full)])
    return Tokens(codes[full], as_written[full], plain[full], unsteady[full], kept[bounds], lower, index[full])


def window_hashes(codes: np.ndarray, size: int, kind: np.uint64 = np.uint64(0)) -> np.ndarray:
    """The hash of the ``size`` codes from each place on (not valid near a text's end)."""
    rolled = codes.copy()
    for j in range(1, min(size, len(codes))):
        rolled[:-j] = rolled[:-j] * _MULTIPLIER + codes[j:]
    return mixed(rolled + np.uint64(size) + kind)


_WINDOWS = "id long, text_key long, row long, hash long, at long, size int, literal boolean, n_tokens long, slots array<string>"


def _windows(
    texts: DataFrame, sizes_of, literals: int, shortest: int, bits: np.ndarray | None = None, quoted: bool = False
) -> DataFrame:
    """A row per window (of ``bits`` if given) of ``texts`` (id, text_key, text).

    ``sizes_of`` gives, for texts of given lengths, the window sizes to take, whether
    literally (without placeholders), and from which texts. ``quoted`` is for the benchmark: a first
    window that differs inside a sentence has a row for that form too, and windows are taken
    literally only where their template may not be found: of few plain words, shorter than
    ``shortest``, or with a first token that what stands before it makes plain or not.
    """
    shared = None if bits is None else texts.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = TaskContext.get().partitionId() << 40, 0
        for whole in batches:
            for batch in steps(whole, "text", STEP_BYTES // 2):
                opened = templates(batch.column("text"))
                forms_of_text = [opened, templates(batch.column("text"), inside=True)] if quoted else [opened]
                bounds = opened.bounds
                lengths = np.diff(bounds)
                owner = np.repeat(np.arange(batch.num_rows), lengths)
                place = np.arange(len(opened.codes))
                every = [(*kind, form) for kind in sizes_of(lengths) for form in (forms_of_text[:1] if kind[1] else forms_of_text)]
                for size, literal, of_texts, form in every:
                    hashes = window_hashes(form.words, size, _LITERAL) if literal else window_hashes(form.codes, size)
                    valid = (place + size <= bounds[1:][owner]) & of_texts[owner]
                    ends = np.minimum(place + size, len(place))
                    if not literal:
                        valid &= _sums(form.plain, place, ends) >= min(literals, size)
                        if form is not opened:
                            valid &= (place == bounds[:-1][owner]) & (form.codes != opened.codes)
                    elif quoted and size >= shortest:
                        fewest = np.minimum(*(_sums(x.plain, place, ends) for x in forms_of_text))
                        valid &= opened.unsteady | (fewest < min(literals, size))
                    if shared is not None:
                        prefix = hashes >> np.uint64(64 - _BITS)
                        valid &= (shared.value[prefix >> np.uint64(3)] >> (prefix & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at = np.flatnonzero(valid)
                    if not len(at):
                        continue
                    # A literal match needs no document values: they are the item's.
                    spans = [slice(a, a + size) if quoted or not literal else slice(0) for a in at]
                    slots = [form.forms.take(pa.array(form.index[x][~form.plain[x]])) for x in spans]
                    counts = np.concatenate([[0], np.cumsum([len(s) for s in slots])])
                    of = owner[at]
                    arrays = [
                        batch.column("id").take(pa.array(of)),
                        batch.column("text_key").take(pa.array(of)),
                        pa.array(task + rows + of),
                        pa.array(hashes[at].astype(np.int64)),
                        pa.array(at - bounds[:-1][of]),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(np.full(len(at), literal)),
                        pa.array(lengths[of]),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.concat_arrays([x.cast(pa.string()) for x in slots])),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names)
                rows += batch.num_rows

    names = [c.split()[0] for c in _WINDOWS.split(", ")]
    return texts.mapInArrow(giving_back(work), _WINDOWS)


def _sums(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(marks)])
    return before[ends] - before[starts]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 8,
    literals: int = 4,
    tokens: int = 13,
    shortest: int = 5,
    verbatim: bool = False,
) -> DataFrame:
    """doc_id, text_key, item_id, matched_windows, item_windows and exact (no slot differs) of
    each document row and item that match. With ``verbatim``, a conflict of slots costs only
    the differing windows that hold the value in conflict, else all of the alignment's."""

    def item_sizes(lengths: np.ndarray):
        for size in range(1, window + 1):
            of = lengths >= window if size == window else lengths == size
            yield size, True, of
            if size >= min(shortest, window):
                yield size, False, of

    items = benchmark.select(F.col("item_id").cast("long").alias("id"), text_key().alias("text_key"), "text")
    asked = staged(_windows(items, item_sizes, literals, shortest, quoted=True), "benchmark-windows")
    present = sorted(map(tuple, asked.select("size", "literal").distinct().collect()))  # at most 2 x ``window``
    asked = asked.select(
        F.col("id").alias("item_id"), F.col("row").alias("item"), "hash", F.col("at").alias("item_at"), "size",
        "literal", F.col("n_tokens").alias("item_tokens"), F.col("slots").alias("item_slots"),
    )
    prefix = F.shiftrightunsigned("hash", 64 - _BITS).cast("int")
    found = asked.select(prefix.alias("p")).distinct().toArrow()["p"].to_numpy()  # at most 2**_BITS numbers
    bits = np.zeros(1 << (_BITS - 3), np.uint8)
    np.bitwise_or.at(bits, found >> 3, (1 << (found & 7)).astype(np.uint8))

    def all_sizes(lengths: np.ndarray):
        for size, literal in present:
            yield size, literal, lengths >= size

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_key().alias("text_key"), "text")
    hits = _windows(texts, all_sizes, literals, shortest, bits)
    if sizing.broadcastable({"asked": asked}):
        asked = F.broadcast(asked)
    pairs = F.arrays_zip("item_slots", F.when(F.col("literal"), F.col("item_slots")).otherwise(F.col("slots")).alias("slots"))
    of_item = ["row", "id", "text_key", "item", "item_id", "item_tokens"]
    place = F.struct(F.col("item_at").alias("at"), "size", pairs.alias("pairs"))
    shifts = (
        hits.drop("n_tokens", "size", "literal")
        .join(asked, "hash")
        .groupBy(*of_item, (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.collect_list(place).alias("windows"))
    )
    # All that follows is grouped by document row and item first, so it needs no further shuffle.
    per_copy = shifts.groupBy(*of_item).agg(F.collect_list(F.struct("shift", "windows")).alias("shifts"))
    matched = F.flatten(F.transform("shifts", lambda s: F.array_distinct(F.transform(s["windows"], lambda w: F.struct(w["at"], w["size"])))))
    aligned = (
        per_copy.withColumn("copies", F.size(matched) > F.size(F.array_distinct(matched)))
        .withColumn("a", F.explode("shifts"))
        .groupBy(*of_item, F.when(F.col("copies"), F.col("a.shift")).alias("shift"))
        .agg(F.flatten(F.collect_list("a.windows")).alias("windows"))
        .withColumn("pairs", F.array_distinct(F.flatten("windows.pairs")))
        .withColumn("values", F.array_sort("pairs.item_slots"))
        # Benchmark values that stand for several document values.
        .withColumn("unsure", F.filter("values", lambda v, i: (i > 0) & (v == F.get("values", i - 1))))
    )

    def same(of: Column) -> Column:
        return F.forall(of, lambda p: p["item_slots"].eqNullSafe(p["slots"]))

    if verbatim:
        kept = F.filter("windows", lambda w: same(w["pairs"]) | ~F.arrays_overlap(w["pairs"]["item_slots"], "unsure"))
        consistent = aligned.withColumn("windows", kept)
    else:
        consistent = aligned.where(F.size("unsure") == 0)
    # A size of windows by itself covers the item or not.
    each = consistent.withColumn("exact", same(F.col("pairs"))).withColumn("w", F.explode("windows"))
    of_size = each.groupBy(*of_item, "shift", "w.size").agg(F.collect_set("w.at").alias("places"), F.bool_and("exact").alias("exact"))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(at, at + F.col("size") - 1))))
    enough = F.least(F.col("item_tokens"), F.lit(tokens))
    per_item = of_size.where(F.size(covered) >= enough).groupBy(*of_item).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("matched_windows"),
        F.max(F.col("item_tokens") - F.col("size") + 1).alias("item_windows"),
        F.bool_and("exact").alias("exact"),
    )
    return per_item.select(F.col("id").alias("doc_id"), "text_key", "item_id", "matched_windows", "item_windows", "exact")
