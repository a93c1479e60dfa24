"""Grouping spelling variants: words one edit apart, found by scanning sorted lists.

The scan. A list of words is sorted, and words with a common prefix share the rows of the
edit matrix up to there: a row is computed once for each run of neighbours whose longest common
prefix (LCP) reaches it. Only the band of three cells around the diagonal can hold a distance of
one or less. Where all three exceed one, the whole run of words with that prefix is skipped. The rows
of all queries of a step move on together, one code point at a time, in numpy.

What is scanned. Two words one edit apart, the shorter of m code points, agree in their first m // 2 code points
or in their last m - m // 2. So a word joins, for m its length and its length less one, the list of
words with its first half and (read backwards) of those with its last half. A list of more than
``most`` words is split by one more code point; the pairs that differ just there meet in
lists of what is left without it, of at most an alphabet's size. No task holds more than a list.

Forms (the commonest near word, if twice as common) point to ever commoner words, so a path has at most log2(n) steps;
pointers are doubled until they stand still.

Defined results: a null text has no words; a null doc_id counts as empty text; repeated rows count
each. Runs, lengths and places are in code points. No row gives no word. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import sizing
from cohortloom.operators.joins import salted_join
from cohortloom.operators.staging import staged

#: Fixed value: what a word is made of.
LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = 1 << 16  # code points of words that one step inside a task scans
_SALTS = 16


def slips(run: Column, doc_id: Column, every: int = 97) -> Column:
    """The run, in documents picked by a checksum without one code point: the slips of the corpus."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h, n = F.crc32(named.cast("binary")), F.char_length(run)
    at = (h % n).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, n))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, *, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word and n: the words of all texts, counted."""
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))
    each = docs.select("doc_id", F.explode(runs).alias("run")).select(slips(F.col("run"), F.col("doc_id")).alias("word"))
    counted = each.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _lists(words: DataFrame, min_length: int) -> DataFrame:
    """A row per word and list: ``seen`` is the word as the list reads it, which is known to agree in
    its first ``same`` code points; ``m`` is the length of the shorter word of a pair."""
    length = F.char_length("word")
    shorter = F.array_distinct(F.array(length, F.greatest(length - 1, F.lit(min_length))))
    each = words.select("word", F.explode(shorter).alias("m")).select(
        "word", "m", F.explode(F.array(F.lit(False), F.lit(True))).alias("back")
    )
    half = F.floor(F.col("m") / 2).cast("int")
    return each.select(
        "m",
        "back",
        F.when(F.col("back"), F.col("m") - half).otherwise(half).alias("same"),
        F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("seen"),
    ).withColumn("key", F.xxhash64("m", "back", F.col("seen").substr(F.lit(1), F.col("same"))))


def _split(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists of one more equal code point, and small lists of the words that differ just there."""
    at = F.col("same") + 1
    finer = lists.withColumn("same", at).withColumn("key", F.xxhash64("m", "back", F.col("seen").substr(F.lit(1), F.col("same"))))
    without = F.concat(F.col("seen").substr(F.lit(1), F.col("same")), F.col("seen").substr(at + 1, F.char_length("seen")))
    replaced = lists.where(F.char_length("seen") == F.col("m")).withColumn("rest", without).withColumn("how", F.lit("r"))
    longer = F.char_length("seen") > F.col("m")
    inserted = lists.withColumn("rest", F.when(longer, without).otherwise(F.col("seen"))).withColumn("how", F.lit("i"))
    apart = replaced.unionByName(inserted).withColumn("key", F.xxhash64("m", "back", "same", "how", "rest"))
    return finer, apart.drop("rest", "how")


def scan(words: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (query, found) of all words of one group that are exactly one edit apart.

    ``words`` are sorted within their groups, and groups stand together.
    """
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    width = int(lengths.max(initial=0)) + 2
    starts = np.cumsum(lengths) - lengths
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    padded = np.append(points, np.zeros(width + 1, np.uint32))

    def point(word: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.where((place >= 0) & (place < lengths[word]), padded[starts[word] + np.clip(place, 0, width)], 0)

    # LCP with the word before; -1 where a group begins.
    lcp = np.full(n + 1, -1, np.int64)
    alive = np.flatnonzero(group[1:] == group[:-1]) + 1
    lcp[alive] = 0
    depth = 0
    while len(alive):
        both = depth < np.minimum(lengths[alive], lengths[alive - 1])
        alive = alive[both]
        alive = alive[point(alive, np.full(len(alive), depth)) == point(alive - 1, np.full(len(alive), depth))]
        depth += 1
        lcp[alive] = depth
    # A frontier entry is a run of the list (first word, end) beside a query, with the band
    # D(depth, depth - 1), D(depth, depth), D(depth, depth + 1) of the common prefix.
    begins = np.flatnonzero(lcp[:n] < 0)
    ends = np.append(begins[1:], n)
    mine = np.searchsorted(begins, np.arange(n), side="right") - 1
    query, first, end = np.arange(n), begins[mine], ends[mine]
    band = np.tile(np.array([2, 0, 1], np.int8), (n, 1))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0
    while len(query):
        # The words that end here come first in their run; equal words occur once.
        done = lengths[first] == depth
        gap = lengths[query] - depth
        hit = done & (np.abs(gap) <= 1)
        hit[hit] = band[hit, gap[hit] + 1] == 1
        found.append((query[hit], first[hit]))
        first = first + done
        some = first < end
        query, first, end, band = query[some], first[some], end[some], band[some]
        if not len(query):
            break
        # Runs are cut where neighbours differ at this place.
        cuts = np.flatnonzero(lcp[:n] <= depth)
        low = np.searchsorted(cuts, first, side="right")
        high = np.searchsorted(cuts, end, side="left")
        pieces = high - low + 1
        row = np.repeat(np.arange(len(query)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cut = np.append(cuts, n)
        left = np.where(nth == 0, first[row], cut[np.minimum(low[row] + nth - 1, len(cuts))])
        right = np.where(nth == pieces[row] - 1, end[row], cut[np.minimum(low[row] + nth, len(cuts))])
        query, band, c = query[row], band[row].astype(np.int64), point(left, np.full(len(left), depth))
        m = lengths[query]

        def cell(diagonal: np.ndarray, place: int) -> np.ndarray:
            """The diagonal step onto column ``place + 1`` of the query."""
            inside = (place >= 0) & (place < m)
            return np.where(inside, diagonal + (point(query, np.full(len(query), place)) != c), 2)

        lower = np.minimum(cell(band[:, 0], depth - 1), np.where(depth <= m, band[:, 1] + 1, 2))
        middle = np.minimum(cell(band[:, 1], depth), np.where(depth + 1 <= m, np.minimum(band[:, 2], lower) + 1, 2))
        upper = np.minimum(cell(band[:, 2], depth + 1), np.where(depth + 2 <= m, middle + 1, 2))
        band = np.minimum(np.stack([lower, middle, upper], axis=1), 2).astype(np.int8)
        near = band.min(axis=1) <= 1  # all others: the run's shared prefix is too far away
        query, first, end, band = query[near], left[near], right[near], band[near]
        depth += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def _scanned(lists: DataFrame) -> DataFrame:
    """word, near: the pairs of every list whose shorter word has the list's ``m`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: np.ndarray, seen: pa.Array, m: np.ndarray, back: np.ndarray) -> pa.RecordBatch:
            again = np.concatenate([[False], key[1:] == key[:-1]])
            together = again | np.concatenate([again[1:], [False]])  # lists of one word have no pair
            at = np.flatnonzero(together)
            words = seen.take(pa.array(at)).to_pylist()
            m, back = m[at], back[at]
            a, b = scan(words, np.cumsum(~again[at]))
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            right = np.minimum(lengths[a], lengths[b]) == m[a]
            plain = [w[::-1] if r else w for w, r in zip(words, back.tolist())]
            columns = [pa.array([plain[i] for i in x[right].tolist()], pa.string()) for x in (a, b)]
            return pa.RecordBatch.from_arrays(columns, ["word", "near"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            start = 0
            key = batch.column("key").to_numpy()
            ends = np.flatnonzero(np.concatenate([key[1:] != key[:-1], [False]])) + 1
            sizes = np.cumsum(batch.column("points").to_numpy().astype(np.int64))
            if held and len(key) and held[-1].column("key")[-1].as_py() != key[0]:
                ends = np.concatenate([[0], ends])
            base = 0
            for e in ends.tolist():
                upto = int(sizes[e - 1]) if e else 0
                if size + upto - base >= _STEP:
                    whole = pa.Table.from_batches([*held, batch.slice(start, e - start)]).combine_chunks()
                    held, size, start, base = [], 0, e, upto
                    yield pairs(*_columns(whole))
            rest = batch.slice(start)
            if rest.num_rows:
                held.append(rest)
                size += int(sizes[-1]) - base
        if held:
            yield pairs(*_columns(pa.Table.from_batches(held).combine_chunks()))

    sized = lists.select("key", "seen", "m", "back", F.char_length("seen").alias("points"))
    # A range of keys could be cut by no key's size; a hash sends a whole list to one task.
    return sized.repartition("key").sortWithinPartitions("key", "seen").mapInArrow(run, "word string, near string")


def _columns(whole: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    chunk = lambda name: whole.column(name).combine_chunks()
    return (
        chunk("key").to_numpy(),
        chunk("seen"),
        chunk("m").to_numpy().astype(np.int64),
        chunk("back").to_numpy(zero_copy_only=False),
    )


def near_pairs(words: DataFrame, *, min_length: int = 5, most: int = 4096) -> DataFrame:
    """word, near: each two words exactly one edit apart, both ways round. ``words`` is read often."""
    if most < 512:
        raise ValueError("a list of words that agree in m code points may hold an alphabet and one more")
    lists = _lists(words.select("word"), min_length)
    fitting = []
    while True:
        large = lists.groupBy("key").count().where(F.col("count") > most).select("key")
        large = staged(large, "long-lists")
        if large.isEmpty():
            break
        if sizing.broadcastable({"large": large}):
            large = F.broadcast(large)
        fitting.append(lists.join(large, "key", "left_anti"))
        lists, apart = _split(lists.join(large, "key", "left_semi"))
        fitting.append(apart)
        lists = staged(lists, "finer-lists")
    for more in fitting:
        lists = lists.unionByName(more)
    return _scanned(lists).distinct()


def grouped(words: DataFrame, *, ratio: int = 2, min_length: int = 5, most: int = 4096) -> DataFrame:
    """word, form, root, n, n_near, form_n of a written vocabulary (word, n)."""
    pairs = staged(near_pairs(words, min_length=min_length, most=most), "near-words")
    counted = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The commonest first, then the first in code-point order.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    found = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(found, "word", "left")
    common = -F.col("best.less") >= ratio * F.col("n")
    formed = staged(
        joined.select(
            "word",
            F.when(common, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "formed-words",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(points: DataFrame) -> DataFrame:
    """word, root: where each pointer leads in the end. Each round doubles the steps taken."""
    points = staged(points, "pointers")
    while True:
        further = points.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(salted_join(points, further, ["root"], _SALTS, ["word"]).select("word", F.col("next").alias("root")), "moved-pointers")
        if moved.isEmpty():
            return points
        points = staged(points.join(moved.select("word"), "word", "left_anti").unionByName(moved), "pointers")


def spelling_variants(docs: DataFrame, *, min_length: int = 5, min_count: int = 3, ratio: int = 2, most: int = 4096) -> DataFrame:
    """Each word of the corpus with the commoner word it is a variant of, and where such steps end."""
    words = staged(vocabulary(docs, min_length=min_length, min_count=min_count), "vocabulary")
    return grouped(words, ratio=ratio, min_length=min_length, most=most)
