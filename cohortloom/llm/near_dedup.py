"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full sets.

A document's set is its distinct shingles of five words (fewer words: the whole
sequence as one). Two collections of half keys are made, each key from two
minhashes; a table key is one half key of either collection, so ``halves`` x
``halves`` tables of four minhashes each cost 4 x ``halves`` minhashes. Documents of
similarity s agree in some table with probability (1 - (1 - s^2)^halves)^2, which
is over 0.9999 at 0.75 for the default of 12.

Documents with equal sets are one class, found by a hash of the set, and only classes
go on. Half keys that one class alone has cannot make a common table key and are
left out before the pairing. In a bucket every class is compared with the
smallest one, and, unless that has joined them, with the largest one. Classes of buckets that still hold several components after that are
compared if they share one of their rarest shingles (the prefix filter, which loses
no pair). So a group of copies of any size costs a row per copy and table, not
a row per pair. Documents with rare shingles of their own cost no pair for a common passage; where
all shingles are common (texts of a few stock passages), pairs to verify grow with the square of that group.
A confirmed link means 100 * intersection >= 75 * union on the full sets.

Defined results: null, empty and blank texts have the empty set and are linked with
nothing. Equal rows have equal sets, so they share a component. A null doc_id is never
a component's id unless all its ids are null. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import giving_back, mixed, numbered, split_words, steps, string_hashes, text_key
from cohortloom.operators import sizing
from cohortloom.operators.staging import staged

_MULTIPLIER = np.uint64(0x9DDFEA08EB382D69)
_SHINGLED = "doc_id long, text_key long, n_shingles long, class binary, keys array<long>"


def shingle_sets(texts: pa.Array, words_each: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, bounds = split_words(texts)
    distinct, index = numbered(words)
    h = string_hashes(distinct)[index] if len(index) else np.zeros(0, np.uint64)
    rolled = h.copy()
    for j in range(1, min(words_each, len(h))):
        rolled[:-j] = rolled[:-j] * _MULTIPLIER + h[j:]
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words_each:
            sets.append(np.unique(rolled[a : b - words_each + 1]))
        elif b > a:
            code = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                code = mixed(code * _MULTIPLIER + h[i : i + 1])
            sets.append(code)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def half_keys(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``count`` half keys (columns) of each non-empty set, from two minhashes each."""
    keys = np.empty((len(starts), count), np.int64)
    for j in range(count):
        least = []
        for r in (2 * j, 2 * j + 1):
            a, b = mixed(np.array([2 * r + 1, 2 * r + 2], np.uint64))
            hashed = values * (a | np.uint64(1)) + b
            hashed ^= hashed >> np.uint64(29)
            least.append(np.minimum.reduceat(hashed * _MULTIPLIER, starts) if len(starts) else np.zeros(0, np.uint64))
        keys[:, j] = mixed(least[0] * _MULTIPLIER + mixed(least[1]) + np.uint64(j)).astype(np.int64)
    return keys


def shingled(docs: DataFrame, words_each: int, halves: int) -> DataFrame:
    """Per row: the size of its set, a 128-bit hash of it (null if empty), and its half keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text"):
                sets = shingle_sets(batch.column("text"), words_each)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                values = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[full]
                keys = half_keys(values, starts, 2 * halves)
                if len(full):
                    sums = [np.add.reduceat(x, starts) for x in (values, mixed(values ^ _MULTIPLIER))]
                    both = np.stack([mixed(sums[0] + sizes[full].astype(np.uint64)), sums[1]], axis=1)
                else:
                    both = np.zeros((0, 2), np.uint64)
                classes: list[bytes | None] = [None] * len(sets)
                for i, c in zip(full.tolist(), both):
                    classes[i] = c.tobytes()
                per_row = np.concatenate([[0], np.cumsum(np.where(sizes > 0, 2 * halves, 0))])
                arrays = [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes),
                    pa.array(classes, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), pa.array(keys.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_shingles", "class", "keys"])

    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").mapInArrow(giving_back(work), _SHINGLED)


def table_keys(classes: DataFrame, halves: int) -> DataFrame:
    """key, class and n: the tensored table keys that another class may share."""
    half = classes.select("class", "n", F.posexplode("keys").alias("slot", "half"))
    common = half.groupBy("slot", "half").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    found = half.join(common, ["slot", "half"], "left_semi")
    mine = found.groupBy("class", "n").agg(F.collect_list(F.struct("slot", "half")).alias("mine"))

    def pairs(mine: Column) -> Column:
        left = F.filter(mine, lambda x: x["slot"] < halves)
        right = F.filter(mine, lambda x: x["slot"] >= halves)
        key = lambda x, y: F.xxhash64(x["slot"], y["slot"], x["half"], y["half"])
        return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: key(x, y))))

    return mine.select(F.explode(pairs(F.col("mine"))).alias("key"), "class", "n")


def candidate_sets(classes: DataFrame, docs: DataFrame, words_each: int) -> DataFrame:
    """class and shingles (the full set) of the given classes, from one text of each."""
    owners = staged(classes.select("class", "doc_id", "text_key"), "candidate-classes")
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    if sizing.broadcastable({"owners": owners}):
        owners = F.broadcast(owners)  # the texts need not be shuffled
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_key") == F.col("r.text_key"))
    chosen = texts.alias("l").join(owners.alias("r"), same).select("r.class", "l.text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text"):
                sets = shingle_sets(batch.column("text"), words_each)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                values = np.concatenate(sets).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([batch.column("class"), lists], ["class", "shingles"])

    sets = staged(chosen.mapInArrow(giving_back(work), "class binary, shingles array<long>"), "candidate-sets")
    # A class comes twice if its document's row is repeated.
    repeats = not sets.groupBy("class").count().where("count > 1").isEmpty()
    return staged(sets.dropDuplicates(["class"]), "candidate-sets") if repeats else sets


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different ``root`` that may be similar enough.

    Order all shingles by how many sets have them, the rarest first. Sets of n <= m
    shingles that are similar enough share s * (n + m) / (1 + s) of them, so the first one
    they share is among the first n - 2 s n / (1 + s) + 1 of the smaller and the first
    m - s m + 1 of the larger, and enough shingles come after it in both. A common
    passage makes pairs only of sets in which it is among the rarest shingles.
    """
    rows = sets.select("class", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    spread = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("times"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    spread = spread.select("shingle", "times", (F.col("low") != F.col("high")).alias("mixed"))
    rarest = Window.partitionBy("class").orderBy("times", "shingle")
    kept = rows.join(spread, "shingle").withColumn("place", F.row_number().over(rarest))
    kept = kept.where(F.col("mixed") & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
    kept = staged(kept.select("shingle", "class", "root", "n", "place"), "prefixes")
    share = 2 * percent / (100 + percent)
    l = kept.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(share) - 1e-6) + 1).alias("l")
    r = kept.alias("r")
    smaller = (F.col("l.n") < F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.class") < F.col("r.class")))
    after = 1 + F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
    apart = (
        (F.col("l.shingle") == F.col("r.shingle"))
        & smaller
        & (F.col("l.root") != F.col("r.root"))
        & (100 * F.col("l.n") >= percent * F.col("r.n"))
        & ((100 + percent) * after >= percent * (F.col("l.n") + F.col("r.n")))
    )
    return l.join(r, apart).select(F.col("l.class").alias("a"), F.col("r.class").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root of the connected components of ``links`` (a, b), by alternating
    large and small stars; each round is written, so that lineage stays short."""
    edges = staged(_downward(links), "edges")
    before = None
    while True:
        after = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("node", "root")), F.lit(0))).first()
        if after == before or after[0] == 0:
            return edges
        before = after
        around = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = around.groupBy("node").agg(F.min("root").alias("least"))
        large = around.join(least, "node").where("root > node")
        large = large.select(F.col("root").alias("a"), F.least("least", "node").alias("b"))
        large = _downward(large)
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        small = small.select(F.col("root").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
        edges = staged(_downward(small), "edges")


def _downward(pairs: DataFrame) -> DataFrame:
    """Distinct pairs from the larger (node) to the smaller (root)."""
    return (
        pairs.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    )


def _placed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``members`` with the root of each class's component: itself before any link."""
    if roots is None:
        return members.withColumn("root", F.col("class"))
    found = members.join(roots, members["class"] == roots["node"], "left")
    return found.select("key", "class", "n", F.coalesce("root", "class").alias("root"))


def _open(placed: DataFrame, hub) -> DataFrame:
    """Buckets that hold several components, each with its smallest or largest class."""
    ends = (F.min("root").alias("low"), F.max("root").alias("high"))
    return placed.groupBy("key").agg(hub(F.struct("class", "n", "root")).alias("hub"), *ends).where("low <> high")


def _spokes(placed: DataFrame, hub, percent: int) -> DataFrame:
    """Each class of an open bucket with the bucket's hub, if sizes and components allow a new link."""
    near = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    rows = placed.join(_open(placed, hub), "key").where((F.col("root") != F.col("hub.root")) & near)
    return rows.select(F.col("hub.class").alias("a"), F.col("class").alias("b")).distinct()


def _joined(links: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if links is None else links.unionByName(more)


def near_duplicates(docs: DataFrame, *, words_each: int = 5, percent: int = 75, halves: int = 12) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of every row, and ``root``, which
    tells components apart also where ids repeat (null for the empty set)."""
    rows = staged(shingled(docs, words_each, halves), "shingled")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("class")
        .agg(first.alias("first"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
        .select("class", "first.doc_id", "first.text_key", "n", "keys")
    )
    classes = staged(classes, "classes")
    keys = staged(table_keys(classes, halves), "table-keys")

    found = keys.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    members = staged(keys.join(found.select("key"), "key", "left_semi"), "members")
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi")
    sets = candidate_sets(wanted, docs, words_each)

    roots, links = None, None
    for hub in (F.min, F.max):
        pairs = staged(_spokes(_placed(members, roots), hub, percent), "candidate-pairs")
        links = _joined(links, staged(confirmed(pairs, sets, percent), "links"))
        roots = components(links)
    # What is left: classes of buckets that still hold several components.
    placed = _placed(members, roots)
    loose = placed.join(_open(placed, F.min).select("key"), "key", "left_semi").select("class", "root").distinct()
    pairs = staged(prefix_pairs(sets.join(loose, "class"), percent), "candidate-pairs")
    more = staged(confirmed(pairs, sets, percent), "links")
    if not more.isEmpty():
        roots = components(_joined(links, more))

    linked = classes.select("class", "doc_id").join(roots, F.col("class") == F.col("node"), "left")
    linked = linked.select("class", "doc_id", F.coalesce("root", "class").alias("root"))
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = linked.join(least, "root").select("class", "root", "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    found = rows.join(named, "class", "left").select("doc_id", "text_key", "n_shingles", own.alias("component_id"), "root")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
