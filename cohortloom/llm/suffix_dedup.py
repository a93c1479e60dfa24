"""Removing repeated byte strings: a suffix sort that compares by hash, where strings can meet.

A window is a string of ``length`` bytes inside one text. A byte goes if a window that covers it
also starts earlier: in a document of smaller id, or further left in the same one.

1. Anchors. A window's anchor is the gram (``gram`` bytes) of least hash in it, the leftmost if equal. It depends
   on the window's bytes alone, so equal windows have equal anchors at equal places. Neighbouring
   windows with one anchor are one row: the gram's hash, and a fingerprint of all bytes they cover.
2. Classes. Rows with the same gram and fingerprint have the same windows: all but the earliest
   row's go. Rows whose gram occurs once are done. Spark counts and joins these rows, with partial sums, so that
   a passage of a third of all documents is as many rows as tasks have seen.
3. Suffix sort. What is left, the earliest rows of classes that share a gram and differ elsewhere (at the
   ends of passages, around edits), fetch their bytes. Rows of a gram are sorted as suffixes from the gram on, by a mergesort whose
   comparisons find the common extension by binary search over prefix polynomial hashes. In sorted order
   equal windows are neighbours; the bytes to the left are compared by hash as well. Every extension that
   decides something is then compared byte by byte; on a collision the step is done by bytes alone.
4. Grams with more than ``most`` such rows are not sorted in one task: their windows are
   counted by Spark by a 128-bit hash each, the earliest stays.

Fingerprints in 2 and 4 have 128 bits of two independent hashes, and are not compared further.

Defined results: a null text is empty; a null id is before all others; a text shorter than
``length`` loses nothing; with a repeated id, the texts of that id are ordered by their SHA-256, and of equal rows
one is the earlier. No row gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import byte_view, gather, mixed, steps
from cohortloom.operators import sizing
from cohortloom.operators.staging import staged

_CHUNK = 1 << 19  # bytes hashed at once
_PLACE = np.uint64((1 << 20) - 1)
_FIRST = -(1 << 63)
_ROWS = "key long, ctx long, ord long, start int, windows int, skip int, again boolean"


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all substrings of up to ``size`` bytes."""

    def __init__(self, size: int, seed: int):
        values = mixed(np.arange(1, 259, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        base = int(values[256]) & ~7 | 5
        self._letters = values[:256] | np.uint64(1)
        self._up, self._down = np.ones(size + 1, np.uint64), np.ones(size + 1, np.uint64)
        np.cumprod(np.full(size, base, np.uint64), out=self._up[1:])
        np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64), out=self._down[1:])

    def read(self, data: np.ndarray) -> None:
        terms = self._letters[data]
        terms *= self._up[: len(data)]
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])

    def all_of(self, length: int) -> np.ndarray:
        """Of every substring of that length."""
        found = self._sums[length:] - self._sums[: len(self._sums) - length]
        found *= self._down[: len(found)]
        return mixed(found)

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self._sums[start + length] - self._sums[start]) * self._down[start]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return values if reach == width else np.minimum(values[: len(values) - (width - reach)], values[width - reach :])


def anchored(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, hashes: tuple[PrefixHashes, PrefixHashes]) -> dict[str, np.ndarray]:
    """The rows of step 1 of texts that lie end to end in ``data``; places count from a text's begin."""
    found: list[tuple[np.ndarray, ...]] = []
    one, two = hashes
    inner = length - gram + 1
    step = _CHUNK - length
    for base in range(0, max(len(data) - length + 1, 0), step):
        some = data[base : base + step + length - 1]
        one.read(some)
        two.read(some)
        grams = one.all_of(gram)
        places = np.arange(len(grams), dtype=np.uint64)
        anchor = (_least((grams & ~_PLACE) | places, inner) & _PLACE).astype(np.int64)
        at = np.arange(len(anchor)) + base
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + length <= offsets[text + 1]
        at, anchor, text = at[inside], anchor[inside], text[inside]
        if not len(at):
            continue
        first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1)]))
        windows = np.diff(np.append(first, len(at)))
        start = at[first] - base
        skip = anchor[first] - start
        around = two.of(start, windows + length - 1)
        ctx = mixed(around ^ mixed((skip * (length + 1) + windows).astype(np.uint64)))
        found.append((grams[anchor[first]], ctx, text[first], at[first] - offsets[text[first]], windows, skip))
    names = ("key", "ctx", "text", "start", "windows", "skip")
    if not found:
        return {n: np.zeros(0, np.uint64 if n in ("key", "ctx") else np.int64) for n in names}
    rows = dict(zip(names, (np.concatenate(x) for x in zip(*found))))
    return rows


def _again(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Whether the same row (gram and fingerprint) has come before in the same text."""
    again = np.zeros(len(rows["key"]), bool)
    if len(again):
        order = np.lexsort((rows["start"], rows["ctx"], rows["key"], rows["text"]))
        same = np.ones(len(order) - 1, bool)
        for name in ("text", "key", "ctx"):
            same &= rows[name][order[1:]] == rows[name][order[:-1]]
        again[order[1:]] = same
    return again


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHashes(_CHUNK, 1), PrefixHashes(_CHUNK, 2)
        for whole in batches:
            for batch in steps(whole, "text", _CHUNK - length):
                data, offsets = byte_view(batch.column("text"))
                rows = anchored(data, offsets, length, gram, hashes)
                signed = {n: pa.array(rows[n].view(np.int64)) for n in ("key", "ctx")}
                small = {n: pa.array(rows[n].astype(np.int32)) for n in ("start", "windows", "skip")}
                columns = {**signed, "ord": batch.column("ord").take(pa.array(rows["text"])), **small, "again": pa.array(_again(rows))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select("ord", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, _ROWS)


def suffix_order(groups: np.ndarray, begin: np.ndarray, size: np.ndarray, data: np.ndarray, hashes: PrefixHashes) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ``data[begin:begin + size]`` sorted inside each group (groups stand together), and the
    common extension of each with the one before it in its group (else 0)."""
    n = len(groups)
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, n))
    head, count = np.repeat(heads, counts), np.repeat(counts, counts)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(a), np.int64), np.minimum(size[a], size[b])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = hashes.of(begin[a], middle) == hashes.of(begin[b], middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before suffix b; equal ones in the order given."""
        k = common(a, b)
        ended_a, ended_b = k == size[a], k == size[b]
        x = data[np.minimum(begin[a] + k, len(data) - 1)]
        y = data[np.minimum(begin[b] + k, len(data) - 1)]
        return np.where(ended_a | ended_b, np.where(ended_a & ended_b, a < b, ended_a), x < y)

    order, width = np.arange(n), 1
    place = np.arange(n) - head  # of the element at each position of ``order``, in its group
    while n and width < counts.max():
        at = np.flatnonzero(count > width)  # groups that are sorted already take no part
        run = place[at] // width
        other = head[at] + (run ^ 1) * width
        low = np.zeros(len(at), np.int64)
        high = np.clip(head[at] + count[at] - other, 0, width)
        mine = order[at]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            smaller = before(order[other[open_] + middle], mine[open_])
            low[open_] = np.where(smaller, middle + 1, low[open_])
            high[open_] = np.where(smaller, high[open_], middle)
        target = head[at] + (run // 2) * 2 * width + place[at] % width + low
        merged = order.copy()
        merged[target] = mine
        order = merged
        width *= 2
    extension = np.zeros(n, np.int64)
    inner = np.flatnonzero(np.arange(n) != head)
    extension[inner] = common(order[inner - 1], order[inner])
    return order, extension


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    return bool((data[gather(a, size)] == data[gather(b, size)]).all())


def repeats(groups: np.ndarray, data: np.ndarray, offsets: np.ndarray, windows: np.ndarray, skip: np.ndarray, length: int, hashes: PrefixHashes) -> np.ndarray:
    """Which windows have an equal one in an earlier row of the group: (rows, anchor's place in the window).

    Row i covers ``data[offsets[i]:offsets[i + 1]]``, its gram begins ``skip[i]`` bytes later, and the rows
    of a group are in the order of their documents and places.
    """
    n, inner = len(groups), int(skip.max(initial=0)) + 1
    gone = np.zeros((n, inner), bool)
    hashes.read(data)
    begin, size = offsets[:-1] + skip, np.diff(offsets) - skip
    order, extension = suffix_order(groups, begin, size, data, hashes)
    linked = np.flatnonzero(extension)
    if not _same_bytes(data, begin[order[linked]], begin[order[linked - 1]], extension[linked]):
        return repeats_by_bytes(groups, data, offsets, windows, skip, length)
    apart = np.concatenate([[True], groups[1:] != groups[:-1]]) if n else np.zeros(0, bool)
    checked = np.full(n, -1)
    for k in range(inner - 1, -1, -1):  # the anchor stands k bytes into the window
        runs = np.cumsum((extension < length - k) | apart)
        holds = (k <= skip[order]) & (k > skip[order] - windows[order])
        row, run = order[holds], runs[holds]
        left = hashes.of(begin[row] - k, np.full(len(row), k))
        by = np.lexsort((row, left, run))
        row, run, left = row[by], run[by], left[by]
        head = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (left[1:] != left[:-1])])) if len(row) else np.zeros(0, np.int64)
        witness = np.repeat(row[head], np.diff(np.append(head, len(row))))
        later = witness != row
        # A longer left side was compared with the same row's already.
        fresh = later & (checked[row] != witness)
        a, b = row[fresh], witness[fresh]
        if not _same_bytes(data, begin[a] - k, begin[b] - k, np.full(len(a), k)):
            return repeats_by_bytes(groups, data, offsets, windows, skip, length)
        checked[:] = -1
        checked[row[later]] = witness[later]
        gone[row[later], k] = True
    return gone


def repeats_by_bytes(groups: np.ndarray, data: np.ndarray, offsets: np.ndarray, windows: np.ndarray, skip: np.ndarray, length: int) -> np.ndarray:
    """As ``repeats``, by comparing bytes only."""
    gone = np.zeros((len(groups), int(skip.max(initial=0)) + 1), bool)
    raw, seen = data.tobytes(), set()
    for i, group in enumerate(groups.tolist()):
        for w in range(int(windows[i])):
            at = int(offsets[i]) + w
            key = (group, int(skip[i]) - w, raw[at : at + length])
            gone[i, key[1]] |= key in seen
            seen.add(key)
    return gone


def _sorted_out(rows: DataFrame, length: int) -> DataFrame:
    """Cuts (ord, start, stop) of the rows' windows that repeat, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHashes(2 * _CHUNK, 3)

        def cuts(table: pa.Table) -> pa.RecordBatch:
            column = {c: table.column(c).combine_chunks() for c in table.column_names}
            number = {c: column[c].to_numpy().astype(np.int64) for c in ("key", "ord", "start", "windows", "skip")}
            data, offsets = byte_view(column["bytes"])
            key = number["key"]
            groups = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            gone = repeats(groups, data, offsets, number["windows"], number["skip"], length, hashes)
            edge = np.diff(np.pad(gone.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, low = np.nonzero(edge == 1)
            high = np.nonzero(edge == -1)[1] - 1
            anchor = number["start"][row] + number["skip"][row]
            columns = [number["ord"][row], anchor - high, anchor - low + length]
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(c, pa.int32()) for c in columns[1:])], ["ord", "start", "stop"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            sizes = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(zero_copy_only=False).astype(np.int64))
            ends = np.flatnonzero(key[1:] != key[:-1]) + 1
            if held and held[-1].column("key")[-1].as_py() != key[0]:
                ends = np.concatenate([[0], ends])
            start = base = 0
            for e in ends.tolist():
                upto = int(sizes[e - 1]) if e else 0
                if size + upto - base >= _CHUNK // 2:
                    yield cuts(pa.Table.from_batches([*held, batch.slice(start, e - start)]))
                    held, size, start, base = [], 0, e, upto
            if start < batch.num_rows:
                held.append(batch.slice(start))
                size += int(sizes[-1]) - base
        if held:
            yield cuts(pa.Table.from_batches(held))

    return rows.repartition("key").sortWithinPartitions("key", "ord", "start").mapInArrow(run, "ord long, start int, stop int")


def _fetched(docs: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """The bytes of the open rows (kind 0); of hot grams, instead, the hash of every window (kind 1) and the
    cuts of those that repeat inside their document (kind 2, ``start`` to ``start + windows``)."""
    schema = "kind int, key long, ord long, start int, windows int, skip int, bytes binary, other long"
    wanted = F.collect_list(F.struct("key", "start", "windows", "skip", "hot")).alias("wanted")
    joined = docs.join(rows.groupBy("ord").agg(wanted), "ord").select("ord", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = PrefixHashes(_CHUNK, 4), PrefixHashes(_CHUNK, 5)

        def out(kind, key, ord_, start, windows, skip, data, other):
            n = len(start)
            same = lambda x: pa.array(np.full(n, x, np.int64))
            columns = [
                pa.array(np.full(n, kind), pa.int32()), pa.array(key.view(np.int64)), same(ord_), pa.array(start, pa.int32()),
                pa.array(windows, pa.int32()), pa.array(skip, pa.int32()), data, pa.array(other.view(np.int64)),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

        for whole in batches:
            lists = whole.column("wanted")
            for i in range(whole.num_rows):
                ord_, raw = whole.column("ord")[i].as_py(), whole.column("text")[i].as_buffer()
                data = np.frombuffer(raw, np.uint8)
                rows_ = lists[i].values
                field = {c: rows_.field(c).to_numpy(zero_copy_only=False) for c in ("key", "start", "windows", "skip", "hot")}
                by = np.argsort(field["start"], kind="stable")
                key, start, windows, skip = (field[c][by].astype(np.int64) for c in ("key", "start", "windows", "skip"))
                hot = field["hot"][by].astype(bool)
                if (~hot).any():
                    a, b = start[~hot], windows[~hot] + length - 1
                    pieces = data[gather(a, b)]
                    ends = np.concatenate([[0], np.cumsum(b)]).astype(np.int32)
                    value = pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pieces.tobytes())])
                    yield out(0, key[~hot], ord_, a, windows[~hot], skip[~hot], value, np.zeros(len(a), np.int64))
                if hot.any():
                    at = np.unique(gather(start[hot], windows[hot]))
                    h, g = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
                    for base in range(0, len(data), _CHUNK - length):
                        some = np.flatnonzero((at >= base) & (at < base + _CHUNK - length))
                        if len(some):
                            for hashes, into in ((one, h), (two, g)):
                                hashes.read(data[base : base + _CHUNK])
                                into[some] = mixed(hashes.of(at[some] - base, np.full(len(some), length)))
                    order = np.lexsort((at, g, h))
                    same = np.concatenate([[False], (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] == g[order[:-1]])])
                    empty = lambda n: pa.nulls(n, pa.binary())
                    f, r = order[~same], order[same]
                    yield out(1, h[f], ord_, at[f], np.full(len(f), length), np.zeros(len(f)), empty(len(f)), g[f])
                    yield out(2, h[r], ord_, at[r], np.full(len(r), length), np.zeros(len(r)), empty(len(r)), g[r])

    return joined.mapInArrow(run, schema)


def repeated_cuts(docs: DataFrame, *, length: int = 100, gram: int = 40, most: int = 2048) -> DataFrame:
    """Cuts (ord, start, stop) that cover exactly the bytes to remove. ``docs`` has ``ord``, unique and in
    the order of documents, and ``text``; it is read three times."""
    if not 0 < gram < length:
        raise ValueError("a gram is shorter than a window")
    if most * 2 * length > _CHUNK:
        raise ValueError("the rows of one gram must fit in one step")
    anchors = staged(anchor_rows(docs, length, gram), "anchors")
    live = anchors.where("NOT again")
    keys = live.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.min("ctx") < F.max("ctx")).alias("several"))
    # Written first, so that the shuffle of the counts is gone when the rows themselves are shuffled.
    keys = staged(keys.where("n > 1").select("key", "several"), "shared-grams")
    shared = staged(live.drop("again").join(keys, "key"), "shared-anchors")
    classes = shared.groupBy("key", "ctx").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n"))
    classed = shared.join(classes, ["key", "ctx"])
    rows = staged(
        classed.where("several OR n > 1").select(
            "key", "ord", "start", "windows", "skip", (F.col("ord") == F.col("first")).alias("earliest"), "several"
        ),
        "classed-anchors",
    )
    stop = (F.col("start") + F.col("windows") + F.lit(length - 1)).cast("int").alias("stop")
    cuts = anchors.where("again").select("ord", "start", stop)
    cuts = cuts.unionByName(rows.where("NOT earliest").select("ord", "start", stop))

    unsettled = rows.where("earliest AND several").select("key", "ord", "start", "windows", "skip")
    hot = staged(unsettled.groupBy("key").count().where(F.col("count") > most).select("key", F.lit(True).alias("hot")), "hot-grams")
    if sizing.broadcastable({"hot": hot}):
        hot = F.broadcast(hot)
    marked = unsettled.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    fetched = staged(_fetched(docs, marked, length), "open-windows")
    cuts = cuts.unionByName(_sorted_out(fetched.where("kind = 0").drop("kind", "other"), length))
    each = fetched.where("kind = 1").select("key", "other", "ord", "start")
    firsts = each.groupBy("key", "other").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = each.join(firsts, ["key", "other"]).where(F.col("ord") > F.col("first"))
    inside = fetched.where("kind = 2")
    for more in (later, inside):
        cuts = cuts.unionByName(more.select("ord", "start", (F.col("start") + length).alias("stop")))
    return cuts


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc_id, ord and text of each distinct document; and, where ids repeat, how often each occurs."""
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    plain = docs.select(F.col("doc_id").cast("long"), ids.alias("ord"), "text")
    if plain.groupBy("ord").count().where("count > 1").isEmpty():
        return plain, None
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    known = plain.select("doc_id", "text", digest.alias("digest"))
    counted = known.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    ordered = staged(
        counted.orderBy(F.col("doc_id").asc_nulls_first(), "digest").withColumn("ord", F.monotonically_increasing_id()),
        "document-order",
    )
    one = known.groupBy("doc_id", "digest").agg(F.any_value("text").alias("text"))
    same = F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("t.digest") == F.col("o.digest"))
    distinct = one.alias("t").join(ordered.alias("o"), same).select("t.doc_id", "o.ord", "t.text")
    return staged(distinct, "distinct-documents"), ordered.select("ord", "copies")


def deduplicated(docs: DataFrame, *, length: int = 100, gram: int = 40, most: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the text's remaining bytes, of each row."""
    texts, copies = _numbered(docs)
    cuts = staged(repeated_cuts(texts, length=length, gram=gram, most=most), "cuts")
    wanted = cuts.groupBy("ord").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))  # as many as a text has anchors
    joined = texts.join(wanted, "ord", "left")
    if copies is not None:
        joined = joined.join(copies, "ord")
    else:
        joined = joined.withColumn("copies", F.lit(1).cast("long"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, copies long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, "text"):
                sizes, removed, spans, kept = [], [], [], []
                lists, texts_ = batch.column("cuts"), batch.column("text")
                for i in range(batch.num_rows):
                    value = texts_[i]
                    raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                    pieces, at, n = [], 0, 0
                    if lists[i].is_valid:
                        rows = lists[i].values
                        start, stop = rows.field("start").to_numpy(), rows.field("stop").to_numpy()
                        by = np.argsort(start, kind="stable")
                        start, stop = start[by], np.maximum.accumulate(stop[by])
                        head = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
                        for a, b in zip(start[head].tolist(), stop[np.append(head[1:], len(stop)) - 1].tolist()):
                            pieces.append(raw[at:a])
                            at, n = b, n + 1
                    pieces.append(raw[at:])
                    rest = b"".join(pieces)
                    sizes.append(len(raw))
                    removed.append(len(raw) - len(rest))
                    spans.append(n)
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), batch.column("copies")],
                    [c.split()[0] for c in schema.split(", ")],
                )

    done = joined.select("doc_id", "text", "cuts", "copies").mapInArrow(cut, schema)
    if copies is None:
        return done.drop("copies")
    # Equal rows beyond the first start later in all their windows.
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    each = done.withColumn("nth", nth)
    whole = (F.col("nth") > 1) & (F.col("n_bytes") >= length)
    return each.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
    )
