"""Spelling variants, repeated byte strings and vector codes beside plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import queries, spelling, suffix_dedup, vector_codes

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= min_count}
    # Candidates share what is left without one code point; each is compared in full.
    places = {}
    for w in n:
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            places.setdefault(rest, set()).add(w)
    near = {w: set() for w in n}
    for some in places.values():
        for a in some:
            near[a] |= {b for b in some if one_edit(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


SPELLING = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_variants_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = rows_of(queries.op11_spelling_variants(spark, SF_DIR), *SPELLING)
    want = variants([tuple(r) for r in docs.collect()])
    assert got == want and sum(w[1] is not None for w in want) > 10


def test_spelling_variants_of_odd_texts(spark):
    rng = random.Random(3)
    base = ["maison", "maisons", "masion", "maisön", "house", "houses", "hause", "Straße", "xabcdef"]
    rows = [(i % 50 if i % 7 else None, " ".join(rng.choices(base, k=12))) for i in range(120)]
    rows += [(1, None), (2, ""), (3, "12 -- ?"), (4, "x" * 30_000 + " " + "y" * 4 + "Éé́é")] * 3
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert rows_of(spelling.spelling_variants(docs), *SPELLING) == variants(rows)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_long_lists_of_words_are_split(spark):
    rng = random.Random(4)
    words = sorted({"prefixed" + "".join(rng.choices("abc", k=rng.randint(3, 7))) for _ in range(3000)})
    counts = {w: rng.choice([1, 2, 5, 40]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows_of(spelling.near_pairs(table, most=512), "word", "near")
    index = {}
    for w in words:
        for rest in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            index.setdefault(rest, []).append(w)
    want = {(a, b) for some in index.values() for a in some for b in some if one_edit(a, b)}
    assert got == sorted(want, key=repr)
    assert spelling._lists(table, 5).groupBy("key").count().agg(F.max("count")).first()[0] > 512


def test_spelling_scan_finds_all_pairs_of_a_group():
    rng = random.Random(1)
    for _ in range(100):
        groups = [sorted({"".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 30))}) for _ in range(3)]
        words, group = [w for g in groups for w in g], np.repeat(np.arange(3), [len(g) for g in groups])
        a, b = spelling.scan(words, group)
        want = [(i, j) for i, v in enumerate(words) for j, w in enumerate(words) if group[i] == group[j] and one_edit(v, w)]
        assert sorted(zip(a.tolist(), b.tolist())) == want


def cut_by_hand(rows, length):
    seen, out = set(), []
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    for doc_id, text in sorted(rows, key=key):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (not at or not gone[at - 1]) for at, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, kept))
    return sorted(out, key=repr)


CUT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


def cut(spark, rows, parts=3, **options):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, start int, ord string")
    return [(*r[:4], bytes(r[4])) for r in rows_of(suffix_dedup.deduplicated(docs.repartition(parts), **options), *CUT)]


@pytest.mark.parametrize("most", [2048, 3])
def test_repeated_strings_of_texts_that_share_passages(spark, most):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(80):
        own = [" ".join(word() for _ in range(rng.randint(0, 20))) for _ in range(3)]
        rows.append((i, own[0] + rng.choice(passages) + own[1] + rng.choice(passages)[: rng.randint(0, 200)] + own[2]))
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [(2000, "a" * 900), (2001, "ab" * 300 + "a" * 400), (2002, "é" * 260)]
    want = cut_by_hand(rows, 100)
    assert cut(spark, rows, most=most) == want and sum(w[2] > 0 for w in want) > 60


def test_repeated_strings_of_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, "other " + text), (None, text[:150]), (None, text[:150]), (2, None), (2, ""), (3, "short"), (3, "short"), (4, text[50:149]), (4, text[50:150])]
    assert cut(spark, rows) == cut_by_hand(rows, 100)
    assert cut(spark, rows, length=20, gram=6) == cut_by_hand(rows, 20)
    assert cut(spark, [], 1) == []


def test_texts_longer_than_one_step(spark):
    rng = random.Random(6)
    long = "".join(rng.choices("abcdefgh ", k=1_300_000))
    rows = [(1, long), (2, "x" + long[500_000:1_100_000] + "y"), (3, long[:700_000] + long[600_000:700_000])]
    # Nothing of a text of random letters repeats by chance, so the cuts are known.
    want = [(1, len(long), 0, 0), (2, 600_002, 600_000, 1), (3, 800_000, 800_000, 1)]
    got = cut(spark, rows)
    assert [g[:4] for g in got] == want and [g[4] for g in got] == [long.encode(), b"xy", b""]


def test_a_collision_is_found_by_its_bytes():
    rows = [b"abgram12", b"abgram13", b"abgram12"]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.array([0, 8, 16, 24])
    args = (np.zeros(3, np.int64), data, offsets, np.array([1, 1, 1]), np.array([2, 2, 2]), 8)

    class Colliding(suffix_dedup.PrefixHashes):
        def of(self, start, length):
            return np.zeros(len(start), np.uint64)

    assert suffix_dedup.repeats(*args, Colliding(64, 1)).sum(axis=1).tolist() == [0, 0, 1]


def lloyd(rows, parts, entries, rounds, scale):
    """Every round compares all parts with all entries, in Python integers."""
    import math

    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    width = len(kept[0][2]) // parts
    book = [[min(v for i, _, v in kept if i == k)[p * width : (p + 1) * width] for k in ids] for p in range(parts)]

    def assign():
        found = []
        for _, _, v in kept:
            cells = [v[p * width : (p + 1) * width] for p in range(parts)]
            found.append([min((sum((a - b) ** 2 for a, b in zip(c, e)), j) for j, e in enumerate(book[p])) for p, c in enumerate(cells)])
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(ids)):
                mine = [v[p * width : (p + 1) * width] for (_, _, v), f in zip(kept, found) if f[p][1] == j]
                if mine:
                    book[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    total = Counter()
    for (_, lab, _), e in zip(kept, error):
        total[lab] += e
    text = ",".join(str(x) for p in book for e in p for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{j:02x}" for _, j in f), e, total[lab], sha) for (i, lab, _), f, e in zip(kept, found, error)), key=repr
    )


CODES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def test_vector_codes_of_odd_rows(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([0, 1, None]), [rng.uniform(-2, 2) for _ in range(8)]) for i in range(300)]
    rows += rows[:5] + [(3, 9, [0.5] * 8), (None, None, [1.0] * 8), (None, 2, [-1.0] * 8)]
    rows += [(900, 1, [rng.choice([0.0, 0.25, 0.5])] * 8) for _ in range(40)]  # ties
    dropped = [(0, 1, None), (1, 1, [1.0] * 7 + [None]), (2, 1, [float("nan")] * 8), (901, 1, [float("inf")] * 8), (902, 1, [1.0] * 5), (903, 1, [])]
    schema = "vec_id long, label int, embedding array<double>, code int, v string"
    table = spark.createDataFrame([(*r, 7, "x") for r in rows + dropped], schema).repartition(4)
    got = rows_of(vector_codes.digest(*vector_codes.coded(table, parts=4, entries=6, rounds=5)), *CODES)
    assert got == lloyd(rows, 4, 6, 5, 4096)
    few = spark.createDataFrame([(*r, 7, "x") for r in rows[:3]], schema)
    assert rows_of(vector_codes.digest(*vector_codes.coded(few, parts=4)), *CODES) == lloyd(rows[:3], 4, 16, 6, 4096)
    assert vector_codes.digest(*vector_codes.coded(table.limit(0))).count() == 0
    nameless = vector_codes.digest(*vector_codes.coded(table.where("vec_id IS NULL"), parts=4)).collect()
    assert [r.code for r in nameless] == [None, None]


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(8)
    part = rng.integers(-5, 6, (400, 3))
    book = rng.integers(-5, 6, (7, 3))
    everything = np.ones(7, bool)
    code, distance = vector_codes.nearest(part, book, everything, None, None)
    for moved in ([2], [0, 6], [], [1, 3, 5]):
        new = book.copy()
        new[moved] = rng.integers(-5, 6, (len(moved), 3))
        mask = (new != book).any(axis=1)
        got = vector_codes.nearest(part, new, mask, code, distance)
        want = vector_codes.nearest(part, new, everything, None, None)
        assert all((g == w).all() for g, w in zip(got, want))
