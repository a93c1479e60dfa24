"""Results that must not depend on layout, length, odd input or the number of languages; and the whole pipeline."""

from __future__ import annotations

import itertools
import random
import re
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import decontamination, language_id, lm_scoring, quality, queries, warc
from cohortloom.llm.common import remainder, table

SF_DIR = "/root/testdata/sf0.001"


def test_scores_of_the_language_model_do_not_depend_on_partitions(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    held = remainder("doc_id", 7) != 2
    found = []
    for parts in (2, 5):
        got = lm_scoring.score(docs.repartition(parts, "text"), held, known_words=2000, own_class=500, k=4, iterations=2)
        found.append({r.doc_id: r.score for r in got.collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) == docs.count()
    assert all(found[1][i] == pytest.approx(s, rel=1e-6) for i, s in found[0].items())


def test_language_model_of_few_texts(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (2, None)], "doc_id long, text string")
    got = lm_scoring.score(docs, F.lit(True), iterations=1).collect()
    assert len(got) == 2 and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scoring.score(docs.limit(0), F.lit(True), iterations=1).count() == 0


def test_marks_alone_are_no_letters(spark):
    known = spark.createDataFrame([(i, "the cat and the dog", "en") for i in range(5)], "doc_id long, text string, lang string")
    texts = ["❤️ 12", "́́", "", None, "❤️ the", "́cat"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language_id.label(rows, language_id.train(known)).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[4] == got[5] == ("en", 1.0)


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    for n, labels in ((1, 3), (4, 3), (6, 2), (5, 4)):
        scores, penalty = rng.normal(size=(n, labels)).astype(np.float32) * 2, 1.5
        worth = lambda path: sum(scores[i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731
        best = max(map(worth, itertools.product(range(labels), repeat=n)))
        whole = language_id.viterbi(scores, np.array([0, n]), penalty)
        sliced, _ = language_id.viterbi_in_slices(lambda a, b: (scores[a:b], np.ones(b - a, bool)), n, labels, penalty, 2)  # noqa: B023
        assert worth(whole) == pytest.approx(best) and (whole == sliced).all()


def test_many_languages_and_a_long_text_stay_small():
    rng = np.random.default_rng(4)
    names = tuple(f"l{i:03}" for i in range(160))
    model = language_id.Model(names, rng.normal(size=(1 << 12, 160)).astype(np.float32), np.ones((len(language_id.SCRIPTS), 160), bool), 12, 0)
    text = " ".join("".join(chr(97 + c) for c in word) for word in rng.integers(0, 26, (60_000, 8)))
    tracemalloc.start()
    language_id.predict(pa.array([text]), model, 8.0, spans=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    short = " ".join(text.split()[:300])
    plain = language_id.predict(pa.array([short]), model, 8.0, spans=True)
    sliced = language_id.predict(pa.array([short]), model, 8.0, spans=True, most=160 * 7)
    assert {k: v.to_pylist() for k, v in plain.items()} == {k: v.to_pylist() for k, v in sliced.items()}


def test_warc_headers_without_numbers_cost_only_their_record(spark, tmp_path):
    def record(name, *fields, length="5", block=b"hello"):
        lines = ["WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {name}", *fields, *([f"Content-Length: {length}"] if length is not None else [])]
        return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"

    page = b"HTTP/1.1 200 OK\r\n\r\nbody"
    good = [record(f"<good{i}>", f"X-Page-ID: {i}", length=len(page), block=page) for i in range(8)]
    bad = [
        record("<length>", length="abc"), record("<no length>", length=None), record("<negative>", length="-5"), record("<page>", "X-Page-ID: one"),
        record("<back>", "X-Refers-To-Page-ID: 1.5"), record("<huge>", "X-Page-ID: " + "9" * 30), record("<segment>", "WARC-Segment-Number: x"),
        record("<wide>", "WARC-Segment-Number: 99999999999"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(itertools.chain(*zip(bad, good))))
    got = Counter((r.record_id, r.status) for r in warc.read_archive(spark, str(tmp_path)).collect())
    want = {(f"<good{i}>", "ok"): 1 for i in range(8)}
    names = ("length", "no length", "negative", "page", "back", "huge", "segment", "wide")
    assert got == want | {(f"<{n}>", "bad header"): 1 for n in names}


QUESTION = "If Alice buys 12 kg of apples and gives 5 kg of them to Bob how many kg does Alice have left after 12 days"


def found_items(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.exact) for r in decontamination.contaminated(docs, asked, **options).collect())


def test_slots_agree_over_all_alignments_of_a_copy(spark):
    words = QUESTION.replace("Alice buys 12", "Carol buys 30").split()
    # Two inserted words part the copy in two pieces, in which one name and one number differ.
    parted = " ".join([*words[:15], "please", "say", *words[15:]]).replace("does Alice", "does Dan").replace("after 12", "after 99")
    agreeing = " ".join([*words[:15], "please", "say", *words[15:]]).replace("does Alice", "does Carol").replace("after 12", "after 30")
    twice = QUESTION.replace("12", "30") + " . " + QUESTION.replace("12", "40")
    assert found_items(spark, [parted, agreeing, twice], [QUESTION]) == [(1, 0, False), (2, 0, False)]


def test_items_in_scripts_without_spaces_and_numbers_in_words(spark):
    item = "小明有12个苹果他给了小红5个还剩几个"
    other = "天气很好我们明天去公园散步吧"
    assert found_items(spark, [f"前言部分{item}后面还有", other, item.replace("12", "30")], [item], verbatim=True) == [(0, 0, True), (2, 0, False)]
    worded = QUESTION.replace("12", "twelve").replace("5 kg", "five kg")
    assert found_items(spark, [worded], [QUESTION]) == [(0, 0, False)]


def plain_contaminated(text, item, window=8, literals=4, tokens=13):
    """The verbatim rule for texts of plain words and numbers inside one sentence, pair by pair."""
    cut = lambda t: [w for w in (re.sub(r"^\W+|\W+$", "", x).lower() for x in t.split()) if w]
    number = lambda w: w.isdigit()
    d, b = cut(text), cut(item)
    shifts = {}
    for i in range(len(d) - window + 1):
        for j in range(len(b) - window + 1):
            x, y = d[i : i + window], b[j : j + window]
            alike = all(p == q or (number(p) and number(q)) for p, q in zip(x, y))
            few = sum(not number(w) for w in y) < literals
            if x == y if few else alike:
                shifts.setdefault(i - j, {})[j] = {(q, p) for p, q in zip(x, y) if number(q)}
    places = [j for s in shifts.values() for j in s]
    units = list(shifts.values()) if len(places) > len(set(places)) else [{j: v for s in shifts.values() for j, v in s.items()}]
    for unit in units:
        pairs = set().union(*unit.values()) if unit else set()
        unsure = {q for q, n in Counter(q for q, _ in pairs).items() if n > 1}
        kept = [j for j, v in unit.items() if all(p == q for q, p in v) or not unsure & {q for q, _ in v}]
        if len({k for j in kept for k in range(j, j + window)}) >= min(tokens, len(b)):
            return True
    return False


def test_contamination_equals_brute_force(spark):
    rng = random.Random(9)
    vocabulary = ["red", "stone", "under", "water", "old", "house", "near", "green", "hill", "runs"]
    word = lambda: rng.choice(vocabulary) if rng.random() < 0.75 else str(rng.randint(1, 4))
    items = [" ".join(word() for _ in range(rng.randint(8, 26))) for _ in range(12)]
    texts = []
    for _ in range(120):
        tokens = rng.choice(items).split()
        tokens = tokens[rng.randint(0, 6) :] if rng.random() < 0.4 else tokens
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(tokens))
            tokens[at : at + rng.randint(0, 1)] = [word()]
        texts.append(" ".join([*(word() for _ in range(rng.randint(1, 9))), *tokens, *(word() for _ in range(5))]))
    want = sorted((d, i) for d, t in enumerate(texts) for i, b in enumerate(items) if plain_contaminated(t, b))
    got = [(d, i) for d, i, _ in found_items(spark, texts, items, verbatim=True)]
    assert got == want and 20 < len(want) < 200


def shingles(text):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_equals_its_stages_by_hand(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF_DIR, "documents")
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    kept, rows = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept[name] = stage(spark, rows, SF_DIR).collect()
        rows = spark.createDataFrame(kept[name], docs.schema)
        assert rows.columns == docs.columns
    ids = {name: {r.doc_id for r in some} for name, some in kept.items()}
    # Language: texts with a letter; all scripts of the table are learned.
    lettered = {r.doc_id for r in docs.collect() if any(unicodedata.category(c)[0] == "L" for c in r.text or "")}
    assert ids["language"] == lettered
    # Quality: the discriminant's score of what the stage before kept.
    before = spark.createDataFrame(kept["language"], docs.schema)
    labels = table(spark, SF_DIR, "labels").where(remainder("doc_id", 3) != 1)
    model = quality.train(quality.with_statistics(before.join(labels.select("doc_id"), "doc_id", "left_semi")), labels)
    scored = quality.score(before, model, "s").collect()
    assert ids["quality"] == {r.doc_id for r in scored if r.s >= 0.5}
    # Near duplicates: the least id of each component of all pairs.
    sets = {r.doc_id: shingles(r.text) for r in kept["quality"]}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert ids["near_duplicates"] == {i for i in sets if find(i) == i}
    # Decontamination: whole items as written never stay.
    left = {r.doc_id: " ".join((r.text or "").split()).lower() for r in kept["decontamination"]}
    items = [" ".join((r.text or "").split()).lower() for r in table(spark, SF_DIR, "benchmark").collect()]
    assert not any(i and i in t for i in items for t in left.values())
    gone = {r.doc_id: r.text for r in kept["near_duplicates"] if r.doc_id not in left}
    assert 0 < len(gone) < 0.2 * len(ids["near_duplicates"])
    # Packing: each kept text's ids, cut into pieces without a gap.
    plain = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r.doc_id: r.text for r in kept["decontamination"]}
    for doc_id, text in texts.items():
        encoded = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == doc_id)
        assert sum(p[1] for p in mine) == len(encoded) == mine[0][3]
        for start, length, crc, _ in mine:
            assert zlib.crc32(np.array(encoded[start : start + length], "<u4").tobytes()) == crc
    assert {p.doc_id for p in pieces} == set(texts)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
