"""The training-data operators: edge cases with defined results, and plain Python beside them."""

from __future__ import annotations

import gzip
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import chat, decontamination, language_id, lm_scoring, near_dedup, packing
from cohortloom.llm import quality, queries, token_counts, topk, warc
from cohortloom.llm.tokens import PartEncoder
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
DOCS = "doc_id long, text string, lang string, lang_pred int, score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long and repeated texts, repeated ids, columns named like results."""
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000))
    rows = [
        (1, None, "en", 1, "x"), (2, "", "en", 1, "x"), (3, " \t\n ", None, None, None), (4, long, "en", 1, "x"),
        (5, "one two three four five six", "en", 1, "x"), (5, "one two three four five six", "en", 1, "x"),
        (5, "another text of the same id", "fr", 1, "x"), (None, "no id at all here today", "en", 1, "x"),
        (7, "12345 !!! ...", "en", 1, "x"), (8, "One Two three FOUR five six", "en", 1, "x"), (9, "a b", "fr", 1, "x"),
        (10, "a  b", "fr", 2, "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return (text or "").encode().translate(LOWER).split()


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_equals_oracle(spark, name):
    assert differences(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), queries.oracle()[name]) == ""


def test_token_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    texts = ["", None, " ", "  ", "a  b", " a", "a ", "x \n b\n\n c", "don't 'tis  '", "<|endoftext|> hi", "é—, 5½5", "a\x85 b \x1c c", "日本 😀", "plain text, here"]
    plain = Tokenizer.from_file(queries.tokenizer_path())
    plain.encode_special_tokens = True
    for some in (texts, texts[-1:], texts[:2]):
        ids, ends = PartEncoder(queries.tokenizer_path()).encode(pa.array(some, pa.string()))
        for i, text in enumerate(some):
            assert ids[ends[i] : ends[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_language_model_base_is_exact(odd):
    rows = odd.collect()
    counts, texts = Counter(), 0
    for r in rows:
        if zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 7 != 2:
            counts.update(words(r.text))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    from cohortloom.llm.common import remainder

    got = lm_scoring.score(odd, remainder("doc_id", 7) != 2, known_words=50, own_class=20, k=3, iterations=2).collect()
    assert len(got) == len(rows)
    want = sorted(
        (
            len(words(r.text)) + 1,
            sum(counts[w] > 0 for w in words(r.text)) + 1,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(r.text)) + math.log10((texts + 1) / (n + v + 1)), 4),
        )
        for r in rows
    )
    assert sorted((g.n_tokens, g.n_known, round(g.base_score, 4)) for g in got) == want
    assert {g.train_tokens for g in got} == {n} and all(math.isfinite(g.score) and g.score < 0 for g in got)


def test_forward_recursion_sums_over_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    k, c = 2, 4
    norm = lambda x: x / x.sum(-1, keepdims=True)
    states = lm_scoring.States(norm(rng.random(k)), norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, c))).T)
    codes = np.array([0, 3, 1, 1, 2])
    total = sum(
        np.prod([(states.first[p[0]] if i == 0 else states.moves[p[i - 1], p[i]]) * states.emits[x, p[i]] for i, x in enumerate(codes)])
        for p in itertools.product(range(k), repeat=len(codes))
    )
    got = lm_scoring.log_likelihoods(np.append(codes, 2), np.array([0, 5, 6]), states)
    assert got[0] == pytest.approx(np.log10(total)) and got[1] == pytest.approx(np.log10(states.first @ states.emits[2]))
    first, again, moved, per_class = lm_scoring.expected_counts(codes, np.array([0, 5]), np.array([True]), states)
    assert first.sum() == pytest.approx(1, abs=1e-4) and moved.sum() == pytest.approx(4, abs=1e-4)
    assert per_class.sum() == pytest.approx(5, abs=1e-4)


def test_language_model_beats_its_base_on_unseen_texts(spark):
    got = queries.op1_hmm_lm(spark, "/root/testdata/sf0.01").where("held_out")
    assert got.agg(F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()[0] > 0.9


def test_language_of_odd_texts(odd):
    got = language_id.label(odd, language_id.train(odd), spans=True)
    assert Counter(got.columns) == Counter(["doc_id", "text", "lang", "score", "lang_pred", "lang_score", "lang_spans"])
    for r in got.collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.lang_score <= 1
        assert bool(r.lang_spans) == lettered


def test_language_spans_and_scripts(spark):
    rows = [(i, "the cat and the dog are here with this thing", "en") for i in range(30)]
    rows += [(i, "der Hund und die Katze sind nicht mehr hier", "de") for i in range(30)]
    rows += [(i, "кошка и собака здесь сегодня вместе", "ru") for i in range(30)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = "the dog and the cat are here with this 1 dog die Katze und der Hund sind nicht mehr hier кошка и собака здесь"
    r = language_id.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model, spans=True).first()
    assert [s.lang for s in r.lang_spans] == ["en", "de", "ru"] and r.lang_spans[2].first_word == 20
    nothing = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert language_id.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), nothing).first().lang_pred == "und"


def test_held_out_languages_and_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op5_quality(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.98


def test_quality_of_odd_texts(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (7, 0, 0), (2, 0, 0), (9, None, 0), (9, 3, 0), (99, 1, 0)], "doc_id long, quality int, score int")
    vectors = quality.with_statistics(odd)
    for some in (labels, labels.limit(0), labels.where("quality = 1")):
        got = quality.score_vectors(vectors, quality.train(vectors, some)).collect()
        assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(odd, quality.train(vectors, labels), "score").columns.count("score") == 1


def test_warc_round_trip_of_odd_pages(spark, tmp_path):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 50_000
    rows = [(3, "http://a", big), (2, "http://b c\r\n", big), (2, "http://b c\r\n", big), (None, None, big), (4, None, None), (5, "u", ""), (6, "u", "short"), (7, "u", "short")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string")
    warc.write_archive(pages, str(tmp_path / "a"), segment_bytes=4096, chunk_bytes=1000)
    got = warc.read_archive(spark, str(tmp_path / "a"), payloads=True).collect()
    seen = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got)
    n = len(big.encode())
    assert seen == sorted([("3", n, "revisit", 2), ("2", n, "response", None), ("2", n, "response", None), ("None", n, "revisit", 2), ("4", 0, "response", None), ("5", 0, "response", None), ("6", 5, "response", None), ("7", 5, "response", None)])
    assert all(r.status == "ok" for r in got)
    assert {r.payload_digest for r in got if r.payload_bytes == n} == {hashlib.sha256(big.encode()).hexdigest()}
    assert [bytes(r.payload) for r in got if r.page_id == 2] == [big.encode()] * 2


def test_warc_broken_archives_are_reported(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n"

    def segment(name, k, part, total=None):
        kind, fields = ("response", f"WARC-Record-ID: {name}\r\nX-Page-ID: 1") if k == 1 else ("continuation", f"WARC-Record-ID: {name}{k}\r\nWARC-Segment-Origin-ID: {name}")
        end = f"\r\nWARC-Segment-Total-Length: {total}" if total else ""
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{fields}\r\nWARC-Segment-Number: {k}{end}\r\nContent-Length: {len(part)}\r\n\r\n".encode() + part + b"\r\n\r\n"

    n = len(block)
    first = segment("<good>", 3, block[40:], n) + segment("<gap>", 1, block[:20]) + segment("<gap>", 3, block[40:], n)
    second = segment("<good>", 1, block[:20]) + segment("<long>", 1, block[:20]) + segment("<long>", 2, block[20:], n + 1)
    third = segment("<good>", 2, block[20:40]) + segment("<bad>", 1, block[:50]) + segment("<bad>", 2, block[50:-5], n - 5)
    for i, data in enumerate((first, second, third)):
        (tmp_path / f"{i}.warc.gz").write_bytes(gzip.compress(data))
    got = {r.record_id: r.status for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert got == {"<good>": "ok", "<gap>": "missing segment", "<long>": "wrong length", "<bad>": "broken chunk"}
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.unchunked(b"-1\r\n\r\n") is None


def test_contamination_with_other_numbers_and_names(spark):
    question = "If Alice buys 12 kg of apples and gives 5 kg of them to Bob how many kg does Alice have left after 12 days"
    items = spark.createDataFrame([(1, question, 0), (2, None, 0), (3, "too short", 0), (4, "Seven plain words stand in this item", 0)], "item_id long, text string, row int")
    again = question.replace("12", "30").replace("Alice", "Carol").replace("Bob", "Dan")
    inconsistent = question.replace("12 kg", "30 kg").replace("Alice buys", "Carol buys")
    rows = [(1, question), (2, "Before it. " + again + ", said all."), (3, inconsistent), (4, None), (5, ""), (6, "nothing of that kind is here at all today"), (7, "so seven plain words stand in this item again"), (1, question)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    got = sorted((r.doc_id, r.item_id, r.exact) for r in decontamination.contaminated(docs, items).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (7, 4, True)]
    # Quoted inside a sentence, the first word of an item looks like a name.
    rows = [(1, "they say Seven plain words stand in this item"), (2, "they say: Seven plain words stand in this item"), (3, "they say Eight plain words stand in this item")]
    got = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.item_id, r.exact) for r in got) == [(1, 4, True), (2, 4, True), (3, 4, False)]
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_chat_of_odd_conversations(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (3, 0, "user", "hi"), (3, 1, "assistant", None), (3, 1, "assistant", None), (4, 0, None, "hi"), (None, 0, "user", "hi"), (5, None, "user", ""), (5, 0, "user", "hi")]
    chats = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies int")
    got = {r.conv_id: r for r in chat.rendered(chats).collect()}
    assert set(got) == {2, 4, 5} and got[2].copies == 2 and got[2].n_turns == 2
    assert got[2].rendered == "<|user|>\nhi<|end|>\n<|assistant|>\n<|end|>\n"
    assert got[4].rendered.startswith("<|unknown|>") and got[5].rendered.endswith("hi<|end|>\n")
    assert chat.rendered(chats.limit(0)).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 200):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        used: list[int] = []
        for i in np.argsort(-sizes, kind="stable"):
            at = next((b for b, u in enumerate(used) if u + sizes[i] <= 100), len(used))
            used += [0] if at == len(used) else []
            assert (bins[i], offsets[i]) == (at, used[at])
            used[at] += sizes[i]


def test_packed_and_counted_odd_texts(spark, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    plain.encode_special_tokens = True
    want = Counter()
    for r in odd.collect():
        want[(r.doc_id, tuple(plain.encode(r.text or "", add_special_tokens=False).ids))] += 1
    pieces = packing.packed(odd, queries.tokenizer_path(), group_docs=20).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(p.length for p in pieces) == sum(n * (len(ids) + 1) for (_, ids), n in want.items())
    whole = packing.sequences(odd, queries.tokenizer_path(), group_docs=20).collect()
    assert len(whole) == len(by_sequence)
    assert all(len(s.ids) == 2048 or len(s.ids) & (len(s.ids) - 1) == 0 for s in whole)
    counted = token_counts.document_counts(odd, queries.tokenizer_path(), queries.END_OF_TEXT, block_ids=1000)
    assert Counter((r.doc_id, r.n_tokens) for r in counted.collect()) == Counter(
        {(d, m): n for (d, m), n in sum((Counter({(d, len(i)): n}) for (d, i), n in want.items()), Counter()).items()}
    )
    assert packing.packed(odd.limit(0), queries.tokenizer_path()).count() == 0


def test_token_files_across_blocks(spark, tmp_path):
    ids = [7, 9, 7, 7, 1, 2, 3, 4, 5, 6, 8, 7, 1, 2]
    (tmp_path / "f.bin").write_bytes(np.array(ids, "<u2").tobytes() + b"\x01")
    (tmp_path / "empty.bin").write_bytes(b"")
    for block in (1, 2, 3, 5, 100):
        got = sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in token_counts.count_tokens(spark, str(tmp_path), 7, block).collect())
        assert got == [(0, 0, 0, True), (1, 1, 1, True), (2, 3, 0, True), (3, 4, 7, True), (4, 12, 2, False)], block


def test_near_duplicates_equal_brute_force(spark, odd):
    base = [f"w{i}" for i in range(200)]
    rows = [(100 + j, " ".join(base[:j] + [f"new{j}"] + base[j + 1 :])) for j in range(0, 200, 7)]
    rows += [(300 + j, " ".join(base[: 80 + 10 * j])) for j in range(12)]
    # A passage most of each document has in common, but not enough of it.
    rows += [(400 + j, " ".join(f"own{j}x{i}" for i in range(70)) + " " + " ".join(base[:150])) for j in range(30)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    data = docs.collect()
    sets = []
    for r in data:
        w = words(r.text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(data):
        least[find(i)].append(r.doc_id)
    want = Counter()
    for i, r in enumerate(data):
        ids = [d for d in least[find(i)] if d is not None]
        component = min(ids) if ids and sets[i] else r.doc_id
        want[(r.doc_id, len(sets[i]), component, r.doc_id == component)] += 1
    got = near_dedup.near_duplicates(docs)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()) == want
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_top_k_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "_BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "_QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "_STEP", 16)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 5)]) for i in range(200)]
    rows += [(200, None), (201, [1.0, None]), (202, [math.nan]), (203, [math.inf, 1.0]), (None, [1.0]), (204, []), (205, [2.0]), (206, [0.0] * 6), (10, [9.0] * 6), (11, rows[12][1]), rows[20]]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    used = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = Counter()
    for i, v in used:
        if i % 10 == 0:
            hits = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in used if j != i)[:5]
            want.update((i, n, j, -s) for n, (s, j) in enumerate(hits, 1))
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == first.columns and out.exceptAll(docs).isEmpty(), name
        docs = spark.createDataFrame(out.toArrow())
    assert 0.6 * first.count() < docs.count() < first.count()
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"
