"""Cases the operators once left out: each is the whole job in small."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from cohortloom.llm import chat, decontamination, language_id, packing, queries

QUESTION = "If Alice buys 12 kg of apples and gives 5 kg of them to Bob how many kg does Alice have left after 12 days"


def test_one_conflict_of_slots_costs_only_its_windows(spark, monkeypatch):
    import corpus_pipeline

    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    edited = QUESTION.replace("12 kg", "30 kg").replace("Alice buys", "Carol buys")
    other = "If Carol buys 30 kg of pears and sells 7 kg of them to Dan how much does Eve have left after 9 weeks"
    docs = spark.createDataFrame([(1, edited), (2, other)], "doc_id long, text string")
    got = decontamination.contaminated(docs, items, verbatim=True).collect()
    assert [(r.doc_id, r.item_id, r.exact) for r in got] == [(1, 1, False)]
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: items)
    assert [r.doc_id for r in corpus_pipeline.drop_benchmark_texts(spark, docs, "").collect()] == [2]


def test_items_of_few_plain_words_and_covered_tokens(spark):
    long = "we found that Anna Bert Carl Dora Emil Fritz Gerd went to the old market square and then bought some bread"
    texts = {1: "Who wrote Romeo and Juliet?", 2: "Compute 3 x 4 + 5 x 6 - 7 x 8", 3: "東京の人口は何人ですか。", 4: "Name three oceans", 5: long, 6: ""}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    passage = " ".join(long.split()[1:14])  # its first windows hold fewer than 4 plain words
    rows = [(10 * i, t) for i, t in texts.items()]
    rows += [(11, "They ask: who wrote Romeo and Juliet, today."), (12, "Who wrote Faust and Emilia?"), (21, "Compute 3 x 4 + 5 x 6 - 7 x 9"), (41, "now name three oceans please"), (42, "name three seas"), (51, f"it is said: {passage} at noon"), (52, " ".join(long.split()[1:13])), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(10, 1), (11, 1), (20, 2), (30, 3), (40, 4), (41, 4), (50, 5), (51, 5)]
    for verbatim in (False, True):
        got = decontamination.contaminated(docs, items, verbatim=verbatim).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == want and all(r.exact for r in got)


def test_every_labelled_row_teaches_its_language(spark):
    """100,000 rows of one language, half of them one text, and a row each of twelve more."""
    common = spark.range(100_000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'the same text again', concat('plain words and ', id, ' more')) AS text", "'en' AS lang")
    rare = spark.createDataFrame([(-i, f"{chr(96 + i) * 3}{i}q zw{chr(96 + i)}vj", f"x{i}") for i in range(1, 13)], "doc_id long, text string, lang string")
    docs = common.unionByName(rare)
    model = language_id.train(docs)
    assert len(model.languages) == 13 and model.candidates.any(0).all()
    got = language_id.label(docs.where("doc_id < 6"), model).collect()
    assert len(got) == 18 and all(r.lang_pred == r.lang for r in got)


def test_packed_ids_are_those_of_the_unmodified_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    texts = ["a <|endoftext|> b", "a  <|endoftext|>  b c", "<|endoftext|>", "x<|endoftext|>y z\n <|endoftext|>", "no literal here", "a <|endoftext |> b", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ids = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    want = Counter((i, len(x), zlib.crc32(np.array(x, np.uint32).tobytes())) for i, x in enumerate(ids))
    got = packing.packed(docs, queries.tokenizer_path()).collect()
    assert Counter((r.doc_id, r.doc_tokens, r.ids_crc32) for r in got) == want


def test_a_long_conversation_is_rendered_in_bounded_parts(spark):
    rows = [(1, i, "user" if i % 3 else None, f"turn {i} " + "é" * (i % 7)) for i in range(400)]
    rows += [(2, 0, "user", "hi"), (1, 5, "user", rows[5][3]), (1, None, "user", "first"), (3, 0, "user", "x" * 5000)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: r for r in chat.rendered(chats).collect()}
    turns = ["<|user|>\nfirst<|end|>\n"] + [f"<|{role or 'unknown'}|>\n{text}<|end|>\n" for _, _, role, text in rows[:400]]
    assert whole[1].rendered == "".join(turns) and whole[1].n_turns == 401
    parts = sorted(chat.rendered_parts(chats, part_bytes=500).collect(), key=lambda r: (r.conv_id, r.part))
    longest = max(len(t.encode()) for t in turns)
    assert all(len(r.rendered.encode()) < 500 + longest for r in parts if r.conv_id == 1)
    for conv, row in whole.items():
        mine = [r for r in parts if r.conv_id == conv]
        assert [r.part for r in mine] == list(range(len(mine))) and len(mine) == (1 if conv != 1 else len(mine))
        assert "".join(r.rendered for r in mine) == row.rendered and {r.n_turns for r in mine} == {row.n_turns}
    assert len(parts) > 10


def test_texts_of_no_learned_script_leave_the_language_stage(spark):
    import corpus_pipeline

    rows = [(i, "the cat and the dog are here", "en") for i in range(20)]
    rows += [(30, "кошка и собака здесь", None), (31, "кошка and the dog", None), (32, "123 !!!", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.keep_known_language(spark, docs, "").collect()}
    assert kept == {*range(20), 31}
