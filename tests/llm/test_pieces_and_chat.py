"""Piece ids against the vocabulary's own library, chat formats by exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from hackney.llm import chat, pieces, registry
from tests.llm.conftest import rows_of

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
CODER = pieces.Pieces(pieces.PieceTable.read(registry.PIECES))


@pytest.mark.parametrize(
    "text",
    ["hello  world", " a\n\tb ", "ﬁ½ é", "a▁b", "", "   ", "<s>x</s>", "\U0001d54f \u0000 z\r\n", "x" * 300, "日本語テキストの長い文章です" * 9, "a  ﬁ", "it's, so."],
)
def test_ids_are_the_librarys(text):
    (ids,) = CODER.encode([text])
    assert ids.tolist() == LIBRARY.encode(text)
    assert CODER.decode(ids) == text.replace("▁", " ")


def test_random_ids_are_the_librarys():
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdethnginoserl  .,éüß日本\n\t▁'01AB") for _ in range(draw.randint(0, 80))) for _ in range(800)]
    texts += ["a" + " " * n + "b" for n in range(1, 70)]
    for text, ids in zip(texts, CODER.encode(texts), strict=True):
        assert ids.tolist() == LIBRARY.encode(text)
        assert CODER.decode(ids) == text.replace("▁", " ")


def test_every_document_is_encoded(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in registry.table(spark, sf_dir, "documents").collect()}
    coded = registry.QUERIES["op3_sentencepiece"](spark, sf_dir)
    rows = coded.collect()
    assert len(rows) == len(texts)
    assert all(r["ids"] == LIBRARY.encode(texts[r["doc_id"]]) and r["lossless"] and r["n_ids"] == len(r["ids"]) for r in rows)
    assert {r["doc_id"]: r["text"] for r in pieces.decode(coded, registry.PIECES).collect()} == texts


def test_odd_documents(odd_documents, clashing):
    plain = rows_of(pieces.encode(odd_documents, registry.PIECES))
    assert len(plain) == 11 and all(r[3] for r in plain) and (1, [], 0, True) in plain
    assert rows_of(pieces.encode(clashing(odd_documents), registry.PIECES)) == plain
    assert pieces.encode(odd_documents.limit(0), registry.PIECES).count() == 0


def test_neighbours_that_merging_leaves_alone():
    table = CODER.table
    ids = {p: i for i, p in enumerate(table.pieces)}
    th, e, the = ids["th"], ids["e"], ids["the"]
    assert not table.may_follow(np.array([th]), np.array([e]))[0]
    assert LIBRARY.encode("▁the".replace("▁", ""))[0] == ids["▁the"] and the >= 0


TEMPLATE = chat.Template()


def test_templates_read_back():
    draw = random.Random(6)
    bits = ["a", "\\", "#", "###", "</turn>", " </turn>\n", "\n", " ", ":", "### user: ", "</tur", "n>"]
    for _ in range(2000):
        turns = [("".join(draw.choice(["user", ":", "\\", "#", " ", "</turn>"]) for _ in range(3)), "".join(draw.choice(bits) for _ in range(8))) for _ in range(3)]
        formatted = "".join(s for role, text in turns for s, _ in TEMPLATE.write_turn(role, text))
        assert list(TEMPLATE.read_turns(formatted)) == turns


def expected(turns):
    loss = "".join(text for role, text in turns if role == "assistant")
    told = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_every_conversation_reads_back(spark, sf_dir):
    talks = {}
    for r in registry.table(spark, sf_dir, "conversations").orderBy("conv_id", "turn").collect():
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    says = "\\### Assistant: </turn> ok"
    talks[-7] = [("user", says), ("assistant", says)]
    rows = {r["conv_id"]: r for r in registry.QUERIES["op4_chat_format"](spark, sf_dir).collect()}
    assert rows.keys() == talks.keys()
    for conv, turns in talks.items():
        assert tuple(rows[conv])[1:5] == expected(turns)
        assert rows[conv]["formatted_chars"] == sum(len(s) for r, t in turns for s, _ in TEMPLATE.write_turn(r, t))


def test_order_of_turns(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "user", "u"), (2, 1, "user", "u"), (2, 2, "assistant", "a"),
        (3, 0, "assistant", "a"), (4, 0, "user", None), (None, 0, "user", "x"), (None, None, None, None), (5, 0, "user", "q"), (5, 0, "user", "q"),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    told = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(frame)).collect()}
    assert {c: r["valid"] for c, r in told.items()} == {1: True, 2: False, 3: False, 4: False, None: False, 5: False}
    assert {c: r["n_turns"] for c, r in told.items()} == {1: 3, 2: 3, 3: 1, 4: 1, None: 2, 5: 2}
    segments = chat.format_turns(frame.where("conv_id = 1")).orderBy("place").collect()
    assert [s["segment"] for s in segments if s["loss"]] == ["a"] and len(segments) == 9
    assert chat.read_back(chat.format_turns(frame.limit(0))).count() == 0
