from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls, empty and blank texts, repeated rows, a long text and a long word."""
    draw = random.Random(3)
    long = " ".join(draw.choice(["alpha", "beta", "gamma's", "délta", "日本"]) + str(i % 97) for i in range(6000))
    rows = [
        (None, "no id here at all today", "a"),
        (1, None, "a"),
        (2, "", None),
        (3, "  \n\t ", "b"),
        (4, "one two three four five six", "b"),
        (4, "one two three four five six", "b"),
        (5, "One two three four five SIX", None),
        (6, "x" * 3000, "c"),
        (7, long, "c"),
        (8, "%%% *** &&&", ""),
        (9, "a<|endoftext|>b ▁ \u0000 \U0001d54f é", "a"),
    ]
    return documents(rows)


@pytest.fixture(scope="session")
def clashing():
    """The same rows with further columns whose names clash with those operators use."""
    from pyspark.sql import functions as F

    names = "TEXT Doc_Id size score keep_id node key id hash digest place turn count ids spans rank a.b c0 c1".split()

    def widen(frame):
        more = [F.lit(i).alias(name) for i, name in enumerate(names)]
        return frame.select("*", *more)

    return widen


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
