"""Fingerprints against sketches made in plain Python, and against true resemblance."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hackney.llm import fingerprints, registry
from tests.llm.conftest import rows_of


def shingles(text, width=5):
    words = re.findall(r"[^\W_]+", text.lower())
    return {hashlib.md5(" ".join(words[i : i + width]).encode()).hexdigest()[:16] for i in range(max(len(words) - width, 0) + 1)} if words else set()


def sketch(text, kept=128):
    return sorted(shingles(text))[:kept]


def alike(one, other, kept=128):
    both = sorted({*one, *other})[:kept]
    return len({*both} & {*one} & {*other}) / len(both) if both else 1.0


def expected(rows):
    """Every row's results, in plain Python."""
    placed = sorted(((i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()), i, t or "") for i, t in rows)
    out = []
    for at, (_, i, t) in enumerate(placed):
        after = placed[(at + 1) % len(placed)][2]
        part = len(t) // 4
        edited = t[: len(t) - part] + after[:part]
        own, other = sketch(t), sketch(edited)
        out.append((i, len(t), edited, own, other, alike(own, other), alike(own, sketch(after))))
    return sorted(out, key=repr)


def told(frame):
    columns = "doc_id n_chars edited_text fingerprint edited_fingerprint near_edited near_next".split()
    return rows_of(frame.select(*columns))


@pytest.mark.parametrize("parts", [1, 5])
def test_neighbours_are_found_across_ranges(spark, documents, parts):
    draw = random.Random(5)
    rows = [(i * 3, " ".join(draw.choice("abcdefgh") + str(draw.randint(0, 40)) for _ in range(draw.randint(0, 400)))) for i in range(60)]
    frame = documents(rows).repartition(parts)
    assert told(fingerprints.edited_fingerprints(frame)) == expected(rows)


def test_odd_documents(odd_documents, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    plain = told(fingerprints.edited_fingerprints(odd_documents))
    assert plain == expected(rows)
    assert told(fingerprints.edited_fingerprints(clashing(odd_documents))) == plain
    assert fingerprints.edited_fingerprints(odd_documents.limit(0)).count() == 0


def test_repeated_rows_ties_and_a_single_row(documents):
    rows = [(1, "a b c d e f g h")] * 4 + [(1, "i j k l m n o p")] * 2 + [(None, "a b c d e f g h")] * 2 + [(2, None)] * 3
    assert told(fingerprints.edited_fingerprints(documents(rows))) == expected(rows)
    assert told(fingerprints.edited_fingerprints(documents(rows[:1]))) == expected(rows[:1])


def test_equal_texts_have_equal_fingerprints(documents):
    found = fingerprints.fingerprints(documents([(1, "One two, three."), (2, "one TWO three"), (3, "one two")])).collect()
    by = {r["doc_id"]: r["fingerprint"] for r in found}
    assert by[1] == by[2] != by[3] and len(by[1]) == 1


def test_estimates_come_near_the_truth(spark, documents):
    draw = random.Random(9)
    base = [f"w{i}" for i in range(6000)]
    rows = []
    for i, share in enumerate((0.0, 0.2, 0.5, 0.8, 1.0)):
        cut = int(len(base) * share)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:cut], *(f"x{draw.random()}" for _ in range(len(base) - cut))]))]
    found = fingerprints.fingerprints(documents(rows)).withColumn("pair", F.col("doc_id").cast("long") % 2)
    one = found.where("pair = 0").select((F.col("doc_id") / 2).cast("int").alias("i"), F.col("fingerprint").alias("a"))
    other = found.where("pair = 1").select(((F.col("doc_id") - 1) / 2).cast("int").alias("i"), F.col("fingerprint").alias("b"))
    texts = dict(rows)
    both = one.join(other, "i").select(
        "i",
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("near"),
        fingerprints.containment(F.col("a"), F.col("b")).alias("within"),
        fingerprints.distinct_shingles(F.col("a")).alias("count"),
    )
    for r in both.collect():
        x, y = shingles(texts[2 * r["i"]]), shingles(texts[2 * r["i"] + 1])
        assert abs(r["near"] - len(x & y) / len(x | y)) < 0.13
        assert abs(r["within"] - len(x & y) / len(x)) < 0.2
        assert abs(r["count"] / len(x) - 1) < 0.25


def test_parts_merge_to_the_whole(spark):
    draw = random.Random(2)
    hashes = sorted({f"{draw.getrandbits(64):016x}" for _ in range(3000)})
    parts = [sorted(draw.sample(hashes, 900))[:128] for _ in range(12)]
    frame = spark.createDataFrame([("k", p) for p in parts] + [("empty", []), (None, parts[0])], "key string, fingerprint array<string>")
    merged = {r["key"]: r["fingerprint"] for r in fingerprints.merge_all(frame, "key", "fingerprint").collect()}
    assert merged["k"] == sorted({h for p in parts for h in p})[:128]
    assert merged["empty"] == [] and merged[None] == parts[0]


def test_the_plan_has_no_python(spark, sf_dir):
    plan = registry.QUERIES["op11_fingerprints"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|SinglePartition.*Window", plan)
