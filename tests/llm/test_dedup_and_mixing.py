"""Copies, near copies and the mix against brute force, and their SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hackney.llm import bags, exact_dedup, mixing, near_dedup, registry
from tests.compare import differences
from tests.llm.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_against_sql(spark, con, sf_dir, name):
    assert differences(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLE_SQL[name]) == []


# --- exact copies


def test_classes_of_odd_documents(odd_documents, clashing):
    plain = rows_of(exact_dedup.find_copies(odd_documents))
    assert rows_of(exact_dedup.find_copies(clashing(odd_documents))) == plain
    by_id = {r[0]: r[1:4] for r in plain}
    assert len(plain) == 11 and by_id[1] == (2, 2, False) and by_id[2] == (2, 2, True)
    assert by_id[4] == (5, 3, False) and by_id[5] == (5, 3, True) and by_id[None] == (None, 1, True)
    assert exact_dedup.find_copies(odd_documents.limit(0)).count() == 0


def test_dropping_copies_keeps_rows_whole(odd_documents, clashing):
    wide = clashing(odd_documents)
    left = exact_dedup.drop_copies(wide)
    assert left.columns == wide.columns
    assert sorted(str(r[0]) for r in left.collect()) == sorted(map(str, [None, 2, 3, 5, 6, 7, 8, 9]))
    assert exact_dedup.drop_copies(odd_documents.limit(0)).count() == 0


def test_only_ascii_letters_are_lowered(documents):
    rows = [(1, "ÉTÉ ABC"), (2, "été abc"), (3, "ÉTÉ abc"), (3, "ÉTÉ abc"), (4, "K"), (5, "K")]
    left = exact_dedup.drop_copies(documents(rows))
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 5]


# --- near copies


def bag_of(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def classes_of(texts, least=0.8):
    """The least id of each component of links, from all pairs that share a shingle."""
    held = {i: bag_of(t) for i, t in texts.items()}
    sharing = defaultdict(set)
    for i, bag in held.items():
        for shingle in bag:
            sharing[shingle].add(i)
    label = {i: i for i in held}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in {(a, b) for ids in sharing.values() for a in ids for b in ids if a < b}:
        if similarity(held[a], held[b]) >= least:
            low, high = sorted((root(a), root(b)))
            label[high] = low
    return {i: root(i) for i in held}


def test_signatures_are_unbiased():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    for times in (1, 7):
        base = [draw.choice(words) for _ in range(120)] * times
        other = [w if draw.random() > 0.03 else "z" for w in base] + base[: len(base) // 4]
        held = bags.bags_of([" ".join(base), " ".join(other)], 5)
        told = bags.overlap(held, 0, 1, held.bounds())
        assert told == pytest.approx(similarity(bag_of(" ".join(base)), bag_of(" ".join(other))))
        same = [np.mean(s[0] == s[1]) for s in (bags.signatures(held, 130, seed) for seed in range(40))]
        assert np.mean(same) == pytest.approx(told, abs=0.03)


def test_near_copies_of_every_document(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in registry.table(spark, sf_dir, "documents").collect()}
    found = {r["doc_id"]: r for r in registry.QUERIES["op9_near_dedup"](spark, sf_dir).collect()}
    expected = classes_of(texts)
    assert {i: r["class_id"] for i, r in found.items()} == expected
    sizes = Counter(expected.values())
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (i == r["class_id"]) for i, r in found.items())


@pytest.fixture(scope="module")
def crowd(documents):
    """A large group of near copies, chains of edits, and texts that share most of a passage without being near."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    text = [draw.choice(words) for _ in range(150)]
    rows = []
    for i in range(60):
        near = list(text)
        near[draw.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(near)))
    chain = [draw.choice(words) for _ in range(120)]
    for i in range(60, 80):
        chain[(i * 37) % 120] = f"c{i}"
        rows.append((i, " ".join(chain)))
    passage = [draw.choice(words) for _ in range(60)]
    for i in range(80, 140):
        own = [draw.choice(words) for _ in range(30)]
        rows.append((i, " ".join(passage + own)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join(passage + own[:-1] + ["end"])))
    rows += [(500, "too short"), (501, "Too, short!"), (502, "too short now"), (503, "..."), (504, "...")]
    return rows, documents(rows)


def test_crowds_are_grouped_right(crowd):
    rows, frame = crowd
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_copies(frame).collect()}
    expected = classes_of(dict(rows))
    assert {i: c for i, c in found.items() if i < 503 or i > 504} == {i: c for i, c in expected.items() if i < 503 or i > 504}
    assert found[500] == found[501] == 500 and found[502] == 502 and found[503] == 503 and found[504] == 504


def edit(words, times, name, draw):
    copy = list(words)
    for at in draw.sample(range(len(words)), times):
        copy[at] = f"{name}x{at}"
    return copy


def test_edited_copies_find_their_original(documents):
    draw = random.Random(10)
    text = [f"w{draw.randrange(3000)}" for _ in range(200)]
    rows = [(1000, " ".join(text))] + [(i, " ".join(edit(text, 4, f"e{i}", draw))) for i in range(500)]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_copies(documents(rows)).collect()}
    assert found == classes_of(dict(rows))


def test_links_that_no_hub_shows(documents, monkeypatch):
    """Edits of an absent text, all alike to any hub, and a copy of each; large buckets only, many blocks."""
    draw = random.Random(11)
    text = [f"w{draw.randrange(3000)}" for _ in range(200)]
    rows = []
    for i in range(150):
        one = edit(text, 4, f"e{i}", draw)
        rows += [(i, " ".join(one)), (500 + i, " ".join(edit(one, 3, f"f{i}", draw)))]
    groups, blocks = [], near_dedup.block_links
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "block_links", lambda *given: groups.append(given[0]) or blocks(*given))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_copies(documents(rows)).collect()}
    assert found == classes_of(dict(rows))
    assert groups[0].agg(F.max("size")).first()[0] > 64


def test_edits_of_an_absent_text_meet_nobody(spark, documents, monkeypatch):
    """Nine edits in 200 words: copies share buckets and are near nothing. What is dealt grows as the family, and few come to blocks."""
    crowds, blocks = [0], near_dedup.block_links
    monkeypatch.setattr(near_dedup, "block_links", lambda *given: crowds.append(given[0].where("size > 32").select("node").distinct().count()) or blocks(*given))
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    dealt, rare = [], near_dedup.rare_buckets
    monkeypatch.setattr(near_dedup, "rare_buckets", lambda *given: dealt.append(rare(*given)) or dealt[-1])
    memberships = {}
    for count in (500, 2000):
        draw = random.Random(12)
        text = [f"w{draw.randrange(3000)}" for _ in range(200)]
        rows = [(i, " ".join(edit(text, 9, f"e{i}", draw))) for i in range(count)] + [(count, " ".join(edit(edit(text, 9, "e0", random.Random(1)), 1, "z", draw)))]
        found = near_dedup.near_copies(documents(rows)).collect()
        memberships[count] = dealt[-1].count()
        assert len(found) == count + 1 and all(r["kept"] for r in found)
    assert memberships[2000] <= 5 * memberships[500] + 100
    assert crowds[-1] < 2000 / 4


@pytest.mark.parametrize("big", [False, True])
def test_one_row_of_a_class_stays(documents, big):
    draw = random.Random(13)
    text = [f"w{draw.randrange(3000)}" for _ in range(200)]
    near = [" ".join(edit(text, 1, f"e{i}", draw)) for i in range(30 if big else 3)]
    other = [f"v{draw.randrange(3000)}" for _ in range(200)]
    others = [" ".join(edit(other, 1, f"f{i}", draw)) for i in range(3)]
    rows = [(None, t) for t in near] + [(5, others[0]), (5, others[0]), (5, others[1]), (6, others[2]), (7, ""), (7, "")]
    found = near_dedup.near_copies(documents(rows)).collect()
    assert len(found) == len(rows)
    stays = [(r["doc_id"], r["class_id"], r["class_size"]) for r in found if r["kept"]]
    assert sorted(stays, key=repr) == sorted([(None, None, len(near)), (5, 5, 4), (7, 7, 1), (7, 7, 1)], key=repr)
    left = [r[0] for r in near_dedup.drop_near_copies(documents(rows)).collect()]
    assert sorted(left, key=repr) == [5, 7, 7, None]


def test_dropping_near_copies(crowd, clashing):
    rows, frame = crowd
    wide = clashing(frame)
    left = near_dedup.drop_near_copies(wide)
    assert left.columns == wide.columns
    expected = {c for i, c in classes_of(dict(rows)).items() if i not in (503, 504)} | {503, 504}
    assert {r[0] for r in left.collect()} == expected


def test_near_copies_of_odd_documents(odd_documents, clashing):
    plain = rows_of(near_dedup.near_copies(odd_documents))
    assert rows_of(near_dedup.near_copies(clashing(odd_documents))) == plain
    by_id = {r[0]: r[1:] for r in plain}
    assert len(plain) == 11 and by_id[5] == (4, 3, False) and by_id[4] == (4, 3, True)
    assert by_id[1] == (1, 1, True) and by_id[2] == (2, 1, True) and by_id[None] == (None, 1, True)
    assert near_dedup.near_copies(odd_documents.limit(0)).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (3, 9), (20, 21)] + [(100 + i, 101 + i) for i in range(40)] + [(0, 200 + i) for i in range(50)]
    labels = {r["node"]: r["label"] for r in near_dedup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {labels[i] for i in (1, 2, 3, 9)} == {1} and labels[140] == 100 and labels[249] == 0 and labels[21] == 20


# --- mix


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes):
    """Shares by weight, with what is above three times a source's size shared again until none is."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    return target


def test_mix_of_every_document(spark, sf_dir):
    docs = {r["doc_id"]: r for r in registry.table(spark, sf_dir, "documents").collect()}
    check_mix({i: (r["text"], r["source"]) for i, r in docs.items()}, registry.QUERIES["op7_source_mix"](spark, sf_dir).collect())


def check_mix(docs, rows):
    sizes = Counter()
    for text, source in docs.values():
        sizes[source] += words_of(text)
    targets, taken, largest = targets_of(sizes), Counter(), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        text, source = docs[r["doc_id"]]
        assert r["size"] == words_of(text) and r["source_size"] == sizes[source]
        assert math.isclose(r["target"], targets[source], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1


@pytest.mark.parametrize("seed", range(3))
def test_random_mixes(documents, seed):
    draw = random.Random(seed)
    names = ["a", "b", "é", "Z", "", None, "tiny"]
    rows = []
    for i in range(400):
        source = draw.choices(names, [40, 20, 5, 5, 2, 1, 0.2])[0]
        rows.append((i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.choice([0, 1, 5, 200]))), source))
    told = mixing.mix_sizes(documents(rows)).collect()
    check_mix({i: (t, s) for i, t, s in rows}, told)
    assert told == mixing.mix_sizes(documents(rows).repartition(7)).orderBy("doc_id").collect() or sorted(map(tuple, told)) == rows_of(
        mixing.mix_sizes(documents(rows).repartition(7))
    )


def test_mixing_repeats_rows(documents, clashing):
    rows = [(i, "w " * (20 + i), "big" if i > 4 else "small") for i in range(60)]
    wide = clashing(documents(rows))
    mixed, sizes = mixing.mix(wide), mixing.mix_sizes(wide)
    assert mixed.columns == wide.columns
    times = Counter(r[0] for r in mixed.collect())
    assert times == Counter({r["doc_id"]: r["taken"] // r["size"] for r in sizes.collect()})


def test_mix_of_odd_documents(odd_documents, clashing):
    plain = rows_of(mixing.mix_sizes(odd_documents))
    assert len(plain) == 11 and rows_of(mixing.mix_sizes(clashing(odd_documents))) == plain
    assert mixing.mix_sizes(odd_documents.limit(0)).count() == 0 and mixing.mix(odd_documents.limit(0)).count() == 0
    assert {1, 2, 3} <= {r["doc_id"] for r in mixing.mix(odd_documents).collect()}


def test_mix_stays_in_the_engine(spark, sf_dir):
    plan = registry.QUERIES["op7_source_mix"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(bad in plan for bad in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_words_are_parted_by_the_given_blanks(spark):
    text = "a b c\u0085d\x0be\x1cf  \t\r\n g"
    assert spark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0] == words_of(text)
