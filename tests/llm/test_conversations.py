"""The prefix trie and structure repair against brute force over small tables."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hackney.llm import prefix_trie, registry, structure_repair
from tests.compare import differences
from tests.llm.conftest import rows_of

COLUMNS = "conv_id bigint, turn int, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie_of(paths):
    """Rows of prefix_trie for {conv_id: [(role, text), ...]}, in plain Python."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(conv)

    def below(key):
        yield key
        for child in children[key]:
            yield from below(child)

    rows = []
    for key, convs in members.items():
        whole = list(below(key))
        saved = sum((len(members[k]) - 1) * len(WORD.findall(k[-1][1])) for k in whole if k)
        parent = min(members[key[:-1]]) if key else None
        leaves = sum(not children[k] for k in whole)
        rows.append((min(convs), len(key), parent, len(convs), len(children[key]), leaves, saved, sha(",".join(map(str, ends[key])))))
    return sorted(rows, key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + turns[c][h:]
    return out


def trie_query(frame):
    turns = prefix_trie.rebuild(frame, family=20, heads=4, borrowed=lambda c: F.crc32(c.cast("string").cast("binary")) % 4)
    return prefix_trie.prefix_trie(turns)


def random_conversations(draw, convs, longest=7):
    rows = []
    for c in range(convs):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, draw.choice([turn, turn, None]) if draw.random() < 0.1 else turn, draw.choice(["user", "assistant", "system", None, ""]), draw.choice(["a b.", "a b", "", " ", None, "c d e!"])))
    draw.shuffle(rows)
    return rows


def test_node_table_is_minimal_and_perfect():
    draw = np.random.default_rng(1)
    for count in (0, 1, 2, 1000, 50_000):
        hi, lo = draw.integers(-(2**63), 2**63 - 1, (2, count))
        table = prefix_trie.NodeTable(np.concatenate([hi, hi]), np.concatenate([lo, lo]))
        slots = table.slots(hi, lo)
        assert table.size == count and sorted(slots.tolist()) == list(range(count))
        assert (table.hi[slots] == hi).all() and (table.lo[slots] == lo).all()
        assert (table.slots(hi, lo + 1) == -1).all()


def test_node_table_tells_halves_apart():
    hi, lo = np.repeat(np.arange(40), 40), np.tile(np.arange(40), 40)
    assert sorted(prefix_trie.NodeTable(hi, lo).slots(hi, lo).tolist()) == list(range(1600))


@pytest.mark.parametrize("seed", range(3))
def test_trie_is_the_brute_one(spark, seed):
    rows = random_conversations(random.Random(seed), 90)
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert rows_of(trie_query(frame)) == trie_of(rebuilt(rows))


@pytest.mark.parametrize("shard_rows", [1, 3, 50])
def test_shards_that_cut_conversations_add_up(spark, shard_rows):
    draw = random.Random(7)
    paths = {c: [("u", draw.choice("ab"))] * draw.randint(0, 3) + [("u", draw.choice("abc")) for _ in range(draw.randint(0, 40))] for c in range(40)}
    rows = [(c, p, *t) for c, turns in paths.items() for p, t in [(None, (None, None)), *enumerate(turns)]]
    turns = spark.createDataFrame(rows, "conv_id bigint, place bigint, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        beginnings = prefix_trie.prefixes(turns)
        nodes = prefix_trie.nodes_of(beginnings, shard_rows)
        children = nodes.where("depth > 0").groupBy(F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
        nodes = nodes.join(children, ["hi", "lo"], "left").fillna(0, ["n_children"])
        found = nodes.join(prefix_trie.climbed(beginnings, nodes, shard_rows), ["hi", "lo"]).join(prefix_trie.ends_digests(beginnings, 2), ["hi", "lo"], "left")
        found = found.select("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(sha(""))))
        assert rows_of(found) == sorted([(r[0], r[1], *r[3:]) for r in trie_of(paths)], key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_trie_of_odd_tables(spark, clashing):
    rows = [(None, 1, "user", "x"), (20, None, None, None), (21, 1, "user", "a"), (21, 1, "user", "a"), (22, 0, "user", "x" * 5000), (22, 2, "é", "  b")]
    rows += [(-7, 0, "user", "a"), (0, 0, "user", "z z")]
    frame = spark.createDataFrame(rows, COLUMNS)
    plain = rows_of(trie_query(frame))
    kept = [r for r in rows if r[0] is not None and r[0] >= 0]
    assert rows_of(trie_query(spark.createDataFrame(kept, COLUMNS))) == trie_of(rebuilt(kept))
    assert rows_of(trie_query(clashing(frame))) == plain
    assert trie_query(frame.limit(0)).count() == 0


def test_trie_query_is_its_sql(spark, con, sf_dir):
    assert differences(registry.QUERIES["op12_prefix_trie"](spark, sf_dir), con, registry.ORACLE_SQL["op12_prefix_trie"]) == []


def test_one_conversation_with_a_third_of_all_rows(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(100, 1100) for t in range(6)]
    paths = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in _grouped(rows).items()}
    turns = spark.createDataFrame(rows, "conv_id bigint, place bigint, role string, text string")
    found = rows_of(prefix_trie.prefix_trie(turns))
    assert len(found) == 3001 and len({r[0] for r in found}) == 1
    by_depth = {r[1]: r for r in found}
    assert by_depth[6][3] == 1001 and by_depth[7][3] == 1 and by_depth[0][6] == 6 * 1000
    assert by_depth[6][7] == sha(",".join(str(c) for c in sorted(paths) if c != 1))


def _grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


# --- structure repair


def damaged(rows):
    """{conv_id: [(turn, role, text), ...]} after damage, in order; all conversations."""
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        dealt = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
        role = "user" if dealt == 4 else role
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(dealt, 1)
    for turns in out.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
    return out


def cheapest(word):
    """Cost and audit of (initial, must go, short) rows by a search over whole audits."""
    queue, done = [(0, "", 0, "")], {}
    while queue:
        cost, audit, at, roles = heapq.heappop(queue)
        state = "" if not roles else roles[-1]
        if at == len(word) and state in ("", "a"):
            return cost, audit
        if (at, state) in done:
            continue
        done[at, state] = audit

        def legal(initial, state=state):
            return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and initial != ""

        for initial in "ua":
            if legal(initial):
                heapq.heappush(queue, (cost + 5, audit + "I", at, initial))
        if at < len(word):
            initial, gone, short = word[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state))
            if not gone:
                if legal(initial):
                    heapq.heappush(queue, (cost + 5 * short, audit + "K", at + 1, initial))
                for other in "ua":
                    if legal(other):
                        heapq.heappush(queue, (cost + 5 * short + 1, audit + "R", at + 1, other))
    raise AssertionError


def repairs(rows):
    out = []
    for conv, turns in damaged(rows).items():
        held = [t for t, _, _ in turns if t is not None]
        gaps = max(held) - min(held) + 1 - len(set(held)) if held else 0
        blank = duplicate = truncated = 0
        word, seen = [], set()
        for _, role, text in turns:
            bare = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            gone, short = not bare or (role, text) in seen, False
            if not bare:
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
            elif bare[-1] not in ".!?":
                truncated, short = truncated + 1, True
            seen.add((role, text))
            word.append((role[:1], gone, short))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(word, word[1:]))
        cost, audit = cheapest(word)
        left, at = [], 0
        for edit in audit:
            state = left[-1][0][:1] if left else ""
            wanted = "assistant" if state == "u" else "user"
            if edit == "I":
                left.append((wanted, ""))
                continue
            _, role, text = turns[at]
            at += 1
            if edit != "D":
                left.append((role if edit == "K" else wanted, text))
        assert at == len(turns)
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left))))
    return sorted(out, key=repr)


NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def repair_query(frame):
    return rows_of(structure_repair.repair_digests(structure_repair.damage(frame)).select(*NAMES))


@pytest.mark.parametrize("seed", range(3))
def test_repairs_are_the_cheapest(spark, seed):
    draw = random.Random(seed)
    rows = random_conversations(draw, 150, longest=9)
    rows += [(c, t, draw.choice(["user", "assistant", "system", "tool"]), f"x{draw.random()}" + draw.choice(".!? ")) for c in range(200, 300) for t in range(draw.randint(1, 12))]
    assert repair_query(spark.createDataFrame(rows, COLUMNS).repartition(5)) == repairs(rows)


def test_repairs_of_the_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in registry.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = registry.QUERIES["op13_structure_repair"](spark, sf_dir).select(*NAMES)
    assert rows_of(found) == repairs(rows)


def test_every_short_word_is_repaired_best():
    endings = structure_repair.Endings()
    signs = [(i, g, s) for i in ["s", "u", "a", "t"] for g, s in ((False, False), (True, False), (False, True))]
    words = [()]
    for _ in range(4):
        words += [(*w, s) for w in words for s in signs if len(w) < 4]
    words = random.Random(0).sample(sorted(set(words)), 1500)
    told = {w: "".join(structure_repair.sign(i, structure_repair.GONE if g else structure_repair.SHORT if s else structure_repair.SOUND) for i, g, s in w) for w in words}
    for w in sorted(words, key=lambda w: told[w][::-1]):
        assert endings.repair(told[w]) == cheapest(w)


def test_the_automaton_stays_small_and_long_words_are_linear():
    endings = structure_repair.Endings()
    draw = random.Random(1)
    for _ in range(20):
        endings.repair("".join(draw.choice("abcdefghijkl") for _ in range(20_000)))
    assert len(endings.automaton.nodes) < 400


def test_repairs_of_odd_tables(spark, clashing):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (4, 1, "user", "No end"), (4, 1, "user", "No end"), (5, 2, "", "Ok."), (5, None, "tool", "x" * 9000 + "."), (6, 2, "user", "a "), (6, 9, "assistant", " ")]
    frame = spark.createDataFrame(rows, COLUMNS)
    plain = repair_query(frame)
    assert plain == repairs(rows)
    assert repair_query(clashing(frame)) == plain
    assert repair_query(frame.limit(0)) == []


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(3000)] + [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for c in range(100, 1100) for t in range(6)]
    assert repair_query(spark.createDataFrame(rows, COLUMNS)) == repairs(rows)
