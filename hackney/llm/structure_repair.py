"""Cheapest repairs of a conversation's structure, found on an automaton that shares suffixes.

A conversation is read as a word of signs, one per row: the role's initial and the row's
fault. Words are sorted from their ends over all tasks, so that equal endings come
together: what it costs to go on from a sign, and the edit to go on with, is found once for each
ending and state of the grammar, and equal outcomes are one node. Edits are then read off
node by node, and a second pass over the rows applies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.frames import cut, kind_of, pick

# Blanks around text, signs that end a sentence, costs of edits.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Initials of roles; any other one is a role that only a change or a deletion can mend.
INITIALS = "sua"
SOUND, GONE, SHORT = range(3)
# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a. The role that must or may come next.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = [{"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U}]
WANTED = ["u", "u", "a", "u"]
ROLES = {"u": "user", "a": "assistant"}


def sign(initial: str, fault: int) -> str:
    """One letter for a row's role and fault."""
    return chr(ord("a") + 3 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + fault)


class Node(NamedTuple):
    """What follows an ending, by state: cost over the node's least one, and the edit to go on with ('' to stop)."""

    costs: tuple[int, ...]
    edits: tuple[str, ...]


class Automaton:
    """Endings of words, equal ones shared; of equal costs the edit that is least in ASCII is taken.

    The edits that a state allows differ in their letters, and each leads to one state only, so the
    least letter of the cheapest edits begins the least audit, and no audits need be compared.
    """

    def __init__(self) -> None:
        self.nodes: list[Node] = []
        self.numbers: dict[Node, int] = {}
        self.before: dict[tuple[int, str], tuple[int, int]] = {}
        # Nothing is left: the word may stop, or go on with insertions only.
        self.end, self.end_cost = self._node([(0, ""), None, None, (0, "")])

    def _node(self, least: list[tuple[int, str] | None]) -> tuple[int, int]:
        """The node of the best edits by state, insertions added; and its least cost."""
        found = [x or (1 << 62, "~") for x in least]
        for _ in range(len(found)):
            found = [min(x, (found[STEPS[q][WANTED[q]]][0] + INSERT, "I")) for q, x in enumerate(found)]
        base = min(cost for cost, _ in found)
        node = Node(tuple(cost - base for cost, _ in found), tuple(edit for _, edit in found))
        if node not in self.numbers:
            self.numbers[node] = len(self.nodes)
            self.nodes.append(node)
        return self.numbers[node], base

    def prepend(self, after: int, letter: str) -> tuple[int, int]:
        """The node of an ending with one sign more in front, and what its least cost is above the ending's."""
        known = self.before.get((after, letter))
        if known is None:
            known = self.before[after, letter] = self._node([self._best(after, letter, q) for q in range(len(STEPS))])
        return known

    def _best(self, after: int, letter: str, state: int) -> tuple[int, str]:
        role, fault = divmod(ord(letter) - ord("a"), 3)
        costs = self.nodes[after].costs
        options = [(costs[state] + DELETE, "D")]
        if fault != GONE:
            more = TRUNCATED if fault == SHORT else 0
            if role < len(INITIALS) and INITIALS[role] in STEPS[state]:
                options.append((costs[STEPS[state][INITIALS[role]]] + KEEP + more, "K"))
            options.append((costs[STEPS[state][WANTED[state]]] + REROLE + more, "R"))
        return min(options)

    def audit(self, word: str, path: list[int]) -> str:
        """The cheapest edits of a word. path: the nodes of its endings, the whole word's first."""
        state, edits = START, []
        for letter, node in zip([*word, ""], path, strict=True):
            while (edit := self.nodes[node].edits[state]) == "I":
                edits.append(edit)
                state = STEPS[state][WANTED[state]]
            if letter:
                edits.append(edit)
                if edit == "K":
                    state = STEPS[state][INITIALS[(ord(letter) - ord("a")) // 3]]
                elif edit == "R":
                    state = STEPS[state][WANTED[state]]
        return "".join(edits)


class Endings:
    """Words that come sorted by their reversed letters: each ending that differs from the last word's is worked out once."""

    def __init__(self) -> None:
        self.automaton = Automaton()
        self.backward, self.path, self.costs = "", [self.automaton.end], [self.automaton.end_cost]
        self.known: tuple[int, str] | None = None

    def repair(self, word: str) -> tuple[int, str]:
        """Cost and audit of the word."""
        backward = word[::-1]
        if self.known is not None and backward == self.backward:
            return self.known
        same = 0
        for x, y in zip(backward, self.backward):
            if x != y:
                break
            same += 1
        del self.path[same + 1 :], self.costs[same + 1 :]
        for letter in backward[same:]:
            node, more = self.automaton.prepend(self.path[-1], letter)
            self.path.append(node)
            self.costs.append(self.costs[-1] + more)
        self.backward = backward
        cost = self.costs[-1] + self.automaton.nodes[self.path[-1]].costs[START]
        self.known = cost, self.automaton.audit(word, self.path[::-1])
        return self.known


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that crc32 of `conv_id:turn`, modulo 20, deals out: (conv_id, turn, copy, role, text, present).

    0 drops a row (it stays with present = false), 1 empties its text, 2 takes the sentence ends out, 3 repeats it,
    4 makes the user its role. A null is one blank in role, text and the hashed key; turn and conv_id stay null.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")

    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    dealt = rows.withColumn("dealt", F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20)
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate(told("text"), ENDS, "")).otherwise(told("text"))
    return dealt.select(
        "conv_id",
        "turn",
        F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        F.when(F.col("dealt") == 4, "user").otherwise(told("role")).alias("role"),
        text.alias("text"),
        (F.col("dealt") != 0).alias("present"),
    )


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """The rows of a conversation together: by turn, nulls first, then role, text and copy."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text_key", "copy")


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def summaries(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, word.

    rows: (conv_id, turn, copy, role, text, present). Texts stay out of the shuffle; `word` has a letter a row.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    light = rows.select(
        "conv_id", "turn", "copy", "role", "present",
        F.md5("text").alias("text_key"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("short"),
    )
    seen = Window.partitionBy("conv_id", "present", "role", "text_key").orderBy(F.col("turn").asc_nulls_first(), "copy")
    marked = light.repartition("conv_id").withColumn("again", F.row_number().over(seen) > 1)
    conv_kind = kind_of(rows, "conv_id")
    names = ["conv_id", *SUMMARY, "word"]

    class Reading:
        def __init__(self, conv: object):
            self.conv, self.blank, self.duplicate, self.truncated, self.illegal = conv, 0, 0, 0, 0
            self.least = self.most = self.before = None
            self.turns, self.letters = 0, []

        def take(self, turn: int | None, role: str, blank: bool, again: bool, short: bool) -> None:
            if turn is not None:
                self.turns += turn != self.most
                self.least = turn if self.least is None else self.least
                self.most = turn
            initial = role[:1]
            if self.before is not None:
                self.illegal += self.before + initial not in ("su", "ua", "au")
            self.before = initial
            fault = GONE if blank or again else SHORT if short else SOUND
            self.blank += blank
            self.duplicate += again and not blank
            self.truncated += fault == SHORT
            self.letters.append(sign(initial, fault))

        def row(self) -> tuple:
            gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
            return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(self.letters))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Reading | None = None
        kind = pa.null()

        def told(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            kinds = [kind, *[pa.int64()] * len(SUMMARY), pa.string()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "blank", "again", "short", "present"))
            for conv, turn, role, blank, again, short, present in zip(*columns, strict=True):
                if current is None or conv != current.conv:
                    done += [current.row()] if current else []
                    current = Reading(conv)
                if present:
                    current.take(turn, role, blank, again, short)
            yield told(done)
        if current:
            yield told([current.row()])

    schema = ", ".join([f"conv_id {conv_kind}", *(f"{c} long" for c in SUMMARY), "word string"])
    return _ordered(marked).mapInArrow(read, schema)


def audits(words: DataFrame) -> DataFrame:
    """Cost and audit of each row's word; other columns are kept. Rows are dealt by the words' ends, one word's rows over several tasks if many."""
    kept = [f for f in words.schema.fields if f.name != "word"]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            found = [endings.repair(word) for word in batch.column("word").to_pylist()]
            cost, audit = pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())
            yield pa.record_batch([*(batch.column(f.name) for f in kept), cost, audit], [*(f.name for f in kept), "cost", "audit"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "cost long", "audit string"])
    spread = words.withColumn("backward", F.reverse("word")).repartitionByRange("backward", "conv_id")
    return spread.sortWithinPartitions("backward", "conv_id").drop("backward").mapInArrow(repaired, schema)


def applied(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The rows that edits leave, in order: (conv_id, place, role, text), and the columns of `edits` with a row of place -1 for each conversation.

    rows: (conv_id, turn, copy, role, text, present); edits: (conv_id, audit, ...).
    """
    more = [f for f in edits.schema.fields if f.name not in ("conv_id", "audit")]
    conv_kind = kind_of(rows, "conv_id")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in more]
    turn_kind = kind_of(rows, "turn")
    texts = rows.where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "copy", "role", F.md5("text").alias("text_key"), "text", F.lit(None).cast("string").alias("audit"), *empty)
    none = [F.lit(None).cast(k).alias(n) for n, k in (("turn", turn_kind), ("copy", "int"), ("role", "string"), ("text_key", "string"), ("text", "string"))]
    heads = edits.select("conv_id", F.lit(0).alias("kind"), *none, "audit", *[f.name for f in more])
    names = ["conv_id", "place", "role", "text", "audit", *(f.name for f in more)]

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, START, 0

        def insertions() -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                yield conv, place, ROLES[WANTED[state]], "", None, *([None] * len(more))
                state = STEPS[state][WANTED[state]]
                at, place = at + 1, place + 1

        kinds: list[pa.DataType] = []

        def told(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            of = {f.name: f.type for f in batch.schema}
            kinds = [of["conv_id"], pa.int64(), pa.string(), pa.string(), pa.string(), *(of[f.name] for f in more)]
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "audit", *(f.name for f in more)))
            for this, kind, role, text, edits_of, *rest in zip(*columns, strict=True):
                if kind == 0:
                    out += insertions()
                    conv, audit, at, state, place = this, edits_of, 0, START, 0
                    out.append((conv, -1, None, None, audit, *rest))
                    continue
                out += insertions()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                role = role if edit == "K" else ROLES[WANTED[state]]
                state = STEPS[state][role[:1]]
                out.append((conv, place, role, text, None, *([None] * len(more))))
                place += 1
            yield told(out)
        if kinds:
            yield told(list(insertions()))

    schema = ", ".join([f"conv_id {conv_kind}", "place long", "role string", "text string", "audit string", *(f"{f.name} {f.dataType.simpleString()}" for f in more)])
    return _ordered(texts.unionByName(heads), "kind").mapInArrow(edited, schema)


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation, and what `applied` gives.

    rows: (conv_id, turn, copy, role, text, present) with no nulls but in conv_id and turn; a row that is not present
    tells of its conversation only. Rows are taken by turn, nulls first, then role, a digest of the text, and copy.
    Rows of a null conv_id are one conversation. The first fault of a row counts: blank, duplicate (its role and text
    were seen earlier), truncated. gaps are turns missing between the least and the most; null turns do not count.

    The edits kept (K), given another role (R, 1), deleted (D, 2; a must for blank and duplicate rows) and inserted (I, 5)
    are the cheapest that leave roles in the order (system? (user assistant)+)?, by their initials; truncated rows that
    stay cost 5 more. Of equally cheap ones the audit that is least in ASCII is taken. A conversation of no rows costs nothing.

    Memory: a task streams through its rows and holds a letter for each row of one conversation.
    """
    edits = cut(audits(summaries(rows)))
    return edits, applied(rows, edits)


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, SUMMARY, cost, audit, repaired_sha256 (of `role:text` rows, newline-joined)."""
    _, left = repaired(rows)
    kept = [f for f in left.schema.fields if f.name not in ("place", "role", "text")]
    names = [*(f.name for f in kept), "repaired_sha256"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha = None, None
        kinds: list[pa.DataType] = []

        def told(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            kinds = [*(batch.schema.field(f.name).type for f in kept), pa.string()]
            done = []
            columns = (batch.column(c).to_pylist() for c in ("place", "role", "text", *(f.name for f in kept)))
            for place, role, text, *rest in zip(*columns, strict=True):
                if place < 0:
                    done += [(*head, sha.hexdigest())] if sha else []
                    head, sha = rest, hashlib.sha256()
                else:
                    sha.update(f"{'\n' if place else ''}{role}:{text}".encode())
            yield told(done)
        if sha:
            yield told([(*head, sha.hexdigest())])

    # The rows come in order, so that they are hashed where they are made.
    return left.mapInArrow(hashed, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "repaired_sha256 string"]))
