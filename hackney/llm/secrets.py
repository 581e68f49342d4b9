"""Secret scans by assignment-aware lexing.

Source and configuration texts are read as name-literal pairs around `=` and
`:`. Literals are followed through later names (`key = "..."`, `password = key`)
and through joined literals, and scored by how sensitive the name they reach is
and how much the literal looks like a credential; a name like `password` is enough
by itself for any literal of eight characters. Three fixed kinds are always
reported: `assign`, `access` and `hex`; what only the pairs show is `lexed`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from hackney.llm.frames import kind_of, map_slices, texts_of

# The base kinds, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A greedy run of too few characters holds no longer run, so the least length may stand in the pattern.
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "lexed")

_SIGN = re.compile(r"[:=]")
_NAME_BACKWARD = re.compile(r"[A-Za-z0-9_.\-]+")
_LITERAL = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|([A-Za-z_][\w.]*(?![\w+/=\-@$%!#]))|([^\s"',;(){}\[\]<>]+))""")
_PLUS = re.compile(r"[ \t]*\+")

# How much a part of a name tells of a credential.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "apikey": 1.0,
    "token": 0.8, "credential": 0.8, "credentials": 0.8, "privatekey": 1.0, "accesskey": 0.9,
    "signingkey": 0.9, "authkey": 0.9, "auth": 0.6, "bearer": 0.8, "key": 0.4,
}
# Names about secrets that hold none.
HARMLESS = {"hint", "length", "len", "count", "url", "uri", "path", "file", "name", "type", "id", "field", "label", "policy"}
THRESHOLD = 1.0
LEAST_LITERAL = 8
# Characters of a joined value that its strength is taken from. Its spans are told whole.
SCORED = 256


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def sensitivity(name: str) -> float:
    """0 to 1 by the words in a name: `dbPassword`, `DB_PASSWORD` and `db.password` read alike."""
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+(?![a-z])", name)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    joined = [a + b for a, b in zip(words, words[1:])]
    return max(SENSITIVE.get(w, 0.0) for w in [*words, *joined])


def strength(literal: str) -> float:
    """0 to 1 by how unlike a word a literal is: bits per character, and kinds of characters."""
    if len(literal) < LEAST_LITERAL or any(c.isspace() for c in literal):
        return 0.0
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in Counter(literal).values())
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit)) + (not literal.isalnum())
    return min(1.0, bits / 4) * (0.0 if kinds < 2 else min(1.0, 0.4 + 0.2 * kinds))


def base_spans(text: str) -> list[Span]:
    """Whole matches of the fixed kinds, leftmost and non-overlapping within a kind."""
    found = []
    if "=" in text or ":" in text:
        found += [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [Span(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [Span(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


class Part(NamedTuple):
    """A literal, or a bare word that may be a name; `firm` if it cannot be one."""

    text: str
    start: int
    end: int
    firm: bool


def _name_before(between: str) -> str | None:
    """The name that ends a piece of text, but for blanks and closing quotes or a bracket after it."""
    bare = between.rstrip(" \t")
    for _ in range(2):
        if bare[-1:] in ('"', "'", "]"):
            bare = bare[:-1]
    backward = _NAME_BACKWARD.match(bare[::-1])
    return (backward[0][::-1].lstrip("0123456789.-") or None) if backward else None


def _names_a_value(text: str, sign: int, part: re.Match) -> bool:
    """Whether a bare word is a name and no literal: what code assigns, passes on, calls or reads from."""
    after = text[part.end() : part.end() + 1]
    if after in ("(", "[", ")"):
        return True
    if text[sign] == ":" and text[sign + 1 : sign + 2] != "=":
        return False
    spaced = text[sign - 1 : sign] in (" ", "\t") or part.start() < part.start(3)
    return spaced or after == ","


def pairs(text: str) -> Iterator[tuple[str, list[Part]]]:
    """Names with the parts on their right side. Each character is looked at a few times, however far a name is from its sign."""
    taken = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < taken:
            continue
        name, taken = _name_before(text[taken : sign.start()]), sign.end()
        if name is None:
            continue
        parts, at = [], sign.end()
        while at < len(text) and text[at] in "=:>":
            at += 1
        while part := _LITERAL.match(text, at):
            group = part.lastindex
            firm = group != 3 or not _names_a_value(text, sign.start(), part)
            parts.append(Part(part[group], part.start(group), part.end(group), firm))
            word, at = group == 3, part.end()
            if not (plus := _PLUS.match(text, at)):
                break
            at = plus.end()
        if parts:
            yield name, parts
            # A bare word may be the next name, as in `a: b: c`.
            taken = sign.end() if len(parts) == 1 and word else at


class Value:
    """What a name stands for: spans of literals and values that it was joined of, each once."""

    def __init__(self, parts: list[Span | Value], sample: str):
        self.parts, self.sample, self.told = parts, sample[:SCORED], False

    def tell(self) -> Iterator[Span]:
        """The spans of all its literals that were not told before."""
        stack = [self]
        while stack:
            value = stack.pop()
            if not value.told:
                value.told = True
                stack += [p for p in value.parts if isinstance(p, Value)]
                yield from (p for p in value.parts if isinstance(p, Span))


def lexed_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through other names.

    A bare word that names a value stands for that value; one that names none, where only a name could stand, for nothing.
    """
    known: dict[str, Value] = {}
    found: set[Span] = set()
    for name, parts in pairs(text):
        meant: dict[Span | Value, str] = {}
        for part in parts:
            if part.text in known and not text.startswith(('"', "'"), part.start - 1):
                meant[known[part.text]] = known[part.text].sample
            elif part.firm and part.end > part.start:
                meant[Span(part.start, "lexed", part.end)] = part.text
        if len(meant) == 1 and isinstance(only := next(iter(meant)), Value):
            value = only
        else:
            value = Value(list(meant), "".join(meant.values()))
        known[name] = value
        score = sensitivity(name)
        if score and len(value.sample) >= LEAST_LITERAL and (score >= 1.0 or score + strength(value.sample) > THRESHOLD):
            found.update(value.tell())
    return sorted(found)


def scan(text: str) -> list[Span]:
    """All spans by start, then kind; a lexed literal inside a base span is not told twice."""
    base = sorted(base_spans(text))
    spans, at, reach = list(base), 0, 0
    if "=" in text or ":" in text:
        for span in lexed_spans(text):
            while at < len(base) and base[at].start <= span.start:
                reach, at = max(reach, base[at].end), at + 1
            if span.end > reach:
                spans.append(span)
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def find_secrets(documents: DataFrame) -> DataFrame:
    """Secrets of each text, as spans in code points with exclusive ends.

    One row per row of `documents`: doc_id, spans array<struct<kind, start, end>>.
    Repeated rows each give a row, a null doc_id stays null, a null or empty text has
    no spans, other columns are ignored, an empty table gives an empty table. Time and memory are
    linear in the text: a literal that is joined, or passed on, any number of times is kept once.
    """
    rows = texts_of(documents)
    kind = kind_of(rows, "doc_id")
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": s.kind, "start": s.start, "end": s.end} for s in scan(text)]
            for text in batch.column("text").to_pylist()
        ]
        return pa.record_batch([batch.column("doc_id"), pa.array(spans, pa.list_(item))], ["doc_id", "spans"])

    return map_slices(rows, scanned, f"doc_id {kind}, spans array<struct<kind string, start bigint, end bigint>>")

