"""Token counts by byte-pair merging over a heap and a linked list.

The text is cut into pieces by the vocabulary's pattern. Inside a piece the
adjacent pair of lowest rank is merged until none is left. A piece of n bytes
that takes m merges has n - m tokens; no identifiers are made.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.frames import kind_of, map_slices, texts_of

# Fixed value: the cutting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Counts of that many distinct pieces, and as many words, of up to so many characters are remembered in a Python worker.
REMEMBERED, LONGEST = 1 << 18, 64
# A space before more white space can end a piece; before anything else it always begins one.
_WIDE_BLANK = re.compile(r" (?:\s|$)")

# Bits of a position, and of a symbol, in a heap entry or a pair's key.
_BITS = 32
_LOW = (1 << _BITS) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes in turn for the characters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Remembered(dict):
    """Counts by word. Long words are counted each time, and a full table starts anew, so it stays within some tens of megabytes."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        found = self.count(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class PairMerger:
    """Merge ranks, and a counter of tokens that remembers common pieces."""

    def __init__(self, merges: list[tuple[str, str]], specials: list[str]):
        number = {letter: i for i, letter in enumerate(byte_letters())}
        # A pair's key holds both symbols; its value holds the rank above the place for a position.
        self.pairs: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        for rank, (left, right) in enumerate(merges):
            whole = number.setdefault(left + right, len(number))
            self.merges.append((number[left], number[right], whole))
            self.pairs[number[left] << _BITS | number[right]] = rank << _BITS
        self.specials = specials

    @classmethod
    def read(cls, path: str) -> PairMerger:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in told["model"]["merges"]]
        return cls(merges, [t["content"] for t in told["added_tokens"]])

    def __getstate__(self) -> dict:
        return {"pairs": self.pairs, "merges": self.merges, "specials": self.specials}

    def __getattr__(self, name: str):
        # Made once in each process, not sent with the table.
        if name == "remembered":
            self.remembered = Remembered(lambda piece: self.piece_tokens(piece.encode())).__getitem__
        elif name == "remembered_word":
            self.remembered_word = Remembered(lambda word: self.cut_tokens(" " + word)).__getitem__
        elif name == "cutter":
            self.cutter = regex.compile(PATTERN)
        elif name == "special":
            self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
        else:
            raise AttributeError(name)
        return self.__dict__[name]

    def piece_tokens(self, piece: bytes) -> int:
        """Initial symbols less merges."""
        count = end = len(piece)
        if end < 2:
            return end
        find, merges = self.pairs.get, self.merges
        symbols = [*piece, -1]
        heap = []
        for at in range(end - 1):
            if (found := find(symbols[at] << _BITS | symbols[at + 1])) is not None:
                heap.append(found | at)
        if not heap:
            return end
        heapify(heap)
        before, after = list(range(-1, end)), list(range(1, end + 2))
        while heap:
            entry = heappop(heap)
            at = entry & _LOW
            left, right, whole = merges[entry >> _BITS]
            follower = after[at]
            # An entry is stale once either symbol has been merged into another.
            if symbols[at] != left or symbols[follower] != right:
                continue
            symbols[at], symbols[follower] = whole, -1
            count -= 1
            beyond = after[at] = after[follower]
            if beyond < end:
                before[beyond] = at
                if (found := find(whole << _BITS | symbols[beyond])) is not None:
                    heappush(heap, found | at)
            ahead = before[at]
            if ahead >= 0 and (found := find(symbols[ahead] << _BITS | whole)) is not None:
                heappush(heap, found | ahead)
        return count

    def text_tokens(self, text: str) -> int:
        """Tokens of a text; each special string is one token and parts the text before it from what follows."""
        if self.specials and any(s in text for s in self.specials):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.plain_tokens, parts))
        return self.plain_tokens(text)

    def plain_tokens(self, text: str) -> int:
        """The same sum as over all pieces; words between single spaces are remembered whole."""
        if _WIDE_BLANK.search(text):
            return self.cut_tokens(text)
        first, *rest = text.split(" ")
        return self.cut_tokens(first) + sum(map(self.remembered_word, rest))

    def cut_tokens(self, text: str) -> int:
        return sum(map(self.remembered, self.cutter.findall(text)))


def count_tokens(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than `limit` tokens.

    One row per row of `documents`: doc_id, n_bytes, n_tokens, over_limit. Repeated
    rows are counted each for itself, a null doc_id stays null, a null or empty text
    has 0 bytes and 0 tokens, a null-free but huge text costs n log n in its longest
    piece. Other columns are ignored. An empty table gives an empty table.

    The rank table is read on the driver and broadcast; it has one entry per merge
    of the vocabulary and does not grow with the data.
    """
    rows = texts_of(documents)
    table = documents.sparkSession.sparkContext.broadcast(PairMerger.read(path))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        merger = table.value
        counts = pa.array(map(merger.text_tokens, batch.column("text").to_pylist()), pa.int64())
        return pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), counts], ["doc_id", "n_bytes", "n_tokens"])

    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counts = map_slices(sized, counted, f"doc_id {kind_of(rows, 'doc_id')}, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
