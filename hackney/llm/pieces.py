"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A vocabulary of merges has one right segmentation: pieces of which no two
neighbours would have been merged otherwise. Words of equal length advance
together. For each end, all substrings that end there are looked up by hash
among the sorted piece keys; a piece scores its length if it may follow the piece
that the best path of the shorter prefix ends with, and the maximum is stored as
a backpointer. Such a path ends in one way only at each place, so the maxima give
exactly the pieces that merging would give.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from hackney.llm.frames import kind_of, map_slices, texts_of

# The letter that stands for a space, and how byte pieces are written.
SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
# Words of up to that many characters advance together; longer ones are walked through one by one.
LONGEST = 48
# Words of up to LONGEST characters of which a Python worker remembers the pieces.
REMEMBERED = 1 << 18
# Rows whose new words are segmented together.
ENCODED_ROWS = 1024
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.int64(1) << 40
# Fills the rows of words that have fewer pieces than others.
_OVER = -2
# Bits of the tables that tell quickly which hashes no piece has, and which neighbours were asked for before.
_SIEVE_BITS, _ASKED_BITS = 21, 20


def _spread(keys: np.ndarray, bits: int) -> np.ndarray:
    """A place of `bits` bits for each key."""
    return (keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


class PieceTable:
    """Arrays of a vocabulary: sorted hashes of pieces, the two parts of each, and which neighbours merge."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """kinds: `normal`, `byte` or `other` by piece."""
        self.pieces = pieces
        self.bytes_at = np.full(256, -1, np.int32)
        for i, kind in enumerate(kinds):
            if kind == "byte":
                self.bytes_at[int(_BYTE.fullmatch(pieces[i])[1], 16)] = i
        self.unknown = next((i for i, k in enumerate(kinds) if k == "unknown"), 0)
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        # Runs of spaces merge last and among themselves only; they are cut after all else.
        self.runs = {len(pieces[i]): i for i in normal if set(pieces[i]) == {SPACE}}
        words = [i for i in normal if not (set(pieces[i]) == {SPACE} and len(pieces[i]) > 1)]
        order = sorted((i for i in words if len(pieces[i]) > 1), key=lambda i: (-scores[i], i))
        ranks = {pieces[i]: rank for rank, i in enumerate(order)}
        ids = {pieces[i]: i for i in words}
        n = len(pieces)
        # A letter is its own part and was there before all merges. Place n is a letter outside the vocabulary.
        self.rank = np.full(n + 1, -1, np.int64)
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        reached = [i for i in words if len(pieces[i]) == 1]
        for i in order:
            parts = _last_merge(pieces[i], ranks)
            if parts and parts[0] in ids and parts[1] in ids:
                self.rank[i], self.left[i], self.right[i] = ranks[pieces[i]], ids[parts[0]], ids[parts[1]]
                reached.append(i)
        joined = {}
        for i in order:
            piece = pieces[i]
            for cut in range(1, len(piece)):
                if piece[:cut] in ids and piece[cut:] in ids:
                    joined[ids[piece[:cut]] * (n + 1) + ids[piece[cut:]]] = ranks[piece]
        self.pair_keys = np.array(sorted(joined), np.int64)
        self.pair_ranks = np.array([joined[k] for k in self.pair_keys.tolist()], np.int64)
        self.longest = max((len(pieces[i]) for i in reached), default=1)
        hashes = np.array([_hash(pieces[i]) for i in reached], np.uint64)
        by_hash = np.argsort(hashes, kind="stable")
        self.keys, self.key_ids = hashes[by_hash], np.array(reached, np.int64)[by_hash]
        self._open()

    def _open(self) -> None:
        """Tables that every worker makes for itself."""
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[_spread(self.keys, _SIEVE_BITS)] = True
        self.asked = np.full(1 << _ASKED_BITS, -1, np.int64)
        self.answers = np.zeros(1 << _ASKED_BITS, bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("sieve", "asked", "answers")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._open()

    def piece_of(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 for none. Most hashes are told apart before the sorted keys are searched."""
        found = np.full(hashes.shape, -1, np.int64)
        likely = np.nonzero(self.sieve[_spread(hashes, _SIEVE_BITS)])
        asked = hashes[likely]
        place = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        found[likely] = np.where(self.keys[place] == asked, self.key_ids[place], -1)
        return found

    def neighbours(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """As may_follow; answers are remembered, the last one for each place of a table."""
        pairs = first * (len(self.pieces) + 1) + second
        place = _spread(pairs, _ASKED_BITS)
        new = np.flatnonzero(self.asked[place] != pairs)
        good = self.answers[place]
        if len(new):
            keys, first_at, back = np.unique(pairs[new], return_index=True, return_inverse=True)
            told = self.may_follow(first[new[first_at]], second[new[first_at]])
            good[new] = told[back]
            where = _spread(keys, _ASKED_BITS)
            self.asked[where], self.answers[where] = keys, told
        return good

    @classmethod
    def read(cls, path: str) -> PieceTable:
        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            if model.is_unknown(i):
                return "unknown"
            return "other" if model.is_control(i) or model.is_unused(i) else "normal"

        every = range(model.get_piece_size())
        return cls([model.id_to_piece(i) for i in every], [model.get_score(i) for i in every], [kind(i) for i in every])

    def may_follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between two pieces alone, for many pairs at once.

        The merges that made the two pieces are undone, the latest first. At each stage the two parts
        at the border stood side by side until the merge just undone; were their own merge earlier,
        it would have come first. Of equal merges the left one comes first.
        """
        first, second = first.copy(), second.copy()
        good = np.ones(len(first), bool)
        limit = np.full(len(first), _NEVER)
        at = np.arange(len(first))
        width = len(self.pieces) + 1
        while len(at):
            a, b = first[at], second[at]
            keys = a * width + b
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[place] == keys, self.pair_ranks[place], _NEVER)
            bad = merged < limit[at]
            good[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go_on = ~bad & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go_on], a[go_on], b[go_on], ra[go_on], rb[go_on]
            undo_first = ra > rb
            limit[at] = np.where(undo_first, ra, rb + 1)
            first[at] = np.where(undo_first, self.right[a], a)
            second[at] = np.where(undo_first, b, self.left[b])
        return good

    def segment(self, words: list[str]) -> np.ndarray:
        """Pieces of words of one length, a row each, filled up in front; -1 is a letter outside the vocabulary."""
        length, count = len(words[0]), len(words)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(count, length).astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((count, length + 1), np.uint64)
        for i in range(length):
            prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i]
        wide = min(self.longest, length)
        last = np.full((count, length + 1), -1, np.int64)
        back = np.zeros((count, length + 1), np.int64)
        outside = len(self.pieces)
        for end in range(1, length + 1):
            sizes = np.arange(1, min(end, wide) + 1)
            powers = np.array([pow(int(_BASE), int(k), 1 << 64) for k in sizes], np.uint64)
            hashes = prefix[:, end, None] - prefix[:, end - sizes] * powers
            found = self.piece_of(hashes)
            found[:, 0] = np.where(found[:, 0] < 0, outside, found[:, 0])
            score = np.where(found >= 0, sizes, -1)
            row, column = np.nonzero(found >= 0)
            before = last[row, end - sizes[column]]
            # A prefix that no path reaches has no last piece; the empty one needs none.
            score[row[(before < 0) & (sizes[column] < end)], column[(before < 0) & (sizes[column] < end)]] = -1
            check = before >= 0
            row, column, before = row[check], column[check], before[check]
            score[row, column] = np.where(self.neighbours(before, found[row, column]), score[row, column], -1)
            best = score.argmax(axis=1)
            reached = score[np.arange(count), best] > 0
            last[reached, end] = found[reached, best[reached]]
            back[:, end] = best + 1
        # All words walk back together; those that are through stay at 0.
        steps, at, rows = [], np.full(count, length), np.arange(count)
        while at.any():
            steps.append(np.where(at > 0, last[rows, at], _OVER))
            at = at - back[rows, at]
        pieces = np.stack(steps[::-1], axis=1)
        return np.where(pieces == outside, -1, pieces)


def _hash(piece: str) -> int:
    total = 0
    for letter in piece:
        total = (total * int(_BASE) + ord(letter) + 1) % (1 << 64)
    return total


def _last_merge(piece: str, ranks: dict[str, int]) -> tuple[str, str] | None:
    """The two parts whose merge completes a piece; None if merging its letters does not lead to it."""
    parts = list(piece)
    while len(parts) > 2:
        options = [(ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, at = min(options)
        if rank == _NEVER:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1])


class Pieces:
    """Encoder and decoder; short words once seen are remembered."""

    def __init__(self, table: PieceTable):
        """Texts are cut where no piece of the vocabulary reaches across.

        A space goes with the word after it. Line ends and tabs stand alone if they are in no piece,
        and a word ends before a sign that follows a letter or digit in no piece.
        """
        self.table = table
        reached = [table.pieces[i] for i in table.key_ids.tolist() if len(table.pieces[i]) > 1]
        letters, after_word = set("".join(reached)), {b for p in reached for a, b in zip(p, p[1:]) if a.isalnum() or a == "_"}
        apart = "".join(c for c in "\n\t" if c not in letters)
        firm = re.escape("".join(c for c in "\n\t" + string.punctuation if c not in after_word and c != "_"))
        self.cutter = re.compile(rf" ?\w+(?![^ {firm}])| ?[^ {apart}]+|[ {apart}]")
        self.known: dict[str, bytes] = {}
        # Words whose pieces do not spell them.
        self.lossy: set[str] = set()
        self.cut_runs: dict[int, list[int]] = {}
        self.space_id = table.runs.get(1, table.unknown)
        self.shown = [p.replace(SPACE, " ") for p in table.pieces]
        self.is_byte = np.zeros(len(table.pieces), bool)
        self.is_byte[table.bytes_at[table.bytes_at >= 0]] = True

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}, "lossy": set()}

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of each word, as 32-bit integers."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        found: dict[str, bytes] = {}
        for length, group in by_length.items():
            if length > LONGEST:
                found.update((w, self.ids_of(w, self.walk(w.replace(" ", SPACE)))) for w in group)
                continue
            for i in range(0, len(group), 4096):
                chosen = group[i : i + 4096]
                paths = self.table.segment([w.replace(" ", SPACE) for w in chosen])
                used = paths != _OVER
                flat, ends = paths[used].astype(np.int32).tobytes(), 4 * np.cumsum(used.sum(axis=1))
                odd = (paths == -1).any(axis=1)
                ends = ends.tolist()
                found.update(zip(chosen, map(flat.__getitem__, map(slice, [0, *ends], ends)), strict=True))
                for row in np.flatnonzero(odd).tolist():
                    found[chosen[row]] = self.ids_of(chosen[row], paths[row][used[row]])
        return found

    def ids_of(self, word: str, path: np.ndarray) -> bytes:
        """A path's ids, letters outside the vocabulary written as their bytes."""
        ids, at = [], 0
        for piece in path.tolist():
            if piece >= 0:
                ids.append(piece)
                at += len(self.table.pieces[piece])
            else:
                coded = self.table.bytes_at[list(word[at].encode())]
                ids += coded.tolist() if (coded >= 0).all() else [self.table.unknown]
                at += 1
        return np.array(ids, np.int32).tobytes()

    def walk(self, word: str) -> np.ndarray:
        """The same recurrence for one long word, with a dictionary in place of the sorted keys."""
        table, outside = self.table, len(self.table.pieces)
        if not hasattr(self, "places"):
            self.places = {table.pieces[i]: i for i in table.key_ids.tolist()}
            self.allowed: dict[tuple[int, int], bool] = {}
        last, back = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for size in range(min(end, table.longest), 0, -1):
                piece = self.places.get(word[end - size : end], outside if size == 1 else -1)
                before = last[end - size]
                if piece < 0 or (before < 0 and size < end):
                    continue
                if before >= 0:
                    pair = (before, piece)
                    if pair not in self.allowed:
                        if len(self.allowed) >= REMEMBERED:
                            self.allowed.clear()
                        self.allowed[pair] = bool(table.may_follow(np.array([before]), np.array([piece]))[0])
                    if not self.allowed[pair]:
                        continue
                last[end], back[end] = piece, size
                break
        path, end = [], len(word)
        while end > 0:
            path.append(last[end])
            end -= back[end]
        found = np.array(path[::-1])
        return np.where(found == outside, -1, found)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. A space is put before it; an empty text has no ids."""
        return [ids for ids, _ in self.encode_checked(texts)]

    def encode_checked(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether they spell it: its words are the whole text, and the ids of each spell the word.

        Short words are remembered with their ids, and are decoded once.
        """
        given = [" " + t.replace(SPACE, " ") if t else "" for t in texts]
        cut = [self.cutter.findall(t) for t in given]
        words = set().union(*cut)
        new = words - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            self.lossy.clear()
            new = words
        found = self.encode_words(new)
        spelt = self.spell(np.frombuffer(b"".join(found.values()), np.int32)) == "".join(found)
        lossy = set() if spelt else {w for w, ids in found.items() if self.spell(np.frombuffer(ids, np.int32)) != w}
        self.known.update(found)
        ids = [self.merge_spaces(np.frombuffer(b"".join(map(self.known.__getitem__, w)), np.int32)) for w in cut]
        lossy |= self.lossy
        whole = ["".join(w) == t and not (lossy and lossy.intersection(w)) for w, t in zip(cut, given, strict=True)]
        for word in found:
            if len(word) > LONGEST:
                del self.known[word]
        self.lossy = {w for w in lossy if len(w) <= LONGEST}
        return list(zip(ids, whole, strict=True))

    def merge_spaces(self, ids: np.ndarray) -> np.ndarray:
        """Runs of lone spaces cut as merging from the left does."""
        lone = ids == self.space_id
        if len(self.table.runs) < 2 or not (lone[1:] & lone[:-1]).any():
            return ids
        edges = np.flatnonzero(np.diff(np.concatenate([[0], lone.view(np.int8), [0]])))
        parts, at = [], 0
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            parts += [ids[at:begin], np.array(self.space_run(end - begin), np.int32)]
            at = end
        return np.concatenate([*parts, ids[at:]])

    def space_run(self, length: int) -> list[int]:
        """Pieces of a run of spaces: of all pairs that make a piece, the leftmost merges first."""
        if length in self.cut_runs:
            return self.cut_runs[length]
        runs, sizes, after = self.table.runs, [1] * length, list(range(1, length + 1))
        before = list(range(-1, length))
        heap = list(range(length - 1)) if 2 in runs else []
        while heap:
            at = heappop(heap)
            if not sizes[at] or (then := after[at]) >= length or sizes[at] + sizes[then] not in runs:
                continue
            sizes[at] += sizes[then]
            sizes[then], after[at] = 0, after[then]
            before[after[at]] = at
            heappush(heap, at)
            if before[at] >= 0:
                heappush(heap, before[at])
        found = [runs[s] for s in sizes if s]
        if len(self.cut_runs) < 1000:
            self.cut_runs[length] = found
        return found

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, the first space left out."""
        return self.spell(ids).removeprefix(" ")

    def spell(self, ids: np.ndarray) -> str:
        """What ids spell: spaces for their letter, bytes put together."""
        parts = list(map(self.shown.__getitem__, ids.tolist()))
        coded = np.flatnonzero(self.is_byte[ids])
        if len(coded):
            # Each run of byte pieces is decoded where it begins.
            for run in np.split(coded, np.flatnonzero(np.diff(coded) > 1) + 1):
                told = bytes(int(_BYTE.fullmatch(self.table.pieces[ids[i]])[1], 16) for i in run)
                parts[run[0]] = told.decode("utf-8", "replace")
                for i in run[1:]:
                    parts[i] = ""
        return "".join(parts)


def _shared(frame: DataFrame, path: str):  # noqa: ANN202
    """The vocabulary, read on the driver and broadcast: some megabytes, whatever the data."""
    return frame.sparkSession.sparkContext.broadcast(Pieces(PieceTable.read(path)))


def encode(documents: DataFrame, path: str) -> DataFrame:
    """Ids of each whole text, and proof that they decode to it: doc_id, ids array<int>, n_ids, lossless.

    One row per row of `documents`; a null or empty text has no ids, a null doc_id stays null,
    repeated rows are encoded alike, other columns are ignored, an empty table gives an empty
    table. The letter that stands for a space is read as one, as the format has it.
    """
    rows = texts_of(documents)
    shared = _shared(documents, path)

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces, texts = shared.value, batch.column("text").to_pylist()
        ids, lossless = zip(*pieces.encode_checked(texts)) if texts else ((), ())
        sizes = [len(i) for i in ids]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        flat = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        columns = [batch.column("doc_id"), flat, pa.array(sizes, pa.int64()), pa.array(lossless, pa.bool_())]
        return pa.record_batch(columns, ["doc_id", "ids", "n_ids", "lossless"])

    return map_slices(rows, encoded, f"doc_id {kind_of(rows, 'doc_id')}, ids array<int>, n_ids long, lossless boolean", ENCODED_ROWS)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ids: doc_id, text. Null ids give the empty text."""
    shared = _shared(encoded, path)
    rows = encoded.select("doc_id", "ids")

    def decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [shared.value.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_slices(rows, decoded, f"doc_id {kind_of(rows, 'doc_id')}, text string")
