"""Exact top-k search by BM25 over sharded inverted indexes with block-max pruning.

Documents are cut into terms once, whatever number of queries there is: a task packs them
into slices, each with its own words and postings, and the slices are written. Frequencies and
lengths that the scores need are counted over all slices first, so scores of different shards
compare and their best k merge exactly. A task then joins its slices to shards of bounded size,
indexes a shard and runs many queries at a time against it. Rare terms are scored through their
postings, common terms by a product of matrices; a block of documents is left out of it where
the largest impacts in the block cannot lift any of the queries' scores to its k-th best so far.
The product is in single precision; what may be among the best by more than its error is scored
exactly.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.frames import cut, kind_of, texts_of

# The usual parameters of BM25.
K1, B = 1.2, 0.75
TERM = re.compile(r"[^\W_]+")
# Bytes of ASCII between terms, and what blanks them.
BETWEEN = bytes(i for i in range(128) if not chr(i).isalnum())
BLANKED = bytes(32 if i in BETWEEN else i for i in range(256))
# Text of a shard, and of the queries that are broadcast at a time, in bytes. A slice has an eighth of a shard's.
SHARD_BYTES = 24 << 20
# Memory of a shard, by which many short texts end one earlier, and what its building takes for a posting and a document.
SHARD_MEMORY, TOKEN_BYTES, DOCUMENT_BYTES = 384 << 20, 104, 64
QUERY_BYTES = 128 << 20
# Slices whose words are looked up together, and terms whose frequencies are added up together.
LOOKED_UP, COUNTED = 16, 1 << 13
# Documents of a block; a term in more than this share of a shard's documents is common.
BLOCK, COMMON = 256, 1 / 25
# Scores of queries by documents, and postings, that are worked on at a time.
CELLS, POSTINGS = 1 << 20, 1 << 16
# Groups of documents, one of each, that tell how high the k-th best score is at least.
FOLD = 32
# Tasks of a search for each core; a task gives k rows for each query.
TASKS = 8
# Decimals by which scores are ranked, so that the order of additions does not matter.
DECIMALS = 6
SLACK = 2 * 10.0**-DECIMALS


class Queries(NamedTuple):
    """Queries end to end: ids, bounds of each, its terms by number and how often it has each; and the terms."""

    ids: list
    bounds: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    vocabulary: pa.Array


class Slice(NamedTuple):
    """Some documents: ids, tokens of each, bytes of text, and by posting of a term that some query has, in order
    of documents, the document, the term's number and how often it occurs."""

    ids: pa.Array
    lengths: np.ndarray
    size: int
    owner: np.ndarray
    number: np.ndarray
    times: np.ndarray


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.lower())


def spaced(text: str) -> bytes:
    """The terms with blanks between them."""
    text = text.lower()
    told = text.encode()
    # Letters and digits are what isalnum says; between other bytes than ASCII nothing may part terms.
    if text.isascii() or told.translate(None, BETWEEN).decode().isalnum():
        return told.translate(BLANKED)
    return " ".join(TERM.findall(text)).encode()


def read_queries(rows: Iterable[tuple]) -> Queries:
    """Queries that are alike in their most frequent term are neighbours."""
    vocabulary: dict[str, int] = defaultdict(count().__next__)
    ids, terms, times, first = [], [], [], []
    for query_id, text in rows:
        numbers = [vocabulary[t] for t in terms_of(text)]
        own, often = np.unique(np.array(numbers, np.int64), return_counts=True)
        ids.append(query_id)
        terms.append(own.astype(np.int32))
        times.append(often.astype(np.int32))
        first.append(own[often.argmax()] if len(own) else -1)
    order = np.argsort(np.array(first, np.int64), kind="stable").tolist()
    bounds = np.cumsum([0, *(len(terms[i]) for i in order)])
    joined = (np.concatenate([np.zeros(0, np.int32), *(x[i] for i in order)]) for x in (terms, times))
    return Queries([ids[i] for i in order], bounds, *joined, pa.array(list(vocabulary), pa.string()))


def _narrow(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(values.max(initial=0))).tobytes()


def _wide(told: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(told, f"u{len(told) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def packed(ids: pa.Array, texts: list[str], size: int) -> pa.RecordBatch:
    """A row of a slice: see `Slice`, with a number of its own for each of its words."""
    found = pc.ascii_split_whitespace(pa.array([spaced(t) for t in texts], pa.string()))
    told = found.values.dictionary_encode()
    words, word = told.dictionary, told.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(found.offsets.to_numpy()))
    # Blanks at either end give an empty word.
    term = word != pc.index(words, "").as_py()
    owner, word = owner[term], word[term]
    lengths = np.bincount(owner, minlength=len(texts))
    key, times = np.unique(owner * len(words) + word, return_counts=True)
    owner, word = np.divmod(key, max(1, len(words)))
    held = np.bincount(owner, minlength=len(texts))

    def row(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = {"doc_ids": row(ids), "words": pc.binary_join(row(words), "\n")}
    columns |= {name: pa.array([_narrow(x)], pa.binary()) for name, x in (("lengths", lengths), ("held", held), ("word", word), ("times", times))}
    return pa.record_batch(columns | {"size": pa.array([size], pa.int64())})


def unpacked(batches: Iterable[pa.RecordBatch], vocabulary: pa.Array) -> Iterator[Slice]:
    for batch in batches:
        for start in range(0, batch.num_rows, LOOKED_UP):
            some = batch.slice(start, LOOKED_UP)
            words = pc.split_pattern(some.column("words"), "\n")
            ends = np.cumsum(pc.list_value_length(words).to_numpy())
            numbers = np.split(pc.index_in(words.flatten(), value_set=vocabulary).fill_null(-1).to_numpy(), ends[:-1])
            for i, of_word in enumerate(numbers):
                of = {name: some.column(name)[i] for name in some.schema.names}
                ids = of["doc_ids"].values
                lengths, held = (_wide(of[name].as_buffer(), len(ids)) for name in ("lengths", "held"))
                word, times = (_wide(of[name].as_buffer(), int(held.sum())) for name in ("word", "times"))
                number, owner = of_word[word], np.repeat(np.arange(len(ids)), held)
                known = number >= 0
                yield Slice(ids, lengths, of["size"].as_py(), owner[known], number[known].astype(np.int64), times[known])


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places from each begin on, as many as its size says."""
    at = np.repeat(begin - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    return at


def _pieces(size: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbours whose sizes add up to `most` about, so that what is made of them stays in the cache."""
    ends, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield slice(a, b)
        a = b


def memory_of(held: np.ndarray, postings: int, docs: int) -> int:
    """Bytes that a shard takes at most, from how many postings each term has; the common terms' impacts are dense, in both precisions."""
    common = np.count_nonzero(held > max(1.0, COMMON * docs))
    return 12 * common * docs + TOKEN_BYTES * postings + DOCUMENT_BYTES * docs


class Shard:
    """Inverted index of some documents: postings by term, and the common terms as rows of impacts; see `memory_of`."""

    def __init__(self, owner: np.ndarray, number: np.ndarray, lengths: np.ndarray, n_terms: int, mean_length: float, times: np.ndarray | None = None):
        """times: how often each posting's document has its term, postings in order of documents; without it, each is a token."""
        self.count = count = len(lengths)
        self.blocks = -(-count // BLOCK)
        self.width = self.blocks * BLOCK
        if times is None:
            key, times = np.unique(owner * max(1, n_terms) + number, return_counts=True)
            owner, number = np.divmod(key, max(1, n_terms))
            del key
        # Documents that are alike in their most frequent term and length share blocks, so that bounds are close.
        first = np.full(count, -1)
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(edges):
            most = np.repeat(np.maximum.reduceat(times, edges), np.diff(np.append(edges, len(owner))))
            heads = np.flatnonzero(times == most)
            docs, at = np.unique(owner[heads], return_index=True)
            first[docs] = number[heads[at]]
            del most, heads
        self.original = np.lexsort((lengths, first))
        place = np.empty(count, np.int64)
        place[self.original] = np.arange(count)
        by = np.argsort(number * count + place[owner])
        term, doc, times = number[by], place[owner[by]], times[by]
        del by
        norm = K1 * (1 - B + B * lengths[self.original] / max(mean_length, 1e-9))
        impact = times * (K1 + 1) / (times + norm[doc])
        held = np.bincount(term, minlength=n_terms)
        frequent = np.flatnonzero(held > max(1.0, COMMON * count))
        self.row = np.full(n_terms, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        rows = self.row[term]
        common = rows >= 0
        self.exact = np.zeros((len(frequent), self.width))
        self.exact[rows[common], doc[common]] = impact[common]
        self.impacts = self.exact.astype(np.float32)
        self.maxima = self.impacts.reshape(len(frequent), self.blocks, BLOCK).max(2)
        self.doc, self.impact = doc[~common].astype(np.int32), impact[~common]
        held[frequent] = 0
        self.start = np.concatenate([[0], np.cumsum(held)])

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best for a query, by place in the shard, with exact scores."""
        return self.best_of(np.array([0, len(terms)]), terms, weights, k, np.zeros(1))[1:]

    def best_of(self, bounds: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for several queries end to end: the query, the place in the shard, and the score; scores below a query's floor may be left out."""
        n, width = len(bounds) - 1, self.width
        whose, rows = np.repeat(np.arange(n), np.diff(bounds)), self.row[terms]
        frequent = rows >= 0
        sums = self._rare(n, whose[~frequent], terms[~frequent], weights[~frequent])
        whose, rows, weights = whose[frequent], rows[frequent], weights[frequent]
        used, column = np.unique(rows, return_inverse=True)
        if 2 * len(used) > len(self.impacts):
            used, column = slice(None), rows
        asked = np.zeros((n, len(self.maxima[used])), np.float32)
        asked[whose, column] = weights
        # Of sums of as many products, all of them positive, in single precision.
        error = (asked.shape[1] + 8) * 2.0**-23
        needed = np.ones(self.blocks, bool)
        if floor.any():
            reach = sums.reshape(n, self.blocks, BLOCK).max(2) + asked @ self.maxima[used]
            needed = (reach * (1 + error) >= floor[:, None] - SLACK).any(0)
        scores = sums.astype(np.float32)
        edges = np.flatnonzero(np.diff(needed, prepend=False, append=False)) * BLOCK
        for a, b in edges.reshape(-1, 2):
            scores[:, a:b] += asked @ self.impacts[:, a:b][used]

        # The k-th highest of groups of documents is not above the k-th best score.
        heights = scores.reshape(n, FOLD, -1).max(1) if width >= 4 * k * FOLD else scores
        least = np.partition(heights, -k, axis=1)[:, -k] if heights.shape[1] >= k else np.zeros(n)
        beaten = np.maximum(floor, least) * (1 - 2 * error) - SLACK
        hits = np.flatnonzero(scores > np.maximum(beaten, 0.0)[:, None])
        whose_hit, place = np.divmod(hits, width)
        found = sums.reshape(-1)[hits]
        own = np.searchsorted(whose, np.arange(n + 1))
        size = np.diff(own)[whose_hit]
        for piece in _pieces(size, POSTINGS):
            at = _ranges(own[whose_hit[piece]], size[piece])
            pair = np.repeat(np.arange(piece.stop - piece.start), size[piece])
            found[piece] += np.bincount(pair, weights[at] * self.exact[rows[at], place[piece][pair]], piece.stop - piece.start)
        return whose_hit, place, found

    def _rare(self, n: int, whose: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What rare terms add to the score of each query and document."""
        sums = np.zeros((n, self.width))
        begin = self.start[terms]
        size = self.start[terms + 1] - begin
        there = size > 0
        begin, size, cell, weights = begin[there], size[there], whose[there] * self.width, weights[there]
        flat = sums.reshape(-1)
        for piece in _pieces(size, POSTINGS):
            at, often = _ranges(begin[piece], size[piece]), size[piece]
            cells = np.repeat(cell[piece], often)
            cells += self.doc[at]
            np.add.at(flat, cells, self.impact[at] * np.repeat(weights[piece], often))
        return sums


class Best:
    """The k best documents of each query so far, and the score that a further one must reach."""

    def __init__(self, queries: int, k: int, by_id: bool):
        """by_id: ids tell which of equal scores stay; else all that equal the k-th do."""
        self.k, self.by_id = k, by_id
        self.floor = np.zeros(queries)
        self.whose, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0), None

    def add(self, whose: np.ndarray, ids: pa.Array, score: np.ndarray) -> None:
        whose, score = np.concatenate([self.whose, whose]), np.concatenate([self.score, score])
        ids = pa.concat_arrays([self.ids, ids]) if self.ids is not None else ids
        if self.by_id:
            table = pa.table({"whose": whose, "score": score, "id": ids})
            order = pc.sort_indices(table, sort_keys=[("whose", "ascending"), ("score", "descending"), ("id", "ascending")]).to_numpy()
        else:
            order = np.lexsort((-score, whose))
        whose, score = whose[order], score[order]
        begin = np.searchsorted(whose, whose)
        rank = np.arange(len(whose)) - begin
        last = rank == self.k - 1
        self.floor[whose[last]] = score[last]
        kept = rank < self.k if self.by_id else score >= self.floor[whose]
        self.whose, self.score, self.ids = whose[kept], score[kept], ids.take(pa.array(order[kept]))


def sliced(rows: DataFrame) -> DataFrame:
    """Documents cut into terms and packed, a row a slice; see `Slice`."""
    most = max(1, SHARD_BYTES // 8)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.flatnonzero(np.diff(np.cumsum(size) // most, prepend=-1, append=-1))
            for a, b in zip(edges, [*edges[1:], batch.num_rows]):
                part = batch.slice(a, b - a)
                if part.num_rows:
                    yield packed(part.column("doc_id"), part.column("text").to_pylist(), int(size[a:b].sum()))

    schema = f"doc_ids array<{kind_of(rows, 'doc_id')}>, words string, lengths binary, held binary, word binary, times binary, size long"
    return rows.select("doc_id", "text").mapInArrow(pack, schema)


def _frequencies(slices: DataFrame, shared: Broadcast, terms: int) -> tuple[np.ndarray, int, int]:
    """Documents that have each of so many terms, number of documents, number of tokens: over all documents."""

    def told(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([_narrow(x) for x in sums.values()], pa.binary())], ["part", "held"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, both = np.zeros(terms, np.int64), np.zeros(2, np.int64)
        for part in unpacked(batches, shared.value):
            held += np.bincount(part.number, minlength=terms)
            both += len(part.ids), part.lengths.sum()
        yield told({-1: both} | {at // COUNTED: held[at : at + COUNTED] for at in range(0, terms, COUNTED)})

    def wide(part: int, held: bytes) -> np.ndarray:
        return _wide(held, 2 if part < 0 else min(COUNTED, terms - part * COUNTED))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, held in zip(*(x.to_pylist() for x in batch.columns)):
                sums[part] = sums.get(part, 0) + wide(part, held)
        yield told(sums)

    schema = "part long, held binary"
    counted = slices.mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    sums = {part: wide(part, held) for part, held in counted.toLocalIterator()}
    docs, tokens = sums.pop(-1, np.zeros(2, np.int64)).tolist()
    return np.concatenate([np.zeros(0, np.int64), *(sums.get(part, np.zeros(min(COUNTED, terms - part * COUNTED), np.int64)) for part in range(-(-terms // COUNTED)))]), docs, tokens


def _search_block(slices: DataFrame, queries: Queries, k: int, kind: str) -> DataFrame:
    """The k best of each task for a block of queries: (query_id, doc_id, score)."""
    context = slices.sparkSession.sparkContext
    n_terms, n_queries = len(queries.vocabulary), len(queries.ids)
    vocabulary = context.broadcast(queries.vocabulary)
    slices = slices.coalesce(TASKS * context.defaultParallelism)
    held, docs, tokens = _frequencies(slices, vocabulary, n_terms)
    rarity = np.log(1 + (docs - held + 0.5) / (held + 0.5))
    mean_length = tokens / max(docs, 1)
    shared = context.broadcast((*queries[:4], rarity))
    by_id = kind in ("tinyint", "smallint", "int", "bigint", "string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bounds, terms, times, rare = shared.value
        best = Best(n_queries, k, by_id)
        parts: list[Slice] = []
        size, held = 0, np.zeros(n_terms, np.int64)

        def answer() -> None:
            starts = np.cumsum([0, *(len(p.ids) for p in parts)])
            owner = np.concatenate([p.owner + s for p, s in zip(parts, starts)])
            number, often, lengths = (np.concatenate(x) for x in zip(*((p.number, p.times, p.lengths) for p in parts)))
            doc_ids = pa.concat_arrays([p.ids for p in parts])
            parts.clear()
            shard = Shard(owner, number, lengths, n_terms, mean_length, often)
            step = max(1, CELLS // shard.width)
            found = []
            for q in range(0, n_queries, step):
                own = bounds[q : q + step + 1]
                asked = slice(own[0], own[-1])
                weights = times[asked] * rare[terms[asked]]
                whose, place, score = shard.best_of(own - own[0], terms[asked], weights, k, best.floor[q : q + step])
                score = np.round(score, DECIMALS)
                stays = (score > 0) & (score >= best.floor[q + whose])
                found.append((q + whose[stays], shard.original[place[stays]], score[stays]))
            if found:
                whose, place, score = (np.concatenate(x) for x in zip(*found))
                best.add(whose, doc_ids.take(pa.array(place)), score)

        for part in unpacked(batches, vocabulary.value):
            parts.append(part)
            size += part.size
            held += np.bincount(part.number, minlength=n_terms)
            if size >= SHARD_BYTES or memory_of(held, int(held.sum()), sum(len(p.ids) for p in parts)) >= SHARD_MEMORY:
                answer()
                size = 0
                held[:] = 0
        if parts:
            answer()
        if best.ids is not None:
            asked_ids = pa.array(ids, best.ids.type).take(pa.array(best.whose))
            told = pa.record_batch([asked_ids, best.ids, pa.array(best.score)], ["query_id", "doc_id", "score"])
            for start in range(0, told.num_rows, 1 << 16):
                yield told.slice(start, 1 << 16)

    return slices.mapInArrow(search, f"query_id {kind}, doc_id {kind}, score double")


def top_k(documents: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents for each query: query_id, rank (from 1), doc_id, score.

    documents: (doc_id, text); queries: (query_id, text), whole texts of any length. Terms are runs
    of letters and digits in lower case. Scores are BM25 with the queries' term counts as factors,
    rounded to six decimals; equal scores rank by doc_id, nulls last. Documents that share no
    term with a query are not returned, so a null or empty query or text has no rows. Repeated documents
    each take a rank; of queries with one id the least text counts. Other columns are ignored; an empty
    table gives an empty table.

    Documents are read and cut into terms once; the slices are written by `checkpoint()`. Queries are collected and
    broadcast in blocks of about QUERY_BYTES of text, and each block is answered in two passes over the slices, which
    are never shuffled. A task holds one shard of SHARD_BYTES of text or SHARD_MEMORY of postings, whichever is
    reached first, and the k best so far. What is shuffled is k rows by task and query.
    """
    rows = texts_of(documents)
    slices = cut(sliced(rows))
    asked = cut(texts_of(queries, "query_id").where("query_id IS NOT NULL").groupBy("query_id").agg(F.min("text").alias("text")))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    found = None
    for block in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        block_queries = read_queries((r["query_id"], r["text"]) for r in chosen.toLocalIterator())
        best = _search_block(slices, block_queries, k, kind_of(rows, "doc_id"))
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
