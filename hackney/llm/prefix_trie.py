"""The trie of all beginnings of conversations, counted in flat arrays over minimal perfect hashes.

A beginning is named by a 128-bit digest chained over its turns. A shard is a block of rows
of a task: its distinct digests get slots by a minimal perfect hash that checks the stored
digest, counts are scattered into arrays by slot, and sums climb from slot to parent slot,
deepest first. What shards say of the same node is added up by digest, so neither a
beginning that very many conversations share nor a very long conversation meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.frames import cut, pick

# Fixed value: a word is a run of anything but these blanks.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a shard; a longer conversation goes on in the next one.
SHARD_ROWS = 1 << 18
# Ids that are written into one piece before pieces are hashed in order.
PIECE_IDS = 1 << 14
ROOT = b"\0" * 16

_TURN = np.dtype([("hi", np.int64), ("lo", np.int64)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NodeTable:
    """A minimal perfect hash from distinct 128-bit digests to slots 0, 1, ..., which checks what it finds.

    Each level is twice as long as there are digests left. Digests that fall on a place of their own
    take the next slots; the others go on to the next level. A slot keeps its digest, so that a digest
    which is not of the table is told as -1 and never takes another's slot.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        first = np.ones(len(hi), bool)
        first[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        hi, lo = hi[first], lo[first]
        self.size = len(hi)
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        while len(hi):
            long = max(2 * len(hi), 8)
            place = self._place(hi, lo, len(self.levels), long)
            alone = np.bincount(place, minlength=long) == 1
            slots = taken + np.cumsum(alone) - 1
            self.levels.append((alone, slots))
            settled = alone[place]
            self.hi[slots[place[settled]]], self.lo[slots[place[settled]]] = hi[settled], lo[settled]
            taken += int(settled.sum())
            hi, lo = hi[~settled], lo[~settled]

    @staticmethod
    def _place(hi: np.ndarray, lo: np.ndarray, level: int, long: int) -> np.ndarray:
        salted = _mixed(hi.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1)))
        return (_mixed(lo.view(np.uint64) ^ salted) % np.uint64(long)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that the table does not hold."""
        found = np.full(len(hi), -1, np.int64)
        waiting = np.arange(len(hi))
        for level, (alone, slots) in enumerate(self.levels):
            place = self._place(hi[waiting], lo[waiting], level, len(alone))
            here = alone[place]
            found[waiting[here]] = slots[place[here]]
            waiting = waiting[~here]
        held = found >= 0
        at = found[held]
        found[held] = np.where((self.hi[at] == hi[held]) & (self.lo[at] == lo[held]), at, -1)
        return found


def rebuild(conversations: DataFrame, family: int, heads: int, borrowed: Callable[[Column], Column]) -> DataFrame:
    """Turns of conversations whose first turns are those of another one: (conv_id, place, role, text).

    Conversation c takes the first h = borrowed(c) < heads turns of conversation c - c % family, as many
    as that one has, and then its own turns after its first h. A conversation of no turns stays as
    a row without place, role and text. Turns are ordered by turn, nulls first, then role and text;
    null role or text is empty. Rows of a null conv_id are of no conversation and stay out.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order).cast("long"))
    first = placed.where((F.col("conv_id") % family == 0) & (F.col("place") < heads)).drop("turn")
    ids = rows.select("conv_id").distinct()
    takers = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("lender"), borrowed(F.col("conv_id")).alias("h"))
    lent = takers.join(first.withColumnRenamed("conv_id", "lender"), "lender").where("place <= h").select("conv_id", "place", "role", "text")
    own = placed.where(F.col("place") > borrowed(F.col("conv_id"))).select("conv_id", (F.col("place") + heads).alias("place"), "role", "text")
    none = F.lit(None)
    marks = ids.select("conv_id", none.cast("long").alias("place"), none.cast("string").alias("role"), none.cast("string").alias("text"))
    return lent.unionByName(own).unionByName(marks)


def prefixes(turns: DataFrame) -> DataFrame:
    """All beginnings of each conversation: (conv_id, depth, hi, lo, parent_hi, parent_lo, words, ends).

    turns: (conv_id, place, role, text); a row without place tells of a conversation and is no turn.
    hi and lo are the digest's halves, words are those of the last text, ends marks the whole
    conversation. A task streams through its sorted rows and holds one batch.
    """
    names = ["conv_id", "depth", "hi", "lo", "parent_hi", "parent_lo", "words", "ends"]
    kinds = [pa.int64()] * 7 + [pa.bool_()]

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: list[tuple] = []
        current = depth = digest = halves = last = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for conv, place, role, text, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text", "words")), strict=True):
                if conv != current:
                    if last:
                        told.append((*last, True))
                    current, depth, digest, halves = conv, 0, ROOT, (0, 0)
                    last = (conv, 0, 0, 0, None, None, 0)
                if place is None:
                    continue
                told.append((*last, False))
                role_bytes = role.encode()
                digest = hashlib.blake2b(digest + len(role_bytes).to_bytes(8, "big") + role_bytes + text.encode(), digest_size=16).digest()
                depth, parent = depth + 1, halves
                halves = tuple(np.frombuffer(digest, _TURN)[0].tolist())
                last = (conv, depth, *halves, *parent, words)
            yield batch_of(told)
            told = []
        if last:
            yield batch_of([(*last, True)])

    held = pick(turns, "conv_id", "place", "role", "text").withColumn("words", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    streamed = held.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_first())
    return streamed.mapInArrow(chained, "conv_id long, depth long, hi long, lo long, parent_hi long, parent_lo long, words long, ends boolean")


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[dict[str, np.ndarray]]:
    """Columns of `rows` rows at a time, or a batch more; missing values as 0."""
    held: list[pa.RecordBatch] = []

    def arrays() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {f.name: table.column(f.name).fill_null(pa.scalar(0).cast(f.type)).to_numpy() for f in table.schema}

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield arrays()
            held = []
    if held:
        yield arrays()


def nodes_of(beginnings: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Distinct beginnings: (hi, lo, parent_hi, parent_lo, depth, words, conv_id, n_convs); conv_id is the least.

    Each shard scatters its rows into arrays by slot; what shards say of one node is added up.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, shard_rows):
            table = NodeTable(shard["hi"], shard["lo"])
            slot = table.slots(shard["hi"], shard["lo"])
            least = np.full(table.size, np.iinfo(np.int64).max)
            np.minimum.at(least, slot, shard["conv_id"])
            flat = {}
            for name in ("parent_hi", "parent_lo", "depth", "words"):
                flat[name] = np.zeros(table.size, np.int64)
                flat[name][slot] = shard[name]
            columns = {"hi": table.hi, "lo": table.lo, **flat, "conv_id": least, "n_convs": np.bincount(slot, minlength=table.size)}
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns.values()], list(columns))

    schema = "hi long, lo long, parent_hi long, parent_lo long, depth long, words long, conv_id long, n_convs long"
    told = beginnings.drop("ends").mapInArrow(counted, schema)
    same = [F.max(c).alias(c) for c in ("parent_hi", "parent_lo", "depth", "words")]
    return told.groupBy("hi", "lo").agg(*same, F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))


def climbed(beginnings: DataFrame, nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Sums over subtrees: (hi, lo, n_leaves, saved_tokens). nodes: as of nodes_of, with n_children.

    A node's own values go to its least conversation, which has all beginnings that they climb to.
    There they are added to the parent's slot, deepest nodes first, and shards are added up by digest.
    A conversation that a shard cuts off leaves what has climbed so far to the next one.
    """
    root = F.col("depth") == 0
    own = nodes.select(
        "conv_id", "depth", "hi", "lo", "parent_hi", "parent_lo",
        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    nothing = F.lit(0).cast("long")
    paths = beginnings.select("conv_id", "depth", "hi", "lo", "parent_hi", "parent_lo", nothing.alias("leaf"), nothing.alias("saved"))
    rows = own.unionByName(paths).withColumn("top", root)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("depth").desc())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = (np.zeros(0, np.int64),) * 4
        for shard in _shards(batches, shard_rows):
            hi, lo, deep = shard["hi"], shard["lo"], shard["depth"]
            table = NodeTable(hi, lo)
            slot = table.slots(hi, lo)
            depth, parent = np.zeros(table.size, np.int64), np.full(table.size, -1, np.int64)
            up_hi, up_lo, top = np.zeros(table.size, np.int64), np.zeros(table.size, np.int64), np.zeros(table.size, bool)
            depth[slot], up_hi[slot], up_lo[slot], top[slot] = deep, shard["parent_hi"], shard["parent_lo"], shard["top"]
            parent[~top] = table.slots(up_hi[~top], up_lo[~top])
            leaves, saved = np.zeros(table.size, np.int64), np.zeros(table.size, np.int64)
            np.add.at(leaves, slot, shard["leaf"])
            np.add.at(saved, slot, shard["saved"])
            at = table.slots(over[0], over[1])
            here = at >= 0
            np.add.at(leaves, at[here], over[2][here])
            np.add.at(saved, at[here], over[3][here])
            order = np.argsort(-depth, kind="stable")
            for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
                level = level[parent[level] >= 0]
                np.add.at(leaves, parent[level], leaves[level])
                np.add.at(saved, parent[level], saved[level])
            # Parents that stand in the next shard: those of the conversation that is cut off here.
            cut_off = np.flatnonzero((parent < 0) & ~top)
            left = tuple(np.append(x[~here], y) for x, y in zip(over, (up_hi[cut_off], up_lo[cut_off], leaves[cut_off], saved[cut_off]), strict=True))
            over = left
            told = (leaves != 0) | (saved != 0)
            columns = {"hi": table.hi[told], "lo": table.lo[told], "n_leaves": leaves[told], "saved_tokens": saved[told]}
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns.values()], list(columns))

    told = rows.mapInArrow(summed, "hi long, lo long, n_leaves long, saved_tokens long")
    return told.groupBy("hi", "lo").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def ends_digests(beginnings: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending, comma-joined: (hi, lo, ends_sha256).

    The ids are sorted over all tasks and written into pieces; only the pieces of a node meet.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> pa.RecordBatch:
            told = (node[0], node[1], ids[0], ",".join(map(str, ids)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.record_batch([pa.array([v], k) for v, k in zip(told, kinds, strict=True)], ["hi", "lo", "first", "ids"])

        for batch in batches:
            for hi, lo, conv in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "conv_id")), strict=True):
                if node != (hi, lo) or len(ids) >= piece_ids:
                    if ids:
                        yield piece()
                    node, ids = (hi, lo), []
                ids.append(conv)
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []

        def told() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * 3
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["hi", "lo", "ends_sha256"])

        for batch in batches:
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids")), strict=True):
                if node != (hi, lo):
                    if sha:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (hi, lo), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield told()
            done = []
        if sha:
            done = [(*node, sha.hexdigest())]
            yield told()

    ended = beginnings.where("ends").select("hi", "lo", "conv_id")
    spread = ended.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")
    joined = spread.mapInArrow(pieces, "hi long, lo long, first long, ids string")
    return joined.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInArrow(hashed, "hi long, lo long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each distinct beginning of conversations, the empty one (root, depth 0) included.

    turns: (conv_id, place, role, text), ordered by place in a conversation; conv_id is a long and not
    null, role and text are not null, a row without place tells of a conversation and is no turn.
    Returns conv_id (least conversation that begins so), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (summed over the subtree: conversations less one times words of the last
    text) and ends_sha256. Repeated turns are turns of their own, so are empty ones; an empty table gives no node.
    Other columns are ignored.
    """
    beginnings = cut(prefixes(turns))
    nodes = cut(nodes_of(beginnings))
    children = nodes.where("depth > 0").groupBy("parent_hi", "parent_lo").agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed({"parent_hi": "hi", "parent_lo": "lo"})
    nodes = cut(nodes.join(children, ["hi", "lo"], "left").fillna(0, ["n_children"]))
    parents = nodes.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("above"))
    full = (
        nodes.join(climbed(beginnings, nodes), ["hi", "lo"])
        .join(ends_digests(beginnings), ["hi", "lo"], "left")
        .join(parents, ["parent_hi", "parent_lo"], "left")
    )
    return full.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("above")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
