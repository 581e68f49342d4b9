"""Near copies by BagMinHash: sign, band, verify the overlap of bags, and join links to classes.

Documents with equal bags are one node from the start. Nodes that share a band of
their signatures meet in a bucket. Small buckets compare all pairs. A larger one first
compares each node with a hub, which settles dense groups in linear work: what is near the
hub is in its class, and the triangle inequality tells what cannot be near each other.
What a hub leaves open is compared in one task if it fits there. A larger group is dealt anew by
its rarest shingles first: two nodes can only be near if they share one of the few that make up
a fifth of either bag, so that what merely resembles a large group meets nobody. Nodes that
very many share even those with are compared in blocks, so no pair is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm import bags
from hackney.llm.frames import cut, map_slices, pick

SHINGLE = 5
SIMILARITY = 0.8
# 26 bands of 5: a pair at 0.8 shares one with probability 0.99997, a pair at 0.3 with 0.06.
BANDS, ROWS = 26, 5
# Texts that are signed at a time in a task.
SIGNED_ROWS = 128
# Buckets of up to that many nodes compare all pairs: 3.5 a node at most.
SMALL = 8
# Nodes of a block and characters of their texts, on average, at most. Two blocks meet in a task.
BLOCK, BLOCK_CHARS = 2048, 1 << 22


def signed(texts: DataFrame, seed: int) -> DataFrame:
    """Node and band keys of each row's text; null for a text without words. Columns but `text` are kept."""
    kept = [f for f in texts.schema.fields if f.name != "text"]

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = bags.bags_of(batch.column("text").to_pylist(), SHINGLE)
        nodes = bags.nodes_of(held)
        keys = bags.band_keys(bags.signatures(held, BANDS * ROWS, seed), BANDS, seed)
        told = [k if n is not None else None for n, k in zip(nodes, keys.tolist(), strict=True)]
        columns = [*(batch.column(f.name) for f in kept), pa.array(nodes, pa.int64()), pa.array(told, pa.list_(pa.int64()))]
        return pa.record_batch(columns, [*(f.name for f in kept), "node", "bands"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "node long", "bands array<long>"])
    return map_slices(texts, sign, schema, SIGNED_ROWS)


def buckets_of(nodes: DataFrame) -> DataFrame:
    """Buckets of two nodes and more: (key, node, chars, size). nodes: (node, chars, bands), each node once."""
    members = nodes.select("node", "chars", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(shared, "key")


def small_pairs(buckets: DataFrame) -> DataFrame:
    """All pairs of the small buckets: (a, b), a < b."""
    small = buckets.where(F.col("size") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("n"))
    every = "flatten(transform(n, (x, i) -> transform(slice(n, i + 2, size(n)), y -> struct(x AS a, y AS b))))"
    return small.select(F.explode(F.expr(every)).alias("p")).select("p.a", "p.b")


def hub_pairs(buckets: DataFrame) -> DataFrame:
    """Nodes of large buckets and the bucket's hub: (key, node, chars, a, b), a < b.

    The hub is the node that meets most others in all its large buckets, which is the original where
    copies of it were edited in different places.
    """
    large = buckets.where(F.col("size") > SMALL).select("key", "node", "chars", "size")
    # A node is in as many buckets as it has bands, or shingles.
    met = large.withColumn("met", F.sum("size").over(Window.partitionBy("node")))
    place = F.struct("met", F.xxhash64("node").alias("place"), "node")
    hubs = met.groupBy("key").agg(F.max(place).alias("first")).select("key", F.col("first.node").alias("hub"))
    held = large.join(hubs, "key").where(F.col("node") != F.col("hub"))
    return held.select("key", "node", "chars", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The exact overlap of each pair's bags: (a, b, similarity). texts: (node, text)."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                left, right = part.column("text_a").to_pylist(), part.column("text_b").to_pylist()
                # A hub's text stands in many pairs; its bag is made once.
                place = {t: i for i, t in enumerate(dict.fromkeys([*left, *right]))}
                held = bags.bags_of(list(place), SHINGLE)
                bounds = held.bounds()
                found = [bags.overlap(held, place[x], place[y], bounds) for x, y in zip(left, right, strict=True)]
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, similarity double")


def open_groups(met: DataFrame, verdicts: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Nodes of large buckets that may be near each other though the hub does not tell, as `grouped` gives them.

    With distance 1 - similarity, which is a metric, a node near an outsider is at most one threshold
    nearer to the hub than the outsider is. Nodes of one component so far need no further link.
    met: as of hub_pairs; labels: (node, label).
    """
    told = met.join(verdicts, ["a", "b"]).select("key", "node", "chars", "similarity").join(labels, "node", "left")
    told = cut(told.select("key", "node", "chars", "similarity", F.coalesce("label", "node").alias("label")))
    outside = told.where(F.col("similarity") < similarity).groupBy("key").agg(F.max("similarity").alias("nearest"))
    reach = 1.0 - similarity
    waiting = told.join(outside, "key").where(F.col("similarity") <= F.col("nearest") + reach + 1e-9)
    return grouped(waiting.select("key", "node", "chars", "label"))


def grouped(members: DataFrame) -> DataFrame:
    """The groups with several labels: (key, node, chars, label, size, total), total being the characters of all texts."""
    told = [F.count(F.lit(1)).alias("size"), F.sum("chars").alias("total"), F.min("label").alias("low"), F.max("label").alias("high")]
    several = members.groupBy("key").agg(*told).where("low < high")
    return members.join(several, "key").select("key", "node", "chars", "label", "size", "total")


def rare_buckets(open_nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Nodes dealt by their rarest shingles: (key, node, chars, size), for keys of several labels. open_nodes: (node, chars, label).

    Shingles are in one order, the rarest among these nodes first. From the rarest shingle that two near bags share on, either bag
    holds their whole overlap: `similarity` of the larger bag at least, and 2 s / (1 + s) of the smaller one. So near nodes of
    different labels share a key which stands early enough in both; a key without a smaller bag of that kind tells of no pair.
    """

    def spell(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = bags.bags_of(batch.column("text").to_pylist(), SHINGLE)
        node, chars, label = (batch.column(name).to_numpy()[held.owner] for name in ("node", "chars", "label"))
        columns = [node, chars, label, held.totals()[held.owner], held.shingle.view(np.int64), held.times]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["node", "chars", "label", "total", "key", "times"])

    held = open_nodes.join(texts, "node").select("node", "chars", "label", "text")
    spelled = cut(map_slices(held, spell, "node long, chars long, label long, total long, key long, times long", SIGNED_ROWS))
    shared = spelled.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("label").alias("low"), F.max("label").alias("high")).where("held > 1")
    # A shingle of one label only is no key, but it counts as overlap.
    known = spelled.join(shared, "key")
    left = F.sum("times").over(Window.partitionBy("node").orderBy(F.col("held").desc(), F.col("key").desc()))
    early = known.withColumn("left", left).where(F.col("left") >= similarity * F.col("total") - 1e-6).where("low < high")
    lesser = F.col("left") >= 2 * similarity / (1 + similarity) * F.col("total") - 1e-6
    members = early.select("key", "node", "chars", "total", F.when(lesser, F.col("total")).alias("lesser"))
    met = members.groupBy("key").agg(F.min("lesser").alias("least"), F.count(F.lit(1)).alias("held")).where("least IS NOT NULL AND held > 1")
    members = members.join(met, "key").where("lesser IS NOT NULL OR total >= least").select("key", "node", "chars")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(sizes, "key")


def linked_in(similarity: float) -> Callable[[pa.Table], pa.Table]:
    """Compares two blocks of a group, or one with itself: links that join the components of its nodes.

    A pair is compared in the first bucket that it shares, and only while its nodes are in different components.
    """

    def compare(cell: pa.Table) -> pa.Table:
        key, i, j = (cell.column(name)[0].as_py() for name in ("key", "i", "j"))
        node, label, block = (cell.column(name).to_numpy() for name in ("node", "label", "block"))
        label = label.copy()
        bands = np.array(cell.column("bands").to_pylist(), np.int64)
        parts = []
        for start in range(0, cell.num_rows, SIGNED_ROWS):
            part = bags.bags_of(cell.column("text").slice(start, SIGNED_ROWS).to_pylist(), SHINGLE)
            parts.append((part.owner + start, part.shingle, part.times))
        held = bags.Bags(cell.num_rows, *(np.concatenate(p) for p in zip(*parts, strict=True)))
        bounds, totals = held.bounds(), held.totals()
        entry = np.unique(held.shingle, return_inverse=True)[1]
        weight = np.zeros(len(entry), np.int64)
        links = []
        for x in np.flatnonzero(block == i):
            wanted = (block == j) & (label != label[x])
            if i == j:
                wanted &= node > node[x]
            shared = bands == bands[x]
            wanted &= bands[x][shared.argmax(axis=1)] == key
            if not wanted.any():
                continue
            span = slice(bounds[x], bounds[x + 1])
            weight[entry[span]] = held.times[span]
            both = np.bincount(held.owner, np.minimum(weight[entry], held.times), held.count)
            weight[entry[span]] = 0
            near = np.flatnonzero(wanted & (both / (totals[x] + totals - both) >= similarity))
            joined, first = np.unique(label[near], return_index=True)
            links += [(min(node[x], node[y]), max(node[x], node[y])) for y in near[first]]
            label[np.isin(label, joined)] = label[x]
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return compare


def block_links(groups: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links of all open pairs of groups, joined by components: (a, b). groups: as of open_groups; nodes: (node, bands).

    A group's nodes are dealt to blocks, and every two blocks meet in a task of their own, but for blocks of the label that
    most of the group has: such nodes need no further link to each other, so they only meet the blocks of the others.
    """
    labels = groups.groupBy("key", "label").agg(F.count(F.lit(1)).alias("held"), F.sum("chars").alias("chars"))
    most = F.max(F.struct("held", "label", "chars"))
    dealt = labels.groupBy("key").agg(most.alias("most"), F.sum("held").alias("held"), F.sum("chars").alias("chars"))

    def blocks(held: Column, chars: Column) -> Column:
        return F.greatest(F.ceil(held / BLOCK), F.ceil(chars / BLOCK_CHARS), F.lit(1).cast("long"))

    rest = blocks(F.col("held") - F.col("most.held"), F.col("chars") - F.col("most.chars"))
    dealt = dealt.select("key", F.col("most.label").alias("main"), blocks(F.col("most.held"), F.col("most.chars")).alias("first"), rest.alias("rest"))
    inner = F.col("label") == F.col("main")
    place = F.xxhash64("node", "key")
    block = F.when(inner, F.pmod(place, "first")).otherwise(F.col("first") + F.pmod(place, "rest"))
    others = F.sequence(F.when(inner, F.col("first")).otherwise(F.lit(0).cast("long")), F.col("first") + F.col("rest") - 1)
    placed = groups.join(dealt, "key").select("key", "node", "label", block.alias("block"), F.explode(others).alias("other"))
    cells = placed.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "label", "block")
    held = groups.select("node").distinct().join(nodes, "node").join(texts, "node")
    return cells.join(held, "node").groupBy("key", "i", "j").applyInArrow(linked_in(similarity), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """The least node of each node's component: (node, label). links: (a, b).

    Labels pass along links and then jump to the label's own label, so that the number of rounds
    grows with the logarithm of a component's width. A hub's messages are reduced in the tasks that
    make them. Every round is written to the shared folder.
    """
    edges = cut(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    labels = cut(edges.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")))
    while True:
        told = edges.join(labels.select(F.col("node").alias("other"), F.col("label").alias("heard")), "other")
        heard = told.groupBy("node").agg(F.min("heard").alias("heard"))
        nearer = labels.join(heard, "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = cut(nearer.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")))
        changed = moved.where(F.col("was") != F.col("label")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def find_links(rows: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Links between different bags: (a, b). rows: (doc_id, text, text_key); reps: (node, chars, doc_id, text_key, bands)."""
    buckets = cut(buckets_of(reps))
    wanted = buckets.select("node").distinct().join(reps.select("node", "doc_id", "text_key"), "node")
    # Id and text find a node's row; where both repeat, one row is taken where the join has put them.
    same = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "text_key"]
    texts = cut(
        rows.select(*same, "text")
        .join(wanted.select("node", *same), ["id", "text_key"])
        .dropDuplicates(["id", "text_key"])
        .select("node", "text")
    )

    def settle(dealt: DataFrame, links: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """All links so far, and the groups that hubs of these buckets leave open."""
        met = cut(hub_pairs(dealt))
        verdicts = cut(compared(small_pairs(dealt).unionByName(met.select("a", "b")).distinct(), texts))
        near = verdicts.where(F.col("similarity") >= similarity).select("a", "b")
        links = near if links is None else cut(links.unionByName(near).distinct())
        return links, cut(open_groups(met, verdicts, components(links), similarity))

    fits = (F.col("size") <= BLOCK) & (F.col("total") <= BLOCK_CHARS)
    links, groups = settle(buckets, None)
    if groups.isEmpty():
        return links
    wide = groups.where(~fits)
    if not wide.isEmpty():
        rare = cut(rare_buckets(wide.select("node", "chars", "label").distinct(), texts, similarity))
        links, crowds = settle(rare, links)
        # Nodes of crowds, in the groups that were too large, with the labels that they have by now.
        crowded = wide.select("key", "node", "chars").join(crowds.select("node", "label").distinct(), "node")
        groups = cut(groups.where(fits).unionByName(grouped(crowded.select("key", "node", "chars", "label"))))
    return links.unionByName(block_links(groups, reps.select("node", "bands"), texts, similarity)).distinct()


def find_classes(documents: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, text_key, node) of each row, and (node, class_id, class_size, kept_row) of nodes in classes of two rows and more.

    The row that is kept is the least by id, nulls last, then by text, then by a number that tells equal rows apart.
    """
    rows = pick(documents, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text")).withColumn("chars", F.char_length("text").cast("long"))
    marked = cut(signed(rows, 0).withColumn("row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "row")).alias("r")
    reps = cut(
        marked.where("node IS NOT NULL")
        .groupBy("node")
        .agg(first, F.min(F.struct("row", "bands")).alias("b"), F.max("chars").alias("chars"), F.count(F.lit(1)).alias("rows"))
        .select("node", "rows", "chars", "r.last", "r.doc_id", "r.text_key", "r.row", F.col("b.bands").alias("bands"))
    )
    labels = components(find_links(rows, reps, similarity))
    named = reps.drop("bands", "chars").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = F.min(F.struct("last", "doc_id", "text_key", "row")).alias("r")
    sizes = named.groupBy("label").agg(least, F.sum("rows").alias("class_size")).where("class_size > 1")
    sizes = sizes.select("label", "class_size", F.col("r.doc_id").alias("class_id"), F.col("r.row").alias("kept_row"))
    marked = marked.select("row", "doc_id", "text_key", "node")
    return marked, named.select("node", "label").join(sizes, "label").select("node", "class_id", "class_size", "kept_row")


def near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The class of near copies of each document: doc_id, class_id, class_size, kept.

    Two texts are near copies if their bags of five-word shingles (words in lower case, signs left
    out) have a weighted Jaccard similarity of `similarity` or more; classes are what such
    links join. class_id is the least doc_id of the class, null only if all are. One row of a class is kept: the
    least by id, nulls last, then by text; of rows that repeat id and text any one. One row per row of `documents`.
    Texts without any word, null and empty ones too, are near copies of nothing and are kept; a text of
    fewer than five words is one shingle. Other columns are ignored; an empty table gives an
    empty table.

    Every reported class rests on links whose overlap was counted exactly. A link is missed with a
    probability of 3 in 100,000 at the threshold and less above it, in buckets of any size: a pair that
    shares a band is compared, or in one class by other links, or too far apart by the triangle inequality or by
    the shingles that it can share.
    """
    marked, classes = find_classes(documents, similarity)
    joined = marked.join(classes, "node", "left")
    alone = F.col("class_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        (alone | (F.col("row") == F.col("kept_row"))).alias("kept"),
    )


def drop_near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they were: the row that `near_copies` keeps.

    Only the keys of what goes are joined to the documents. Where the kept row's id and text are repeated, its repeats
    go in a second step, which is left out if there are none. Cases as in `near_copies`.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    marked, classes = find_classes(documents, similarity)
    verdicts = marked.join(classes, "node")
    told = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "text_key"]
    by_key = verdicts.groupBy(*told).agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("row") == F.col("kept_row")).alias("stays"))
    by_key = cut(by_key.where("NOT stays OR rows > 1"))
    keyed = plain.select(
        "*",
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_key"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("id"),
    )
    left = keyed.join(by_key.where("NOT stays").select("id", "text_key"), ["id", "text_key"], "left_anti")
    repeated = by_key.where("stays").select("id", "text_key")
    if not repeated.isEmpty():
        once = left.join(repeated, ["id", "text_key"]).dropDuplicates(["id", "text_key"])
        left = left.join(repeated, ["id", "text_key"], "left_anti").unionByName(once.select(left.columns))
    return left.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
