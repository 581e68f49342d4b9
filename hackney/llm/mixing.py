"""Mixing sources to target weights by hash thresholds.

A source's share of the words is met by taking all its documents a whole number
of times and some of them once more. Which ones is decided by a hash of the id:
sums per source and hash bucket show the bucket in which the rest of the budget
runs out, only that bucket is looked into more finely, and what lies below the
threshold is taken. Nothing is sorted, and a larger budget takes all that a
smaller one takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.frames import cut, pick

# Fixed value: a word is a run of anything but these blanks.
WORD = r"[^\x20\x09-\x0D]+"
# A hash has LEVELS * BITS bits; a histogram of a source has 2 ** BITS buckets at most.
BITS, LEVELS = 12, 5
# The table of sources is broadcast up to that many of them, at under 100 bytes each.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_place(doc_id: Column) -> Column:
    """60 bits of the id's digest; a null id has a place of its own."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def small(frame: DataFrame, counted: int) -> DataFrame:
    """Broadcast a table of sources if its number of rows is within the bound, else leave the join to the optimizer."""
    return F.broadcast(frame) if counted <= BROADCAST_SOURCES else frame


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Targets by source: (source, source_size, target).

    Sources in code point order, null last, weigh `weights` in turn. They share the total
    by weight; none gets more than `most` times its own size, and what that leaves over is
    shared by weight among the others. `sizes` has a row per source, so one task orders them.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "turn")
    below = filling.rowsBetween(Window.unboundedPreceding, -1)
    beyond = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = sizes.withColumn("turn", F.row_number().over(turn) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int")).cast("long")
    )
    whole = F.col("source_size").cast("decimal(38,0)")
    # In order of size to weight, the first source that is not cut off sets the level for all that follow.
    left = ranked.withColumn("total", F.sum(whole).over(everything)).select(
        "*",
        (F.col("total") - most * F.coalesce(F.sum(whole).over(below), F.lit(0))).cast("decimal(38,0)").alias("left"),
        F.sum("weight").over(beyond).alias("heavier"),
    )
    open_ = F.col("source_size").cast("double") * most * F.col("heavier") >= F.col("weight") * F.col("left").cast("double")
    first = F.min(F.when(open_, F.struct("turn_in_filling", "left", "heavier"))).over(everything)
    levelled = left.withColumn("turn_in_filling", F.row_number().over(filling)).withColumn("first", first)
    level = F.col("weight") * F.col("first.left").cast("double") / F.col("first.heavier")
    cap = (most * F.col("source_size")).cast("double")
    target = F.when(F.col("turn_in_filling") < F.col("first.turn_in_filling"), cap).otherwise(F.least(level, cap))
    return levelled.select("source", "source_size", target.alias("target"))


def source_limits(measured: DataFrame, weights: Sequence[int], most: int) -> tuple[DataFrame, int]:
    """What each source gives, and the number of sources.

    From rows (source, size, place): (source, source_size, target, copies, bound). Every document
    is taken `copies` times, and once more if its place is below `bound`.
    """
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, most))
    counted = targets.count()
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("copies", copies.cast("long")).withColumn(
        "rest", F.floor(F.col("target") - F.col("copies") * F.col("source_size")).cast("long")
    )
    state = plan.select("source", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("budget"), F.lit(0).cast("long").alias("edge"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        known = state.select(F.col("source").alias("of"), "prefix", "budget")
        inside = measured.join(small(known, counted), F.col("source").eqNullSafe(F.col("of"))).where(
            F.shiftright("place", shift + BITS) == F.col("prefix")
        )
        bucket = F.shiftright("place", shift).alias("bucket")
        histogram = inside.groupBy("source", "budget", bucket).agg(F.sum("size").alias("held"))
        running = F.sum("held").over(Window.partitionBy("source").orderBy("bucket"))
        over = histogram.withColumn("running", running).where(F.col("running") > F.col("budget"))
        state = (
            over.groupBy("source")
            .agg(F.min(F.struct("bucket", "running", "held", "budget")).alias("b"))
            .select(
                "source",
                F.col("b.bucket").alias("prefix"),
                (F.col("b.budget") - F.col("b.running") + F.col("b.held")).alias("budget"),
                F.col("b.held").alias("edge"),
            )
        )
    # The last bucket is a single place; it is taken if that comes nearer to the budget.
    bound = (F.col("prefix") + F.when(2 * F.col("budget") >= F.col("edge"), 1).otherwise(0)).cast("long")
    bounds = state.select(F.col("source").alias("of"), bound.alias("bound"))
    joined = plan.join(small(bounds, counted), F.col("source").eqNullSafe(F.col("of")), "left")
    # No place is beyond the budget: nothing is short, so the rest takes all.
    all_ = F.lit(1 << (BITS * LEVELS)).cast("long")
    limits = joined.select("source", "source_size", "target", "copies", F.coalesce("bound", F.when(F.col("rest") > 0, all_), F.lit(0)).alias("bound"))
    return cut(limits), counted


def taken_times() -> Column:
    return F.col("copies") + F.when(F.col("place") < F.col("bound"), 1).otherwise(0)


def mix_sizes(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken (words, repeats counted).

    One row per row of `documents`. A null or empty text has size 0 and gives nothing,
    null sources are one source, the last. Rows with the same doc_id share a fate, also
    those with a null one. Sources whose words are all used `most` times stay below their
    share. A source's taken words miss its target by half a document at most. An empty
    table gives an empty table; other columns are ignored. Reruns agree, as the choice
    depends on ids alone.
    """
    rows = pick(documents, "doc_id", "text", "source")
    measured = cut(rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash_place(F.col("doc_id")).alias("place")))
    limits, counted = source_limits(measured, weights, most)
    given = small(limits.withColumnRenamed("source", "of"), counted)
    return measured.join(given, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * taken_times()).alias("taken")
    )


def mix(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, all its columns as they were.

    Documents of no words are kept once, so that mixing never empties the corpus of them.
    Other cases as in `mix_sizes`.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text, source = (f"c{names.index(name)}" for name in ("doc_id", "text", "source"))
    measures = [word_count(F.col(text)).alias("size"), hash_place(F.col(doc_id)).alias("place")]
    measured = cut(plain.select(F.col(source).alias("source"), *measures))
    limits, counted = source_limits(measured, weights, most)
    given = small(limits.withColumnRenamed("source", "of"), counted)
    chosen = plain.select("*", *measures).join(given, F.col(source).eqNullSafe(F.col("of")))
    times = F.when(F.col("size") == 0, 1).otherwise(taken_times()).cast("int")
    repeated = chosen.withColumn("turn", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
