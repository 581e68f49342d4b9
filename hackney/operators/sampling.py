"""A repeatable sample of exactly n rows, cut by the rank of a hash and not by a sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sample size and seed.
SAMPLE_SIZE, SAMPLE_SEED = 50_000, 42

# Hex digits of the hash that name a slice, 16**4 slices at most, and how often the slice of the cut is sliced again.
SLICE_DIGITS, LEVELS = 4, 3


def sample_rank(key: Sequence[str], seed: int = SAMPLE_SEED) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def sample_rows(
    frame: DataFrame,
    key: Sequence[str],
    n: int = SAMPLE_SIZE,
    seed: int = SAMPLE_SEED,
    order_by: str = "tpep_pickup_datetime",
) -> DataFrame:
    """The n rows with the smallest seeded hash of their key, in time order.

    Rows are counted by the first digits of the hash (a fixed number of slices, counted before they move), which tells the slice that
    holds the n-th row; that slice alone is sliced again by the next digits, until its digits tell millions of millions of
    rows apart. All rows below the last slice are taken by a filter, and only rows of that one slice are ordered and
    cut: one or two, if the key tells rows apart. Of rows with one hash some are taken at random; null keys are keys like others.
    """
    ranked = frame.withColumn("_rank", sample_rank(key, seed))
    # Digits of the slice that holds the cut, and rows that lie below it; nothing is below the first.
    digits, below = "", 0
    for level in range(LEVELS):
        held = ranked.where(F.col("_rank").startswith(digits)) if digits else ranked
        slices = held.groupBy(F.substring("_rank", 1, SLICE_DIGITS * (level + 1)).alias("slice")).agg(F.count("*").alias("rows"))
        # One task orders the slice counts: 65,536 rows at most, whatever the data.
        running = F.sum("rows").over(W.orderBy("slice"))
        place = slices.withColumn("upto", running).where(F.col("upto") >= n - below).orderBy("slice").first()
        if place is None:
            return frame.orderBy(order_by, *key)
        digits, below = place["slice"], below + place["upto"] - place["rows"]
    taken = ranked.where(F.col("_rank") < digits)
    cut = ranked.where(F.col("_rank").startswith(digits)).orderBy("_rank").limit(n - below)
    return taken.unionByName(cut).drop("_rank").orderBy(order_by, *key)
