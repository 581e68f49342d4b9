"""Column profile, data dictionary and exact summary statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hackney.functions import times

# What the documented attributes mean, by exact column name.
ATTRIBUTES = {
    "VendorID": "Code indicating the TPEP provider that supplied the record (1 = Creative Mobile Technologies, 2 = VeriFone Inc.)",
    "tpep_pickup_datetime": "Date and time when the meter was engaged (trip start)",
    "tpep_dropoff_datetime": "Date and time when the meter was disengaged (trip end)",
    "passenger_count": "Number of passengers in the vehicle (driver-entered value)",
    "trip_distance": "Elapsed trip distance in miles reported by the taximeter",
    "pickup_longitude": "Longitude where the meter was engaged",
    "pickup_latitude": "Latitude where the meter was engaged",
    "dropoff_longitude": "Longitude where the meter was disengaged",
    "dropoff_latitude": "Latitude where the meter was disengaged",
    "PULocationID": "TLC Taxi Zone in which the taximeter was engaged (newer schema)",
    "DOLocationID": "TLC Taxi Zone in which the taximeter was disengaged (newer schema)",
    "RateCodeID": "Final rate code in effect at trip end (1=Standard,2=JFK,3=Newark,4=Nassau/Westchester,5=Negotiated,6=Group ride)",
    "store_and_fwd_flag": "Y if trip record was held in vehicle memory before sending to vendor (no connection), else N",
    "payment_type": "Numeric code for how the passenger paid (1=Credit card,2=Cash,3=No charge,4=Dispute,5=Unknown,6=Voided trip)",
    "fare_amount": "Time-and-distance fare calculated by the meter (USD)",
    "extra": "Miscellaneous extras/surcharges (rush hour, overnight, etc., USD)",
    "mta_tax": "$0.50 MTA tax automatically triggered by the metered rate in use",
    "tip_amount": "Tip amount (auto-populated for credit-card payments)",
    "tolls_amount": "Total amount of tolls paid on the trip",
    "improvement_surcharge": "$0.30 improvement surcharge assessed on hailed trips",
    "total_amount": "Total amount charged to passengers (does not include cash tips)",
}

# The quartiles of a summary.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

# Rows of the sample that proposes cuts, the share of rows by which cuts stand off a rank, and rows that are few.
SAMPLED, MARGIN, FEW = 50_000, 0.01, 20_000

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
TIMES = ("timestamp", "timestamp_ntz", "date")
TEXTS = ("string", "boolean")


def _is(kind: str, family: Sequence[str]) -> bool:
    return kind.split("(")[0] in family


def null_profile(frame: DataFrame) -> DataFrame:
    """One row per column: position, type, rows and nulls, from one pass."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(frame.columns)]
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("total").alias("total_rows"),
            F.col(f"n{i}").alias("null_rows"),
        )
        for i, (name, kind) in enumerate(frame.dtypes)
    ]
    return frame.agg(F.count("*").alias("total"), *nulls).select(F.inline(F.array(*rows)))


def data_dictionary(frame: DataFrame, attributes: Mapping[str, str] = ATTRIBUTES) -> DataFrame:
    """Meaning and filled rows of the documented columns the frame really has."""
    items = [F.lit(x) for pair in attributes.items() for x in pair]
    return (
        null_profile(frame.select(*[c for c in frame.columns if c in attributes]))
        .select(
            F.col("column_name").alias("attribute"),
            F.try_element_at(F.create_map(*items), F.col("column_name")).alias("description"),
            (F.col("total_rows") - F.col("null_rows")).alias("filled_rows"),
        )
    )


def _as_double(name: str, kind: str) -> Column:
    if _is(kind, TIMES):
        return F.expr(times.seconds_between("timestamp_ntz'1970-01-01'", f"CAST(`{name}` AS timestamp_ntz)"))
    return F.col(f"`{name}`").cast("double")


def _melted(frame: DataFrame, columns: Mapping[str, Column], value_type: str) -> DataFrame:
    """One (column_id, value) row per filled cell; small numbers group faster than names."""
    cells = [
        F.struct(F.lit(number).alias("column_id"), value.cast(value_type).alias("value"))
        for number, value in enumerate(columns.values(), start=1)
    ]
    return frame.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def _named(summary: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("column_id"))
    return summary.withColumn("column_name", name).drop("column_id")


class _Range(NamedTuple):
    """Values of a column between two bounds, of which `open_` are outside; rows below and inside."""

    column: int
    low: float
    high: float
    open_: tuple[bool, bool]
    below: int
    inside: int

    def holds(self) -> Column:
        value = F.col(f"c{self.column}")
        return (value > self.low if self.open_[0] else value >= self.low) & (value < self.high if self.open_[1] else value <= self.high)


def _cuts(cells: DataFrame, asked: Mapping[_Range, Sequence[int]], turn: int) -> dict[tuple[_Range, int], tuple[float, float]]:
    """Two values of a range that are likely on either side of a rank, for each rank, from a sample of rows, larger each turn."""
    part = min(1.0, 2**turn * SAMPLED / min(r.inside for r in asked))
    share = {(r, k): round((k - r.below) / max(r.inside - 1, 1), 5) for r, ks in asked.items() for k in ks}
    sides = {key: [min(1.0, max(0.0, at + e)) for e in (-MARGIN, MARGIN)] for key, at in share.items()}
    wanted = {r: sorted({x for k in ks for x in sides[r, k]}) for r, ks in asked.items()}
    values = [F.percentile_approx(F.when(r.holds(), F.col(f"c{r.column}")), shares).alias(f"s{i}") for i, (r, shares) in enumerate(wanted.items())]
    told = dict(zip(asked, cells.sample(part, seed=turn).agg(*values).first(), strict=True))
    found = {}
    for (r, k), pair in sides.items():
        # A sample may have nothing of a range; a cut at a bound that is known then parts its values one by one.
        low, high = [told[r][wanted[r].index(x)] for x in pair] if told[r] else (r.low, r.high)
        found[r, k] = (low, low) if (low, high) == (r.low, r.high) and not r.open_[0] else (high, high) if (low, high) == (r.low, r.high) else (low, high)
    return found


def _narrowed(cells: DataFrame, cuts: Mapping[tuple[_Range, int], tuple[float, float]]) -> dict[tuple[_Range, int], _Range | float]:
    """The part of its range that holds each rank, or the value itself where the cuts are one value that holds it. One pass of counts."""
    under = sorted({(r.column, a) for (r, _), (a, _) in cuts.items()})
    upto = sorted({(r.column, b) for (r, _), (_, b) in cuts.items()})
    tests = [F.col(f"c{c}") < a for c, a in under] + [F.col(f"c{c}") <= b for c, b in upto]
    counts = cells.agg(*[F.count_if(test).alias(f"n{i}") for i, test in enumerate(tests)]).first()
    below, within = dict(zip(under, counts)), dict(zip(upto, counts[len(under) :]))
    found: dict[tuple[_Range, int], _Range | float] = {}
    for (r, k), (a, b) in cuts.items():
        before, after = below[r.column, a], within[r.column, b]
        if k < before:
            found[r, k] = _Range(r.column, r.low, a, (r.open_[0], True), r.below, before - r.below)
        elif k >= after:
            found[r, k] = _Range(r.column, b, r.high, (True, r.open_[1]), after, r.below + r.inside - after)
        else:
            found[r, k] = a if a == b else _Range(r.column, a, b, (False, False), before, after - before)
    return found


def quantiles(frame: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Exact quartiles with linear interpolation, one row per column that has a value.

    The range of values that holds a wanted rank is narrowed until few rows are inside: a sample proposes two values on either side
    of the rank, and a pass of counts tells exactly where it lies. If the two are the ends of the range already, one of them leaves
    it, so it shrinks each time, whatever values repeat. In the end the values of the ranges, FEW rows at most each, are
    counted one by one. No cell is moved but those; every pass is one aggregate over all columns.
    """
    cells = frame.select(*[value.cast("double").alias(f"c{i}") for i, value in enumerate(columns.values())])
    ends = cells.agg(*[f(c) for c in cells.columns for f in (F.count, F.min, F.max)]).first() if cells.columns else []
    totals = ends[0::3]
    ranks = {(i, k) for i, n in enumerate(totals) if n for q in QUARTILES.values() for k in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))}
    values: dict[tuple[int, int], float] = {}
    held = {(i, k): _Range(i, ends[3 * i + 1], ends[3 * i + 2], (False, False), 0, totals[i]) for i, k in ranks}
    turn = 0
    while wide := {key: r for key, r in held.items() if r.inside > FEW}:
        asked: dict[_Range, list[int]] = {}
        for (_, k), r in wide.items():
            asked.setdefault(r, []).append(k)
        for (r, k), found in _narrowed(cells, _cuts(cells, asked, turn)).items():
            if isinstance(found, _Range):
                held[r.column, k] = found
            else:
                del held[r.column, k]
                values[r.column, k] = found
        turn += 1
    few = list(dict.fromkeys(held.values()))
    if few:
        told = [F.when(r.holds(), F.struct(F.lit(i).alias("range"), F.col(f"c{r.column}").alias("value"))) for i, r in enumerate(few)]
        ranks_of = {r: [k for (i, k), other in held.items() if other == r] for r in few}
        inside = cells.select(F.inline(F.array_compact(F.array(*told)))).groupBy("range", "value").agg(F.count("*").alias("rows"))
        below = F.element_at(F.array(*[F.lit(r.below) for r in few]), F.col("range") + 1)
        last = below + F.sum("rows").over(W.partitionBy("range").orderBy("value"))
        wanted = F.element_at(F.array(*[F.array(*map(F.lit, sorted(ranks_of[r]))) for r in few]), F.col("range") + 1)
        hit = F.filter(wanted, lambda k: (k < F.col("last")) & (k >= F.col("last") - F.col("rows")))
        for row in inside.withColumn("last", last).select("range", "value", F.explode(hit).alias("rank")).collect():
            values[few[row["range"]].column, row["rank"]] = row["value"]
    rows = []
    for i, (name, n) in enumerate(zip(columns, totals)):
        if n:
            places = [q * (n - 1) for q in QUARTILES.values()]
            sides = [(values[i, math.floor(p)], values[i, math.ceil(p)], p - math.floor(p)) for p in places]
            rows.append((name, *[low + (high - low) * part if high != low else low for low, high, part in sides]))
    schema = ", ".join(["column_name string", *(f"{name} double" for name in QUARTILES)])
    return frame.sparkSession.createDataFrame(rows, schema)


def describe_numbers(frame: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of number and time columns.

    Times are given as seconds since 1970. Columns without a value are left out
    of the quartiles, so those stay null.
    """
    columns = {
        name: _as_double(name, kind) for name, kind in frame.dtypes if _is(kind, NUMERIC + TIMES)
    }
    values = {name: F.when(~F.isnan(value), value) for name, value in columns.items()}
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    measured = frame.agg(
        *[
            fn(value).alias(f"{stat}_{i}")
            for i, value in enumerate(values.values())
            for stat, fn in stats.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"), *[F.col(f"{stat}_{i}").alias(stat) for stat in stats]
        )
        for i, name in enumerate(values)
    ]
    # Both sides hold one row per column of the frame.
    return measured.select(F.inline(F.array(*rows))).join(
        quantiles(frame, values), "column_name", "left"
    )


def describe_texts(frame: DataFrame) -> DataFrame:
    """Count, distinct values and the most frequent value of text columns.

    Values are counted before they are compared, so a value that fills most
    rows moves as one row per task. Ties go to the smallest value.
    """
    columns = {name: F.col(f"`{name}`") for name, kind in frame.dtypes if _is(kind, TEXTS)}
    counted = (
        _melted(frame, columns, "string").groupBy("column_id", "value").agg(F.count("*").alias("rows"))
    )
    most = F.max("rows")
    summary = counted.groupBy("column_id").agg(
        F.sum("rows").alias("count"), F.count("*").alias("unique"), most.alias("freq")
    )
    top = (
        counted.join(F.broadcast(summary.select("column_id", "freq")), "column_id")
        .where(F.col("rows") == F.col("freq"))
        .groupBy("column_id")
        .agg(F.min("value").alias("top"))
    )
    return _named(summary.join(top, "column_id"), columns)


def describe(frame: DataFrame) -> DataFrame:
    """Both summaries in one table, one row per column of the frame."""
    parts = {NUMERIC + TIMES: describe_numbers, TEXTS: describe_texts}
    told = [
        summary(frame)
        for family, summary in parts.items()
        if any(_is(kind, family) for _, kind in frame.dtypes)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), told)
