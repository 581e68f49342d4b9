"""Cleaning rules, the cleaning chain and its removal report.

A rule is a predicate over the raw columns, so the whole chain is one filter.
Row predicates commute with the removal of exact copies: all copies of a row
pass or fail together. The chain therefore filters before the shuffle that
`dropDuplicates` needs, and copies collapse map-side before they move.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions import times, trips
from hackney.functions.numbers import number, truncated_int
from hackney.functions.rows import inline_rows
from hackney.functions.text import literal
from hackney.operators.features import with_columns, with_features
from hackney.schema import GEO_COLUMNS, MONEY_COLUMNS, TIME_COLUMNS

# Limits of the cleaning rules.
MIN_MINUTES, MAX_MINUTES = "1D", "180D"
MIN_PASSENGERS, MAX_PASSENGERS = 1, 6
MAX_MILES = "100D"
VENDORS = (1, 2)
RATE_CODES = (1, 6)
FLAGS = ("Y", "N")
LATITUDES = (40.40, 41.10)
LONGITUDES = (-74.35, -73.60)
MAX_TOTAL = 500.0
MAX_SPEED = "80D"

# Step names of the removal report.
DUPLICATES_STEP = "Drop duplicate rows"
TIMES_STEP = "Drop rows with invalid pickup/dropoff datetime"
DURATION_STEP = "Keep trip_duration_min in [1, 180] minutes"
PASSENGERS_STEP = "Keep passenger_count in [1, 6]"
DISTANCE_STEP = "Keep 0 < trip_distance <= 100 miles"
VENDOR_STEP = "Keep VendorID in {1, 2}"
RATE_CODE_STEP = "Keep RateCodeID in {1..6}"
FLAG_STEP = "Keep store_and_fwd_flag in {Y, N}"
GEO_STEP = "Keep pickup/dropoff coordinates inside NYC bounding box"
ZONES_STEP = "Drop rows with missing PULocationID/DOLocationID"
MONEY_STEP = "Keep non-negative fare/money fields (total_amount <= {max_total:g})"
SPEED_STEP = "Keep 0 < avg_speed_mph <= 80"

INFINITY = "double('infinity')"

# The documented spelling; data files spell it `RatecodeID`.
RATE_CODE_COLUMN = "RateCodeID"


class Rule(NamedTuple):
    step: str
    keep: str


def valid_times() -> str:
    return " AND ".join(f"{times.to_time(name)} IS NOT NULL" for name in TIME_COLUMNS)


def valid_duration() -> str:
    return f"{trips.raw_duration()} BETWEEN {MIN_MINUTES} AND {MAX_MINUTES}"


def valid_passengers() -> str:
    # Counts are cut to whole numbers, so 6.9 still reads as 6.
    count = number("passenger_count")
    return f"{count} >= {MIN_PASSENGERS}D AND {count} < {MAX_PASSENGERS + 1}D"


def valid_distance() -> str:
    miles = number("trip_distance")
    return f"{miles} > 0D AND {miles} <= {MAX_MILES}"


def valid_vendor() -> str:
    return f"VendorID IN {VENDORS}"


def valid_rate_code(column: str = RATE_CODE_COLUMN) -> str:
    low, high = RATE_CODES
    code = number(column)
    return f"{code} >= {low}D AND {code} < {high + 1}D"


def valid_flag() -> str:
    return f"{trips.flag_letter('store_and_fwd_flag')} IN {FLAGS}"


def valid_coordinates() -> str:
    # The box leaves out (0, 0), the mark of a missing satellite fix.
    return " AND ".join(
        f"{number(f'{end}_{axis}')} BETWEEN {low}D AND {high}D"
        for end in ("pickup", "dropoff")
        for axis, (low, high) in {"latitude": LATITUDES, "longitude": LONGITUDES}.items()
    )


def valid_zones() -> str:
    return "PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"


def valid_money(columns: Sequence[str] = MONEY_COLUMNS, max_total: float = MAX_TOTAL) -> str:
    # NaN sorts above infinity, so the upper bound turns it away.
    bounds = {"total_amount": f"{float(max_total)}D"}
    return " AND ".join(
        f"{number(name)} BETWEEN 0D AND {bounds.get(name, INFINITY)}" for name in columns
    )


def valid_speed() -> str:
    speed = trips.trip_speed(number("trip_distance"), trips.trip_duration())
    return f"{speed} > 0D AND {speed} <= {MAX_SPEED}"


def row_rules(
    columns: Sequence[str], *, apply_ratecode_rule: bool = False, max_total: float = MAX_TOTAL
) -> list[Rule]:
    """The row rules in order, for the columns at hand.

    Column names are matched by exact case here: the rate-code rule is on only
    for the documented spelling, or when asked for.
    """
    present = set(columns)
    everything = "true"
    folded = {name.lower(): name for name in columns}
    rate_column = folded.get(RATE_CODE_COLUMN.lower())
    rate_on = RATE_CODE_COLUMN in present or (apply_ratecode_rule and rate_column is not None)
    rules = [
        Rule(TIMES_STEP, valid_times()),
        Rule(DURATION_STEP, valid_duration()),
        Rule(PASSENGERS_STEP, valid_passengers() if "passenger_count" in present else everything),
        Rule(DISTANCE_STEP, valid_distance()),
        Rule(VENDOR_STEP, valid_vendor() if "VendorID" in present else everything),
        Rule(RATE_CODE_STEP, valid_rate_code(rate_column) if rate_on else everything),
        Rule(FLAG_STEP, valid_flag() if "store_and_fwd_flag" in present else everything),
    ]
    if present.issuperset(GEO_COLUMNS):
        rules.append(Rule(GEO_STEP, valid_coordinates()))
    elif present.issuperset(("PULocationID", "DOLocationID")):
        rules.append(Rule(ZONES_STEP, valid_zones()))
    money = [name for name in MONEY_COLUMNS if name in present]
    if money:
        rules.append(Rule(MONEY_STEP.format(max_total=max_total), valid_money(money, max_total)))
    rules.append(Rule(SPEED_STEP, valid_speed()))
    return rules


def normalized(frame: DataFrame) -> DataFrame:
    """Column rewrites of the rules: parsed times, whole counts, upper-case flags."""
    rewrites = {name: times.to_time(name) for name in TIME_COLUMNS}
    rewrites |= {
        name: number(name) for name in ("trip_distance", *GEO_COLUMNS, *MONEY_COLUMNS)
    }
    rewrites |= {
        "passenger_count": truncated_int("passenger_count"),
        "store_and_fwd_flag": trips.flag_letter("store_and_fwd_flag"),
        RATE_CODE_COLUMN: truncated_int(RATE_CODE_COLUMN),
    }
    return with_columns(frame, {c: rewrites[c] for c in frame.columns if c in rewrites})


def drop_copies(frame: DataFrame) -> DataFrame:
    return frame.dropDuplicates()


def clean_trips(
    raw: DataFrame, *, apply_ratecode_rule: bool = False, max_total: float = MAX_TOTAL
) -> DataFrame:
    """Rows that pass every rule, without copies, with the derived columns."""
    rules = row_rules(raw.columns, apply_ratecode_rule=apply_ratecode_rule, max_total=max_total)
    keep = " AND ".join(f"({rule.keep})" for rule in rules)
    return with_features(normalized(drop_copies(raw.where(keep))))


def removal_report(
    raw: DataFrame, *, apply_ratecode_rule: bool = False, max_total: float = MAX_TOTAL
) -> DataFrame:
    """Rows removed by and remaining after each step, from a single pass.

    Distinct rows carry their number of copies, so the row count before the
    removal of copies needs no second scan. Each distinct row is charged to the
    first rule it fails, and all counts come out of one global aggregate.
    """
    rules = row_rules(raw.columns, apply_ratecode_rule=apply_ratecode_rule, max_total=max_total)
    # A rule that gives null fails too.
    cases = " ".join(f"WHEN ({r.keep}) IS NOT TRUE THEN {i}" for i, r in enumerate(rules))
    columns = [f"`{c}`" for c in raw.columns]
    distinct = raw.groupBy(*columns).agg(F.count("*").alias("copies"))
    charged = distinct.selectExpr("copies", f"CASE {cases} ELSE {len(rules)} END AS first_failed")
    lefts = [f"count_if(first_failed > {i}) AS left_{i + 1}" for i in range(len(rules))]
    totals = charged.selectExpr("coalesce(sum(copies), 0) AS raw", "count(*) AS left_0", *lefts)
    names = [DUPLICATES_STEP, *(r.step for r in rules)]
    counts = ["raw", *(f"left_{i}" for i in range(len(names)))]
    steps = [
        (name, f"{before} - {after}", after) for name, before, after in zip(names, counts, counts[1:])
    ]
    steps.append(("TOTAL", f"raw - {counts[-1]}", counts[-1]))
    rows = [
        {"step": str(step), "cleaning_step": literal(name), "rows_removed": gone, "rows_remaining": left}
        for step, (name, gone, left) in enumerate(steps, start=1)
    ]
    return totals.selectExpr(inline_rows(rows))
