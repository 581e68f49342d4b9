"""SQL checks of the cleaning rules."""

from __future__ import annotations

from hackney.plans.checks.base import (
    CLEAN,
    MINUTES,
    RAW,
    RAW_TRIPS,
    SPEED,
    TRIPS,
    featured_of,
    half,
    sql,
    stamped,
)
from hackney.schema import MONEY_COLUMNS

DURATION = f"{MINUTES} BETWEEN 1 AND 180"
PASSENGERS = "trunc(passenger_count) BETWEEN 1 AND 6"
DISTANCE = "trip_distance > 0 AND trip_distance <= 100"
VENDOR = "VendorID IN (1, 2)"
RATE_CODE = "RatecodeID IN (1, 2, 3, 4, 5, 6)"
FLAG = "upper(trim(store_and_fwd_flag)) IN ('Y', 'N')"
MONEY = " AND ".join(f"{c} >= 0" for c in MONEY_COLUMNS) + " AND total_amount <= 100"
ROW_SPEED = SPEED.replace("trip_duration_min", half(MINUTES))
FAST = f"{ROW_SPEED} > 0 AND {ROW_SPEED} <= 80"

_NORMAL = """* REPLACE (trunc(passenger_count)::INTEGER AS passenger_count,
  upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag)"""
_KEEP = " AND ".join(f"({r})" for r in (DURATION, PASSENGERS, DISTANCE, VENDOR, FLAG, MONEY))
CLEANED = f"""{RAW_TRIPS},
kept AS (SELECT {_NORMAL} FROM (SELECT DISTINCT * FROM raw_trips) WHERE {_KEEP}),
cleaned AS (SELECT * FROM ({featured_of("kept")}) WHERE avg_speed_mph > 0 AND avg_speed_mph <= 80)"""

_STEPS = [
    ("Drop rows with invalid pickup/dropoff datetime", "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"),
    ("Keep trip_duration_min in [1, 180] minutes", DURATION),
    ("Keep passenger_count in [1, 6]", PASSENGERS),
    ("Keep 0 < trip_distance <= 100 miles", DISTANCE),
    ("Keep VendorID in {1, 2}", VENDOR),
    ("Keep RateCodeID in {1..6}", RATE_CODE),
    ("Keep store_and_fwd_flag in {Y, N}", FLAG),
    ("Drop rows with missing PULocationID/DOLocationID", "PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"),
    ("Keep non-negative fare/money fields (total_amount <= 100)", MONEY),
    ("Keep 0 < avg_speed_mph <= 80", FAST),
]


def _report() -> str:
    """The funnel step by step, each step filtering what the last one left."""
    tables = [RAW_TRIPS, "s1 AS (SELECT DISTINCT * FROM raw_trips)"]
    rows = ["SELECT 1::INTEGER AS step, 'Drop duplicate rows' AS cleaning_step, (SELECT count(*) FROM raw_trips) AS b, (SELECT count(*) FROM s1) AS a"]
    for i, (name, keep) in enumerate(_STEPS, start=2):
        tables.append(f"s{i} AS (SELECT * FROM s{i - 1} WHERE {keep})")
        rows.append(f"SELECT {i}, '{name}', (SELECT count(*) FROM s{i - 1}), (SELECT count(*) FROM s{i})")
    last = len(_STEPS) + 1
    rows.append(f"SELECT {last + 1}, 'TOTAL', (SELECT count(*) FROM raw_trips), (SELECT count(*) FROM s{last})")
    body = f"""SELECT step, cleaning_step, b - a AS rows_removed, a AS rows_remaining
    FROM ({" UNION ALL ".join(rows)})"""
    return sql(", ".join(tables), body)


def _rule(keep: str, replace: str = "", extra: str = "") -> str:
    picked = f"(SELECT * {replace} FROM raw_trips WHERE {keep})"
    return sql(RAW_TRIPS, f"SELECT {stamped(RAW)}{extra} FROM {picked}")


_OLD = [c for c in RAW if c not in ("PULocationID", "DOLocationID")]


def _degrees(start: str, zone: str) -> str:
    return f"CASE WHEN payment_type = 7 THEN 0 ELSE {start}::DOUBLE + ({zone} % 10) * 0.1::DOUBLE END"


_LOCATED = f"""{TRIPS}, located AS (SELECT *,
  {_degrees("40.35", "PULocationID")} AS pickup_latitude,
  {_degrees("-74.4", "DOLocationID")} AS pickup_longitude,
  {_degrees("40.35", "DOLocationID")} AS dropoff_latitude,
  {_degrees("-74.4", "PULocationID")} AS dropoff_longitude FROM trips)"""

SQL = {
    "c01_dedupe": sql(RAW_TRIPS, f"SELECT {stamped(RAW)} FROM (SELECT DISTINCT * FROM raw_trips)"),
    # Month 13 cannot be read, so those rows go.
    "c02_timestamps": _rule("trip_distance <= 115"),
    "c03_duration": _rule(DURATION, replace=f", {MINUTES} AS trip_duration_min", extra=", trip_duration_min"),
    "c04_passengers": _rule(PASSENGERS, replace="REPLACE (trunc(passenger_count)::INTEGER AS passenger_count)"),
    "c05_distance": _rule(DISTANCE),
    "c06_vendor": _rule(VENDOR),
    "c07_ratecode": _rule(RATE_CODE),
    "c08_flag": _rule(FLAG, replace="REPLACE (upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag)"),
    "c09a_bbox": sql(
        _LOCATED,
        f"""SELECT {stamped(_OLD)}, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude
        FROM located WHERE pickup_latitude BETWEEN 40.40::DOUBLE AND 41.10::DOUBLE
          AND dropoff_latitude BETWEEN 40.40::DOUBLE AND 41.10::DOUBLE
          AND pickup_longitude BETWEEN -74.35::DOUBLE AND -73.60::DOUBLE
          AND dropoff_longitude BETWEEN -74.35::DOUBLE AND -73.60::DOUBLE
          AND NOT (pickup_latitude = 0 AND pickup_longitude = 0)
          AND NOT (dropoff_latitude = 0 AND dropoff_longitude = 0)""",
    ),
    "c09b_zones": _rule("payment_type <> 7"),
    "c10_money": _rule(MONEY),
    "c11_speed": _rule(FAST),
    "c12_report": _report(),
    "c13_clean_trips": sql(CLEANED, f"SELECT {stamped(CLEAN)} FROM cleaned"),
}

__all__ = ["CLEANED", "SQL"]
