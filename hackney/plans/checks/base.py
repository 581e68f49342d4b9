"""Shared table expressions of the SQL checks."""

from __future__ import annotations

import re

from hackney.schema import CLEAN_COLUMNS, RAW_COLUMNS

RAW = list(RAW_COLUMNS)
CLEAN = list(CLEAN_COLUMNS)
TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")


def half(value: str) -> str:
    """Two decimals, halves to even."""
    return f"(round_even(({value}) * 100::DOUBLE, 0) / 100::DOUBLE)"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def stamped(columns: list[str], prefix: str = "") -> str:
    return ", ".join(
        f"{stamp(prefix + c)} AS {c}" if c in TIMES else f"{prefix}{c} AS {c}" for c in columns
    )


def trips_of(source: str) -> str:
    return f"""
SELECT *, fare_amount + tip_amount + tolls_amount + 1.8::DOUBLE AS total_amount FROM (
  SELECT
    CASE WHEN l_quantity = 33 THEN 6 WHEN l_linestatus = 'O' THEN 1 ELSE 2 END::INTEGER AS VendorID,
    l_shipdate + to_seconds((l_orderkey * 7919) % 86400) AS tpep_pickup_datetime,
    l_shipdate + to_seconds((l_orderkey * 7919) % 86400 + (l_partkey % 200) * 60 + l_suppkey % 60)
      AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 1 THEN nullif(l_quantity % 8, 7) ELSE l_quantity % 8 END AS passenger_count,
    l_quantity * l_quantity / 20::DOUBLE AS trip_distance,
    l_linenumber::DOUBLE AS RatecodeID,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'X' WHEN l_returnflag = 'A' THEN ' y ' ELSE 'N' END
      AS store_and_fwd_flag,
    l_suppkey AS PULocationID,
    l_partkey AS DOLocationID,
    l_linenumber AS payment_type,
    CASE WHEN l_tax > 0.075::DOUBLE AND l_returnflag = 'R' THEN -1 ELSE 1 END * l_extendedprice / 1000::DOUBLE
      AS fare_amount,
    1::DOUBLE AS extra,
    0.5::DOUBLE AS mta_tax,
    l_extendedprice / 1000::DOUBLE * l_discount AS tip_amount,
    l_extendedprice / 1000::DOUBLE * l_tax AS tolls_amount,
    0.3::DOUBLE AS improvement_surcharge,
    CASE WHEN l_returnflag = 'R' THEN 2.5 ELSE 0 END::DOUBLE AS congestion_surcharge,
    CASE WHEN l_returnflag = 'A' THEN 1.75 ELSE 0 END::DOUBLE AS Airport_fee,
    CASE WHEN l_linestatus = 'F' THEN 0.75 ELSE 0 END::DOUBLE AS cbd_congestion_fee
  FROM {source}
)"""


TRIPS = f"trips AS ({trips_of('lineitem')})"
COPIED = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 100 = 0)"
RAW_TRIPS = f"raw_trips AS ({trips_of(COPIED)})"

MINUTES = "(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1e6::DOUBLE / 60::DOUBLE)"
SPEED = half("trip_distance / nullif(trip_duration_min / 60::DOUBLE, 0)")

TIME_FEATURES = """
  strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date,
  hour(tpep_pickup_datetime)::INTEGER AS pickup_hour,
  day(tpep_pickup_datetime)::INTEGER AS pickup_day,
  month(tpep_pickup_datetime)::INTEGER AS pickup_month,
  year(tpep_pickup_datetime)::INTEGER AS pickup_year,
  (isodow(tpep_pickup_datetime) - 1)::INTEGER AS pickup_dayofweek,
  dayname(tpep_pickup_datetime) AS pickup_day_name,
  CASE WHEN isodow(tpep_pickup_datetime) >= 6 THEN 1 ELSE 0 END::INTEGER AS is_weekend"""


def featured_of(source: str) -> str:
    return f"""
SELECT *, {SPEED} AS avg_speed_mph, {half("total_amount / nullif(trip_distance, 0)")} AS fare_per_mile FROM (
  SELECT *, {half(MINUTES)} AS trip_duration_min, {TIME_FEATURES} FROM {source}
)"""


FEATURED = f"{TRIPS}, featured AS ({featured_of('trips')})"

_DOUBLES = [c for c in CLEAN if CLEAN_COLUMNS[c] == "double"]
_TEXT = ", ".join(
    f"{stamp(c)} AS {c}" if c in TIMES else f"{half(c)} AS {c}" if c in _DOUBLES else c for c in CLEAN
)
TEXT = f"{FEATURED}, text_trips AS (SELECT {_TEXT} FROM featured)"

_JUNK = {
    "fare_amount": "CASE WHEN m > 120.5 THEN CASE p WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'NA' "
    "WHEN 4 THEN 'nan' ELSE 'abc' END ELSE fare_amount END",
    "pickup_hour": "CASE WHEN m BETWEEN 119 AND 120.5 THEN CASE p WHEN 1 THEN '' WHEN 2 THEN pickup_hour || '.0' "
    "WHEN 3 THEN '24' WHEN 4 THEN '-1' ELSE pickup_hour END ELSE pickup_hour END",
    "payment_type": "CASE WHEN m BETWEEN 115 AND 116 THEN CASE p WHEN 1 THEN '1.0' WHEN 2 THEN 'null' "
    "WHEN 3 THEN '' ELSE payment_type END ELSE payment_type END",
    "PULocationID": "CASE WHEN m BETWEEN 110 AND 111 THEN CASE p WHEN 1 THEN '' "
    "WHEN 2 THEN ' ' || PULocationID || ' ' ELSE PULocationID END ELSE PULocationID END",
}
_CELLS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CLEAN)
_JOINED = ", ".join(f"coalesce({_JUNK.get(c, c)}, '')" for c in CLEAN)
LINES = f"""{TEXT},
cells AS (SELECT {_CELLS}, trip_distance AS m, payment_type AS p FROM text_trips),
joined AS (SELECT concat_ws(',', {_JOINED}) AS value, m, p FROM cells),
lines AS (
  SELECT CASE WHEN m BETWEEN 105 AND 106 THEN CASE p
    WHEN 1 THEN regexp_replace(value, ',[^,]*$', '')
    WHEN 2 THEN value || ',x'
    WHEN 3 THEN '   '
    WHEN 4 THEN '{",".join(CLEAN)}'
    ELSE '  ' || value || ' ' END ELSE value END AS value
  FROM joined
)"""
FIELDS = f"""{LINES},
split AS (SELECT string_split(trim(value), ',') AS f FROM lines),
fields AS (SELECT f FROM split WHERE len(f) >= {len(CLEAN)} AND trim(f[1]) <> '{CLEAN[0]}')"""


def field(name: str) -> str:
    return f"f[{CLEAN.index(name) + 1}]"


def whole(text: str) -> str:
    """Text to integer, null unless it is a plain whole number."""
    return f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+') THEN TRY_CAST({text} AS INTEGER) END"


def lenient(text: str) -> str:
    """Missing markers, NaN and infinities are zero; junk is null."""
    word = f"trim({text})"
    return f"""CASE
      WHEN lower({word}) IN ('', 'null', 'na', 'nan') THEN 0::DOUBLE
      WHEN regexp_full_match({word}, '[+-]?Infinity') THEN 0::DOUBLE
      WHEN lower({word}) LIKE '%inf%' THEN NULL
      ELSE TRY_CAST({word} AS DOUBLE) END"""


def amount(value: str) -> str:
    """Through the text, so that the decimal is the shortest one of the double."""
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(28, 12))"


def sum2(value: str) -> str:
    """An exact sum, rounded half up to two decimals once."""
    return f"CAST(round(sum({amount(value)}), 2) AS DOUBLE)"


def avg2(value: str, parts: int = 1, digits: int = 2) -> str:
    """An exact mean (or a part of it), rounded half up to two decimals once.

    The sum's digits and the result are whole numbers, so the quotient is never rounded before.
    """
    total = f"CAST(replace(CAST(sum({amount(value)}) AS VARCHAR), '.', '') AS HUGEINT)"
    unit = f"(count({value})::HUGEINT * {10 ** (12 - digits) * parts})"
    return f"(sign({total}) * ((2 * abs({total}) + {unit}) // (2 * {unit})) / {10**digits}::DOUBLE)"


def once2(value: str) -> str:
    """A stored value rounded half up to two decimals."""
    return f"CAST(round({amount(value)}, 2) AS DOUBLE)"


def sql(tables: str, body: str) -> str:
    """A query text; `sum2(x)`, `avg2(x)` and `once2(x)` in it stand for the expressions above."""
    text = f"WITH {tables.strip()}\n{body.strip()}"
    for name, form in (("sum2", sum2), ("avg2", avg2), ("once2", once2)):
        text = re.sub(rf"\b{name}\(([^()]*)\)", lambda m, form=form: form(m[1]), text)
    return text
