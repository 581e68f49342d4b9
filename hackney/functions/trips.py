"""Trip expressions: measures, keys and buckets."""

from __future__ import annotations

from hackney.functions.numbers import round_half_even, strict_int
from hackney.functions.text import strip
from hackney.functions.times import compact_time, minutes_between, to_time

# Upper bounds and names of the fare buckets.
FARE_BUCKETS = {5: "0_5", 10: "5_10", 25: "10_25", 50: "25_50", 100: "50_100"}
TOP_FARE_BUCKET = "100_PLUS"
FARE_BUCKET_ORDER = (*FARE_BUCKETS.values(), TOP_FARE_BUCKET)


def raw_duration(pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime") -> str:
    return minutes_between(to_time(pickup), to_time(dropoff))


def trip_duration() -> str:
    return round_half_even(raw_duration())


def trip_speed(distance: str, duration: str) -> str:
    """Miles per hour from an already rounded duration in minutes."""
    return round_half_even(f"try_divide({distance}, {duration} / 60D)")


def price_per_mile(total: str, distance: str) -> str:
    return round_half_even(f"try_divide({total}, {distance})")


def row_key(vendor: str, pickup: str, zone: str) -> str:
    return f"concat_ws('_', CAST({vendor} AS string), {compact_time(pickup)}, CAST({zone} AS string))"


def hour_key(text: str) -> str:
    """`00`..`23`; null for hours out of range and for anything but integers."""
    hour = strict_int(text)
    return f"CASE WHEN {hour} BETWEEN 0 AND 23 THEN lpad(CAST({hour} AS string), 2, '0') END"


def fare_bucket(fare: str) -> str:
    cases = " ".join(f"WHEN {fare} < {bound}D THEN '{name}'" for bound, name in FARE_BUCKETS.items())
    return f"CASE WHEN {fare} IS NULL THEN NULL {cases} ELSE '{TOP_FARE_BUCKET}' END"


def tip_key(payment: str, fare: str) -> str:
    return f"concat(CAST({payment} AS string), '_FARE_', {fare_bucket(fare)})"


def flag_letter(flag: str) -> str:
    return f"upper({strip(f'CAST({flag} AS string)')})"
