"""Zone, hour and tip reports over clean trip lines.

Each report has three steps: records (one typed row per usable line, with the
unreadable ones marked), an aggregate by a text key, and an order by that key.
Records can also come from typed trips, where missing measures count as zero.
The aggregates are partial before the shuffle, so one busy zone or hour moves
as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hackney.functions.numbers import (
    lenient_double,
    mean,
    percent_or_zero,
    strict_int,
    total,
    whole_sum,
    zero_filled,
)
from hackney.functions.rows import computed_once, inline_rows
from hackney.functions.text import strip
from hackney.functions.trips import hour_key, tip_key

SKIPPED = "skipped"

ZONE_MEASURES = (
    "fare_amount",
    "total_amount",
    "trip_distance",
    "trip_duration_min",
    "avg_speed_mph",
    "tip_amount",
)
HOUR_MEASURES = (
    "total_amount",
    "passenger_count",
    "trip_duration_min",
    "tip_amount",
    "fare_amount",
)
TIP_MEASURES = ("tip_amount", "fare_amount", "passenger_count")

# The payment codes of the tip report, card and cash.
TIP_PAYMENTS = (1, 2)

# Columns that job output marks with `%`.
HOUR_PERCENTS = ("tip_percentage",)
TIP_PERCENTS = ("avg_tip_pct", "zero_tip_rate")

_PAYMENT_FIELD = "coalesce(payment_type, '')"
_ZONE = strip("coalesce(PULocationID, '')")
_HOUR_TEXT = strip("coalesce(pickup_hour, '')")
_HOUR = strict_int("pickup_hour")
_PAYMENT_TEXT = f"lower({strip(_PAYMENT_FIELD)})"
_PAYMENT = strict_int("payment_type")

# Lines that belong to a report, readable or not.
_IN_ZONE_JOB = f"{_ZONE} <> ''"
_IN_HOUR_JOB = f"{_HOUR_TEXT} <> '' AND coalesce({_HOUR} BETWEEN 0 AND 23, true)"
_IN_TIP_JOB = f"{_PAYMENT_TEXT} NOT IN ('', 'null') AND coalesce({_PAYMENT} IN {TIP_PAYMENTS}, true)"


def _measures(names: Sequence[str], read: Callable[[str], str]) -> dict[str, str]:
    return {name: read(name) for name in names}


def _any_null(values: Sequence[str]) -> str:
    return " OR ".join(f"({value}) IS NULL" for value in values)


def zone_records(lines: DataFrame) -> DataFrame:
    return (
        lines.where(_IN_ZONE_JOB)
        .selectExpr(computed_once({"PULocationID": _ZONE, **_measures(ZONE_MEASURES, lenient_double)}))
        .selectExpr("*", f"{_any_null(ZONE_MEASURES)} AS {SKIPPED}")
    )


def hour_records(lines: DataFrame) -> DataFrame:
    return (
        lines.where(_IN_HOUR_JOB)
        .selectExpr(computed_once({"pickup_hour": hour_key("pickup_hour"), **_measures(HOUR_MEASURES, lenient_double)}))
        .selectExpr("*", f"{_any_null(['pickup_hour', *HOUR_MEASURES])} AS {SKIPPED}")
    )


def tip_records(lines: DataFrame) -> DataFrame:
    """Lines without a positive fare are no records, so they are not marked."""
    return (
        lines.where(_IN_TIP_JOB)
        .selectExpr(computed_once({"payment_type": _PAYMENT, **_measures(TIP_MEASURES, lenient_double)}))
        .selectExpr(
            f"{tip_key('payment_type', 'fare_amount')} AS payment_fare_bucket",
            *TIP_MEASURES,
            f"{_any_null(['payment_type', *TIP_MEASURES])} AS {SKIPPED}",
        )
    )


def zone_records_of(frame: DataFrame) -> DataFrame:
    """Zone records of typed trips; nothing in them is unreadable."""
    return frame.where("PULocationID IS NOT NULL").selectExpr(
        "CAST(PULocationID AS string) AS PULocationID",
        *[f"{sql} AS {name}" for name, sql in _measures(ZONE_MEASURES, zero_filled).items()],
        f"false AS {SKIPPED}",
    )


def _usable(records: DataFrame, quality: Observation | None) -> DataFrame:
    """Drop marked records, counting them on the way if a counter is given."""
    if quality is not None:
        records = records.observe(quality, F.count_if(SKIPPED).alias("skipped_records"))
    return records.where(f"NOT {SKIPPED}")


def _by_key(records: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
    columns = [F.expr(sql).alias(name) for name, sql in measures.items()]
    return records.groupBy(key).agg(*columns).orderBy(key)


_TIP_PERCENT = f"round({percent_or_zero(whole_sum('tip_amount'), whole_sum('fare_amount'))}, 2)"


def zone_performance(records: DataFrame, quality: Observation | None = None) -> DataFrame:
    measures = {
        "total_trips": "count(*)",
        "total_revenue": total("total_amount"),
        "avg_fare": mean("fare_amount"),
        "avg_distance": mean("trip_distance"),
        "avg_duration_min": mean("trip_duration_min"),
        "avg_speed_mph": mean("avg_speed_mph"),
        "avg_tip": mean("tip_amount"),
    }
    return _by_key(_usable(records, quality), "PULocationID", measures)


def hourly_performance(records: DataFrame, quality: Observation | None = None) -> DataFrame:
    measures = {
        "total_trips": "count(*)",
        "total_revenue": total("total_amount"),
        "avg_revenue_per_trip": mean("total_amount"),
        "avg_passengers": mean("passenger_count"),
        "avg_duration_min": mean("trip_duration_min"),
        "avg_tip": mean("tip_amount"),
        "tip_percentage": _TIP_PERCENT,
    }
    return _by_key(_usable(records, quality), "pickup_hour", measures)


def tip_behavior(records: DataFrame, quality: Observation | None = None) -> DataFrame:
    measures = {
        "total_trips": "count(*)",
        "avg_tip_amount": mean("tip_amount"),
        "avg_tip_pct": _TIP_PERCENT,
        "zero_tip_rate": "round(count_if(tip_amount = 0) / count(*) * 100, 2)",
        "avg_passengers": mean("passenger_count"),
    }
    paid = _usable(records, quality).where("fare_amount > 0")
    return _by_key(paid, "payment_fare_bucket", measures)


def quality_counts(lines: DataFrame) -> DataFrame:
    """Skipped records per report, one row each, from one pass over the lines."""
    every = dict.fromkeys((*ZONE_MEASURES, *HOUR_MEASURES, *TIP_MEASURES))
    asked = {"in_zone": _IN_ZONE_JOB, "in_hour": _IN_HOUR_JOB, "in_tip": _IN_TIP_JOB, "hour": _HOUR, "payment": _PAYMENT}
    measures = _measures(list(every), lenient_double)
    parsed = lines.selectExpr(*[f"{sql} AS {name}" for name, sql in {**asked, **measures}.items()])
    skipped = {
        "zone_performance": f"in_zone AND ({_any_null(ZONE_MEASURES)})",
        "hourly_performance": f"in_hour AND ({_any_null(['hour', *HOUR_MEASURES])})",
        "tip_behavior": f"in_tip AND ({_any_null(['payment', *TIP_MEASURES])})",
    }
    counts = parsed.selectExpr(*[f"count_if({bad}) AS {job}" for job, bad in skipped.items()])
    rows = [{"job": f"'{job}'", "skipped_records": job} for job in skipped]
    return counts.selectExpr(inline_rows(rows))
