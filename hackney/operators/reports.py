"""The fixed business questions over a typed trip table.

Every report is a filter, an aggregate with a map-side part, and a sort of the
few rows that come out; top-k reports keep k rows per task. Ties are broken by
the key columns, so results do not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions import labels, numbers

# Report sizes and thresholds.
TOP_ZONES = 20
TOP_TRIPS = 10
HIGH_VOLUME_TRIPS = 10_000
ADAPTIVE_FLOOR, ADAPTIVE_SHARE = 10, 500
OCCUPANCY = (1, 6)

# Titles printed in front of the reports.
TITLES = {
    "q01_total_trips": "Q1: Total Taxi Trips",
    "q02_total_revenue": "Q2: Total Revenue Generated",
    "q03_averages": "Q3: Platform-wide Averages",
    "q04_top_zones_volume": "Q4: Trip Volume by Pickup Zone (Top 20)",
    "q05_top_zones_revenue": "Q5: Revenue by Pickup Zone (Top 20)",
    "q06_top_trips": "Q6: Top 10 Highest-Value Trips",
    "q07_distance_stats": "Q7: Trip Distance Statistics",
    "q08_hourly": "Q8: Trip Demand by Pickup Hour",
    "q09_weekend": "Q9: Weekday vs Weekend Analysis",
    "q10_payment": "Q10: Payment Type Analysis",
    "q11_high_volume": "Q11: High-Volume Pickup Zones (>10000 trips)",
    "q12_monthly": "Q12: Monthly Performance Breakdown",
    "q13_ratecode": "Q13: Ratecode Economic Yield",
    "q14_peak": "Q14: Surcharge & Toll Breakdown (Peak vs Off-Peak)",
    "q15_occupancy": "Q15: Passenger Count Occupancy Analysis",
}


def guarded(trips: DataFrame) -> DataFrame:
    """Leave out rows without a vendor, as left by header lines in text tables."""
    return trips.where(F.col("VendorID").isNotNull())


def _sum(name: str) -> str:
    return numbers.total(name)


def _avg(name: str) -> str:
    return numbers.mean(name)


def _grouped(trips: DataFrame, *keys: str | Column, **measures: str) -> DataFrame:
    columns = [F.expr(sql).alias(name) for name, sql in measures.items()]
    return trips.groupBy(*keys).agg(*columns)


def _labelled(report: DataFrame, key: str, name: str, label: str) -> DataFrame:
    """Put the label in place of the code the rows were grouped by."""
    return report.selectExpr(f"{label} AS {name}", f"* EXCEPT ({key})")


def total_trips(trips: DataFrame) -> DataFrame:
    return _grouped(trips, total_trips="count(*)")


def total_revenue(trips: DataFrame) -> DataFrame:
    return _grouped(trips, total_revenue=_sum("total_amount"))


def averages(trips: DataFrame) -> DataFrame:
    return _grouped(
        trips,
        avg_fare=_avg("fare_amount"),
        avg_distance_miles=_avg("trip_distance"),
        avg_duration_min=_avg("trip_duration_min"),
        avg_speed_mph=_avg("avg_speed_mph"),
    )


def top_zones_by_volume(trips: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    zones = _grouped(trips, "PULocationID", trip_count="count(*)")
    return zones.orderBy(F.desc("trip_count"), "PULocationID").limit(k)


def top_zones_by_revenue(trips: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    zones = _grouped(
        trips,
        "PULocationID",
        trip_count="count(*)",
        total_revenue=_sum("total_amount"),
        avg_revenue_per_trip=_avg("total_amount"),
    )
    return zones.orderBy(F.desc("total_revenue"), "PULocationID").limit(k)


def top_trips(trips: DataFrame, k: int = TOP_TRIPS) -> DataFrame:
    rounded = {
        "trip_distance_miles": "trip_distance",
        "trip_duration_min": "trip_duration_min",
        "fare_amount": "fare_amount",
        "tip_amount": "tip_amount",
        "total_amount": "total_amount",
    }
    pickup, zones = "tpep_pickup_datetime", ("PULocationID", "DOLocationID")
    return (
        trips.orderBy(F.desc("total_amount"), pickup, *zones)
        .limit(k)
        .selectExpr(*zones, pickup, *[f"round({column}, 2) AS {name}" for name, column in rounded.items()])
    )


def distance_stats(trips: DataFrame) -> DataFrame:
    return _grouped(
        trips.where("trip_distance > 0"),
        max_distance_miles="max(trip_distance)",
        min_distance_miles="min(trip_distance)",
        avg_distance_miles=_avg("trip_distance"),
        total_trips="count(*)",
    )


def hourly(trips: DataFrame) -> DataFrame:
    return _grouped(
        trips,
        "pickup_hour",
        trip_count="count(*)",
        avg_duration_min=_avg("trip_duration_min"),
        avg_total_amount=_avg("total_amount"),
    ).orderBy("pickup_hour")


def weekend(trips: DataFrame) -> DataFrame:
    """Groups by the flag itself; the label comes after."""
    report = _grouped(
        trips,
        "is_weekend",
        trip_count="count(*)",
        avg_total_amount=_avg("total_amount"),
        avg_distance_miles=_avg("trip_distance"),
        avg_tip=_avg("tip_amount"),
    ).orderBy("is_weekend")
    return _labelled(report, "is_weekend", "day_type", labels.day_type("is_weekend"))


def payment(trips: DataFrame) -> DataFrame:
    """Groups by the payment code, so several rows can share a label."""
    report = _grouped(
        trips,
        "payment_type",
        trip_count="count(*)",
        total_revenue=_sum("total_amount"),
        avg_tip=_avg("tip_amount"),
        avg_fare=_avg("total_amount"),
    ).orderBy(F.desc("trip_count"), "payment_type")
    return _labelled(report, "payment_type", "payment_method", labels.payment_label("payment_type"))


def _zone_volumes(trips: DataFrame) -> DataFrame:
    return _grouped(
        trips,
        "PULocationID",
        trip_count="count(*)",
        avg_total_amount=_avg("total_amount"),
        avg_tip=_avg("tip_amount"),
        total_revenue=_sum("total_amount"),
    )


def high_volume_zones(
    trips: DataFrame, min_trips: int = HIGH_VOLUME_TRIPS, strict: bool = True
) -> DataFrame:
    """Zones above the threshold; with `strict=False` the threshold counts too."""
    keep = f"trip_count {'>' if strict else '>='} {int(min_trips)}"
    return _zone_volumes(trips).where(keep).orderBy(F.desc("trip_count"), "PULocationID")


def adaptive_high_volume_zones(
    trips: DataFrame, floor: int = ADAPTIVE_FLOOR, share: int = ADAPTIVE_SHARE
) -> DataFrame:
    """Zones with at least 1/`share` of all trips, and never fewer than `floor`.

    The total is a scalar subquery that reads no columns.
    """
    total = trips.agg(F.count("*")).scalar()
    threshold = F.greatest(F.lit(floor), F.floor(total / F.lit(share)))
    return (
        _zone_volumes(trips)
        .where(F.col("trip_count") >= threshold)
        .orderBy(F.desc("trip_count"), "PULocationID")
    )


def monthly(trips: DataFrame) -> DataFrame:
    month = ("pickup_year", "pickup_month")
    return _grouped(
        trips,
        *month,
        trip_count="count(*)",
        total_revenue=_sum("total_amount"),
        avg_distance_miles=_avg("trip_distance"),
        avg_duration_min=_avg("trip_duration_min"),
        avg_fare=_avg("fare_amount"),
    ).orderBy(*month)


def rate_code(trips: DataFrame) -> DataFrame:
    """Groups by the rate code, so several rows can share a label."""
    report = _grouped(
        trips,
        "RatecodeID",
        trip_count="count(*)",
        total_revenue=_sum("total_amount"),
        avg_fare=_avg("fare_amount"),
        avg_distance_miles=_avg("trip_distance"),
        avg_speed_mph=_avg("avg_speed_mph"),
        avg_fare_per_mile=_avg("fare_per_mile"),
    ).orderBy(F.desc("trip_count"), "RatecodeID")
    label = labels.rate_code_label("RatecodeID")
    return _labelled(report, "RatecodeID", "rate_code_description", label)


def peak(trips: DataFrame) -> DataFrame:
    """Groups by the period label."""
    period = F.expr(labels.time_period("pickup_hour")).alias("time_period")
    return _grouped(
        trips,
        period,
        trip_count="count(*)",
        total_revenue=_sum("total_amount"),
        total_congestion_surcharge=_sum("congestion_surcharge"),
        total_cbd_fee=_sum("cbd_congestion_fee"),
        total_airport_fee=_sum("Airport_fee"),
        total_tolls=_sum("tolls_amount"),
    ).orderBy(F.desc("trip_count"), "time_period")


def occupancy(trips: DataFrame) -> DataFrame:
    low, high = OCCUPANCY
    seats = F.expr(numbers.truncated_int("passenger_count")).alias("passenger_count")
    return _grouped(
        trips.where(f"passenger_count BETWEEN {low} AND {high}"),
        seats,
        trip_count="count(*)",
        avg_distance_miles=_avg("trip_distance"),
        avg_total_amount=_avg("total_amount"),
        avg_tip_amount=_avg("tip_amount"),
        tip_percentage=f"round({numbers.percent(numbers.whole_sum('tip_amount'), numbers.whole_sum('fare_amount'))}, 2)",
    ).orderBy("passenger_count")


REPORTS = {
    "q01_total_trips": total_trips,
    "q02_total_revenue": total_revenue,
    "q03_averages": averages,
    "q04_top_zones_volume": top_zones_by_volume,
    "q05_top_zones_revenue": top_zones_by_revenue,
    "q06_top_trips": top_trips,
    "q07_distance_stats": distance_stats,
    "q08_hourly": hourly,
    "q09_weekend": weekend,
    "q10_payment": payment,
    "q11_high_volume": high_volume_zones,
    "q11b_adaptive": adaptive_high_volume_zones,
    "q12_monthly": monthly,
    "q13_ratecode": rate_code,
    "q14_peak": peak,
    "q15_occupancy": occupancy,
}
