"""Chart-ready series derived from the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hackney.functions import labels
from hackney.functions.trips import FARE_BUCKET_ORDER

# Series sizes, months and bucket captions.
BUSIEST_ZONES = 10
SERIES_YEAR, SERIES_MONTHS = 2026, (1, 2, 3)
BUCKET_CAPTIONS = ("$0-$5", "$5-$10", "$10-$25", "$25-$50", "$50-$100", "$100+")
CARD_PREFIX = "1_FARE_"


def hourly_series(hourly_job: DataFrame) -> DataFrame:
    return hourly_job.select(
        F.col("pickup_hour").cast("int").alias("hour"), "total_trips", "total_revenue"
    ).orderBy("hour")


def busiest_zones(zone_job: DataFrame, k: int = BUSIEST_ZONES) -> DataFrame:
    return (
        zone_job.orderBy(F.desc("total_trips"), "PULocationID")
        .limit(k)
        .select(
            F.concat(F.lit("Zone "), "PULocationID").alias("zone_label"),
            "PULocationID",
            "total_trips",
        )
    )


def payment_share(payment_report: DataFrame) -> DataFrame:
    """Percent of all trips per payment row; the total is that of the report's few rows."""
    total = F.sum("trip_count").over(W.partitionBy())
    return payment_report.select(
        "payment_method",
        "trip_count",
        F.round(F.try_divide(F.col("trip_count") * 100.0, total), 1).alias("share_pct"),
    )


def weekend_series(weekend_report: DataFrame) -> DataFrame:
    return weekend_report.select("day_type", "trip_count", "avg_total_amount")


def month_series(
    monthly_report: DataFrame, year: int = SERIES_YEAR, months: Sequence[int] = SERIES_MONTHS
) -> DataFrame:
    return (
        monthly_report.where((F.col("pickup_year") == year) & F.col("pickup_month").isin(*months))
        .selectExpr(
            "pickup_month",
            f"{labels.month_label('pickup_year', 'pickup_month')} AS month_name",
            "total_revenue",
        )
        .orderBy("pickup_month")
    )


def speed_and_fare(zone_job: DataFrame) -> DataFrame:
    return zone_job.dropna().select("PULocationID", "avg_speed_mph", "avg_fare", "total_trips")


def tip_by_bucket(tip_job: DataFrame) -> DataFrame:
    """Card tip percent in fare order rather than in text order."""
    code = F.regexp_replace("payment_fare_bucket", f"^{CARD_PREFIX}", "")
    position = F.array_position(F.array(*map(F.lit, FARE_BUCKET_ORDER)), F.col("bucket_code"))
    caption = F.try_element_at(
        F.array(*map(F.lit, BUCKET_CAPTIONS)), F.col("bucket_order").cast("int")
    )
    return (
        tip_job.where(F.col("payment_fare_bucket").startswith(CARD_PREFIX))
        .select(code.alias("bucket_code"), F.col("avg_tip_pct").alias("tip_pct"))
        .withColumn("bucket_order", position)
        .withColumn("bucket_label", caption)
        .orderBy("bucket_order")
    )


def rate_code_yield(rate_code_report: DataFrame) -> DataFrame:
    return rate_code_report.select("rate_code_description", "trip_count", "avg_fare_per_mile")
