"""Twelve trips of one night, with hand-derived answers in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Vendor, pickup, dropoff, passengers, miles, from, to, payment,
# fare, tip, total, minutes, mph, per mile, congestion.
TRIPS = [
    (1, "00:40:35", "00:45:12", 1, 0.5, 161, 229, 4, 0.0, 0.0, 0.0, 4.62, 6.49, 0.0, 0.0),
    (1, "00:23:16", "00:37:18", 2, 2.6, 48, 151, 1, 14.9, 0.0, 20.65, 14.03, 11.12, 7.94, 2.5),
    (1, "00:41:53", "01:23:56", 1, 10.8, 142, 189, 1, 47.8, 13.4, 66.95, 42.05, 15.41, 6.2, 2.5),
    (1, "00:38:54", "01:28:40", 1, 9.4, 170, 64, 1, 43.5, 0.0, 44.0, 49.77, 11.33, 4.68, 0.0),
    (2, "00:23:38", "00:29:35", 1, 1.56, 239, 151, 1, 9.3, 4.29, 18.59, 5.95, 15.73, 11.92, 2.5),
    (2, "00:07:08", "00:18:18", 3, 1.73, 239, 236, 1, 12.1, 1.71, 18.81, 11.17, 9.29, 10.87, 2.5),
    (2, "00:10:16", "00:14:26", 1, 0.84, 249, 68, 2, 6.5, 0.0, 12.25, 4.17, 12.09, 14.58, 2.5),
    (2, "00:10:55", "00:19:41", 1, 1.94, 239, 236, 1, 12.1, 3.42, 20.52, 8.77, 13.27, 10.58, 2.5),
    (2, "00:58:17", "01:09:57", 2, 1.94, 79, 233, 1, 12.8, 3.71, 22.26, 11.67, 9.97, 11.47, 2.5),
    (2, "00:19:31", "00:46:09", 3, 7.01, 137, 225, 1, 32.4, 9.02, 54.11, 26.63, 15.79, 7.72, 2.5),
    (2, "00:36:29", "00:41:04", 1, 0.6, 143, 239, 1, 6.5, 2.0, 13.5, 4.58, 7.86, 22.5, 2.5),
    (2, "00:30:46", "00:36:58", 1, 0.64, 161, 237, 1, 7.9, 2.73, 16.38, 6.2, 6.19, 25.59, 2.5),
]
SCHEMA = (
    "VendorID int, pickup string, dropoff string, passenger_count int, trip_distance double, PULocationID int, "
    "DOLocationID int, payment_type int, fare_amount double, tip_amount double, total_amount double, "
    "trip_duration_min double, avg_speed_mph double, fare_per_mile double, congestion_surcharge double"
)


def trips12(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRIPS, SCHEMA).selectExpr(
        "* EXCEPT (pickup, dropoff)",
        "CAST('2026-01-01 ' || pickup AS timestamp_ntz) AS tpep_pickup_datetime",
        "CAST('2026-01-01 ' || dropoff AS timestamp_ntz) AS tpep_dropoff_datetime",
        "0 AS pickup_hour",
        "'Thursday' AS pickup_day_name",
        "0 AS is_weekend",
    )
