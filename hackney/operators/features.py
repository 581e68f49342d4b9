"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hackney.functions import times, trips


def with_columns(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add or replace columns by SQL text, keeping the place of replaced ones."""
    new = [f"{sql} AS `{name}`" for name, sql in columns.items() if name not in frame.columns]
    if len(new) == len(columns):
        return frame.selectExpr("*", *new)
    kept = [f"{columns[c]} AS `{c}`" if c in columns else f"`{c}`" for c in frame.columns]
    return frame.selectExpr(*kept, *new)


def time_features(pickup: str = "tpep_pickup_datetime") -> dict[str, str]:
    start = times.to_time(pickup)
    return {
        "pickup_date": times.day_text(start),
        "pickup_hour": f"hour({start})",
        "pickup_day": f"dayofmonth({start})",
        "pickup_month": f"month({start})",
        "pickup_year": f"year({start})",
        "pickup_dayofweek": f"weekday({start})",
        "pickup_day_name": times.day_name(start),
        "is_weekend": times.is_weekend(start),
    }


def with_time_features(frame: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    return with_columns(frame, time_features(pickup))


def with_features(frame: DataFrame) -> DataFrame:
    """All derived columns, in the order of the clean layout.

    Speed comes from the rounded duration; price per mile needs totals.
    """
    metrics = {"avg_speed_mph": trips.trip_speed("trip_distance", "trip_duration_min")}
    if "total_amount" in frame.columns:
        metrics["fare_per_mile"] = trips.price_per_mile("total_amount", "trip_distance")
    timed = with_columns(frame, {"trip_duration_min": trips.trip_duration(), **time_features()})
    return with_columns(timed, metrics)
