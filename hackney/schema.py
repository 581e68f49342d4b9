"""Column layouts: raw trips, clean trips and the keyed wide rows."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the trip layouts.
RAW_COLUMNS: dict[str, str] = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "cbd_congestion_fee": "double",
}
DERIVED_COLUMNS: dict[str, str] = {
    "trip_duration_min": "double",
    "pickup_date": "string",
    "pickup_hour": "int",
    "pickup_day": "int",
    "pickup_month": "int",
    "pickup_year": "int",
    "pickup_dayofweek": "int",
    "pickup_day_name": "string",
    "is_weekend": "int",
    "avg_speed_mph": "double",
    "fare_per_mile": "double",
}
TIME_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
MONEY_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
)
GEO_COLUMNS = (
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
)

# Column groups of a keyed row. Each entry maps a cell to the
# trip column it is filled from and to its stored type.
FAMILIES: dict[str, dict[str, tuple[str, str]]] = {
    "trip_info": {
        "passenger_count": ("passenger_count", "int"),
        "trip_distance": ("trip_distance", "double"),
        "PULocationID": ("PULocationID", "bigint"),
        "DOLocationID": ("DOLocationID", "bigint"),
        "payment_type": ("payment_type", "int"),
    },
    "financials": {
        "fare_amount": ("fare_amount", "double"),
        "tip_amount": ("tip_amount", "double"),
        "total_amount": ("total_amount", "double"),
        "congestion_surcharge": ("congestion_surcharge", "double"),
    },
    "timing": {
        "pickup_datetime": ("tpep_pickup_datetime", "string"),
        "dropoff_datetime": ("tpep_dropoff_datetime", "string"),
        "trip_duration_min": ("trip_duration_min", "double"),
        "pickup_hour": ("pickup_hour", "int"),
        "pickup_day_name": ("pickup_day_name", "string"),
    },
    "metrics": {
        "avg_speed_mph": ("avg_speed_mph", "double"),
        "fare_per_mile": ("fare_per_mile", "double"),
        "is_weekend": ("is_weekend", "int"),
    },
}

CLEAN_COLUMNS: dict[str, str] = {**RAW_COLUMNS, **DERIVED_COLUMNS}


def struct_of(columns: dict[str, str]) -> T.StructType:
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    return T.StructType.fromDDL(ddl)


def staging_schema() -> T.StructType:
    """The clean layout with every column read as text."""
    return struct_of(dict.fromkeys(CLEAN_COLUMNS, "string"))


def stored_types() -> dict[str, str]:
    """The clean layout as a typed table keeps it: timestamps stay text."""
    return {
        name: "string" if kind == "timestamp_ntz" else kind
        for name, kind in CLEAN_COLUMNS.items()
    }
