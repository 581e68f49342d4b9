"""Trip tables derived from the given Parquet tables.

The only module that knows the test tables. `trips` is a projection of
`lineitem`; the other frames put in what the cleaning rules and the text
parsers look for: copies, junk texts, short lines, older column layouts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hackney.functions import numbers, times
from hackney.operators import cleaning, keyed
from hackney.operators.features import with_features
from hackney.schema import CLEAN_COLUMNS
from hackney.sources import tables
from hackney.sources.scratch import scratch_path

# The cleaning rules' highest total that suits the value range of the test tables.
MAX_TOTAL = 100.0

# Lines of a text file at most.
FILE_LINES = 100_000

# Tables written for a session, by application, name and source folder.
_stored: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Write a derived table into the shared folder, once per session."""
    where = (spark.sparkContext.applicationId, name, sf_dir)
    if where not in _stored:
        path = scratch_path(spark, name)
        write(path)
        _stored[where] = path
    return _stored[where]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SECOND = "(l_orderkey * 7919) % 86400"
_RIDE = "(l_partkey % 200) * 60 + l_suppkey % 60"
_PRICE = "l_extendedprice / 1000D"
_FARE = f"CASE WHEN l_tax > 0.075D AND l_returnflag = 'R' THEN -1 ELSE 1 END * {_PRICE}"
_TRIP_COLUMNS = {
    "VendorID": "CASE WHEN l_quantity = 33 THEN 6 WHEN l_linestatus = 'O' THEN 1 ELSE 2 END",
    "tpep_pickup_datetime": f"timestampadd(SECOND, CAST({_SECOND} AS int), l_shipdate)",
    "tpep_dropoff_datetime": f"timestampadd(SECOND, CAST({_SECOND} + {_RIDE} AS int), l_shipdate)",
    "passenger_count": "CASE WHEN l_linenumber = 1 THEN nullif(l_quantity % 8, 7D) ELSE l_quantity % 8 END",
    "trip_distance": "l_quantity * l_quantity / 20D",
    "RatecodeID": "CAST(l_linenumber AS double)",
    "store_and_fwd_flag": "CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'X' "
    "WHEN l_returnflag = 'A' THEN ' y ' ELSE 'N' END",
    "PULocationID": "l_suppkey",
    "DOLocationID": "l_partkey",
    "payment_type": "l_linenumber",
    "fare_amount": _FARE,
    "extra": "1.0D",
    "mta_tax": "0.5D",
    "tip_amount": f"{_PRICE} * l_discount",
    "tolls_amount": f"{_PRICE} * l_tax",
    "improvement_surcharge": "0.3D",
    "total_amount": f"({_FARE}) + {_PRICE} * l_discount + {_PRICE} * l_tax + 1.8D",
    "congestion_surcharge": "CASE WHEN l_returnflag = 'R' THEN 2.5D ELSE 0D END",
    "Airport_fee": "CASE WHEN l_returnflag = 'A' THEN 1.75D ELSE 0D END",
    "cbd_congestion_fee": "CASE WHEN l_linestatus = 'F' THEN 0.75D ELSE 0D END",
}


def _as_trips(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*[f"{sql} AS {name}" for name, sql in _TRIP_COLUMNS.items()])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips, one per line item."""
    return _as_trips(table(spark, sf_dir, "lineitem"))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw trips, and every hundredth order's trips a second time.

    The copies come from an explode, so the table is read once.
    """
    copies = "explode(CASE WHEN l_orderkey % 100 = 0 THEN array(1, 2) ELSE array(1) END) AS copy"
    return _as_trips(table(spark, sf_dir, "lineitem").selectExpr("*", copies))


def featured_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips with the derived columns, in the clean layout."""
    return with_features(trips(spark, sf_dir))


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layout as a CSV holds it: time texts, cents, plain numbers."""
    forms = {"timestamp_ntz": times.time_text, "double": numbers.round_half_even}
    frame = featured_trips(spark, sf_dir)
    return frame.selectExpr(
        *[f"{forms[kind](name) if kind in forms else name} AS {name}" for name, kind in frame.dtypes]
    )


_JUNK_FIELDS = {
    "fare_amount": "CASE WHEN m > 120.5D THEN CASE p WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN 'NA' "
    "WHEN 4 THEN 'nan' ELSE 'abc' END ELSE fare_amount END",
    "pickup_hour": "CASE WHEN m BETWEEN 119D AND 120.5D THEN CASE p WHEN 1 THEN '' WHEN 2 THEN pickup_hour || '.0' "
    "WHEN 3 THEN '24' WHEN 4 THEN '-1' ELSE pickup_hour END ELSE pickup_hour END",
    "payment_type": "CASE WHEN m BETWEEN 115D AND 116D THEN CASE p WHEN 1 THEN '1.0' WHEN 2 THEN 'null' "
    "WHEN 3 THEN '' ELSE payment_type END ELSE payment_type END",
    "PULocationID": "CASE WHEN m BETWEEN 110D AND 111D THEN CASE p WHEN 1 THEN '' "
    "WHEN 2 THEN ' ' || PULocationID || ' ' ELSE PULocationID END ELSE PULocationID END",
}
_JUNK_LINE = f"""CASE WHEN m BETWEEN 105D AND 106D THEN CASE p
  WHEN 1 THEN regexp_replace(value, ',[^,]*$', '')
  WHEN 2 THEN value || ',x'
  WHEN 3 THEN '   '
  WHEN 4 THEN '{",".join(CLEAN_COLUMNS)}'
  ELSE '  ' || value || ' ' END ELSE value END AS value"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips as text lines, with junk in the longest trips.

    Distance (m) marks the kind of junk, payment type (p) its spelling.
    """
    cells = [f"CAST({name} AS string) AS {name}" for name in CLEAN_COLUMNS]
    joined = ", ".join(f"coalesce({_JUNK_FIELDS.get(name, name)}, '')" for name in CLEAN_COLUMNS)
    return (
        text_trips(spark, sf_dir)
        .selectExpr(*cells, "trip_distance AS m", "payment_type AS p")
        .selectExpr(f"concat_ws(',', {joined}) AS value", "m", "p")
        .selectExpr(_JUNK_LINE)
    )


def located_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the older layout, with coordinates in place of zones."""

    def degrees(start: str, zone: str) -> str:
        return f"CASE WHEN payment_type = 7 THEN 0D ELSE {start} + ({zone} % 10) * 0.1D END"

    return trips(spark, sf_dir).selectExpr(
        "* EXCEPT (PULocationID, DOLocationID)",
        f"{degrees('40.35D', 'PULocationID')} AS pickup_latitude",
        f"{degrees('-74.4D', 'DOLocationID')} AS pickup_longitude",
        f"{degrees('40.35D', 'DOLocationID')} AS dropoff_latitude",
        f"{degrees('-74.4D', 'PULocationID')} AS dropoff_longitude",
    )


def wide_path(spark: SparkSession, sf_dir: str) -> str:
    """The keyed wide table, stored sorted by key for the scans to prune."""

    def write(path: str) -> None:
        keyed.store_trips(trips(spark, sf_dir), path, derive=with_features)

    return _store(spark, sf_dir, "wide", write)


def stored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.read_wide(spark, wide_path(spark, sf_dir))


def changed_wide_path(spark: SparkSession, sf_dir: str, change: Callable[[DataFrame, str], None]) -> str:
    """The keyed wide table once more, in folders of a year each and changed in place."""

    def write(path: str) -> None:
        keyed.store_trips(trips(spark, sf_dir), path, derive=with_features, folder_characters=4)
        change(keyed.read_wide(spark, path), path)

    return _store(spark, sf_dir, "changed", write)


def stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips, stored and read back; the reports run over these."""

    def write(path: str) -> None:
        tables.write_orc(cleaning.clean_trips(raw_trips(spark, sf_dir), max_total=MAX_TOTAL), path)

    return tables.read_orc(spark, _store(spark, sf_dir, "clean", write))


def lines_path(spark: SparkSession, sf_dir: str) -> str:
    """Text files with the lines; the text jobs read these.

    They are packed. As a packed file is read by one task, none is long.
    """
    return _store(spark, sf_dir, "lines", lambda path: lines(spark, sf_dir).write.options(compression="gzip", maxRecordsPerFile=FILE_LINES).text(path))

