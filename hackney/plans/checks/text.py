"""SQL checks of the sources, sinks, features and text jobs."""

from __future__ import annotations

from hackney.operators.profiling import ATTRIBUTES
from hackney.plans.checks.base import (
    CLEAN,
    FEATURED,
    FIELDS,
    LINES,
    RAW,
    TEXT,
    TIME_FEATURES,
    TIMES,
    TRIPS,
    avg2,
    field,
    lenient,
    sql,
    stamp,
    stamped,
    whole,
)
from hackney.plans.checks.cleaning import CLEANED
from hackney.schema import CLEAN_COLUMNS, RAW_COLUMNS

ZONE = ("fare_amount", "total_amount", "trip_distance", "trip_duration_min", "avg_speed_mph", "tip_amount")
HOUR = ("total_amount", "passenger_count", "trip_duration_min", "tip_amount", "fare_amount")
TIP = ("tip_amount", "fare_amount", "passenger_count")


def measures(names: tuple[str, ...]) -> str:
    return ", ".join(f"{lenient(field(n))} AS {n}" for n in names)


def readable(names: tuple[str, ...]) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


def unreadable(names: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"({lenient(field(n))}) IS NULL" for n in names) + ")"


ZONE_RECORDS = f"""{FIELDS},
zone_records AS (
  SELECT * FROM (SELECT trim({field("PULocationID")}) AS PULocationID, {measures(ZONE)} FROM fields)
  WHERE PULocationID <> '' AND {readable(ZONE)}
)"""
HOUR_RECORDS = f"""{FIELDS},
hour_records AS (
  SELECT *, lpad(CAST(h AS VARCHAR), 2, '0') AS pickup_hour FROM (
    SELECT {whole(f"trim({field('pickup_hour')})")} AS h, {measures(HOUR)} FROM fields
  ) WHERE h BETWEEN 0 AND 23 AND {readable(HOUR)}
)"""
BUCKET = """CASE WHEN fare_amount < 5 THEN '0_5' WHEN fare_amount < 10 THEN '5_10' WHEN fare_amount < 25 THEN '10_25'
  WHEN fare_amount < 50 THEN '25_50' WHEN fare_amount < 100 THEN '50_100' ELSE '100_PLUS' END"""
TIP_RECORDS = f"""{FIELDS},
tip_records AS (
  SELECT *, CAST(p AS VARCHAR) || '_FARE_' || {BUCKET} AS payment_fare_bucket FROM (
    SELECT {whole(f"trim({field('payment_type')})")} AS p, {measures(TIP)} FROM fields
  ) WHERE p IN (1, 2) AND {readable(TIP)} AND fare_amount > 0
)"""


def zone_job(source: str) -> str:
    return f"""
SELECT PULocationID, count(*) AS total_trips, sum2(total_amount) AS total_revenue,
  avg2(fare_amount) AS avg_fare, avg2(trip_distance) AS avg_distance,
  avg2(trip_duration_min) AS avg_duration_min, avg2(avg_speed_mph) AS avg_speed_mph,
  avg2(tip_amount) AS avg_tip
FROM {source} GROUP BY PULocationID"""


_TIPS, _FARES = (f"sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(28, 12)))::DOUBLE" for c in ("tip_amount", "fare_amount"))
TIP_PCT = f"round(CASE WHEN {_FARES} > 0 THEN {_TIPS} / {_FARES} * 100 ELSE 0 END, 2)"
HOUR_JOB = f"""
SELECT pickup_hour, count(*) AS total_trips, sum2(total_amount) AS total_revenue,
  avg2(total_amount) AS avg_revenue_per_trip, avg2(passenger_count) AS avg_passengers,
  avg2(trip_duration_min) AS avg_duration_min, avg2(tip_amount) AS avg_tip,
  {TIP_PCT} AS tip_percentage
FROM hour_records GROUP BY pickup_hour"""
TIP_JOB = f"""
SELECT payment_fare_bucket, count(*) AS total_trips, avg2(tip_amount) AS avg_tip_amount,
  {TIP_PCT} AS avg_tip_pct,
  round(count(*) FILTER (WHERE tip_amount = 0) / count(*) * 100, 2) AS zero_tip_rate,
  avg2(passenger_count) AS avg_passengers
FROM tip_records GROUP BY payment_fare_bucket"""

_CLEAN_TEXT = ", ".join(f"{stamp(c)} AS {c}" if c in TIMES else f"CAST({c} AS VARCHAR) AS {c}" for c in CLEAN)
_ALL_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CLEAN)

_TYPED = []
for _name, _kind in CLEAN_COLUMNS.items():
    _f = field(_name)
    if _kind == "int":
        _TYPED.append(f"TRY_CAST(trunc(TRY_CAST({_f} AS DOUBLE)) AS INTEGER) AS {_name}")
    elif _kind == "double":
        _TYPED.append(f"TRY_CAST({_f} AS DOUBLE) AS {_name}")
    else:
        _TYPED.append(f"nullif({_f}, '') AS {_name}")

_ORC = [
    f"{c}::{'INTEGER' if k == 'int' else 'DOUBLE' if k == 'double' else 'VARCHAR'} AS {c}"
    for c, k in CLEAN_COLUMNS.items()
]

_NUMBERS = [c for c, k in RAW_COLUMNS.items() if k != "string"]
_SPARK_TYPES = {**RAW_COLUMNS, "PULocationID": "bigint", "DOLocationID": "bigint"}


def _described(name: str) -> str:
    value = f"epoch_us({name}) / 1e6::DOUBLE" if name in TIMES else f"{name}::DOUBLE"
    return f"""
SELECT '{name}' AS column_name, count({name}) AS count, {avg2(value, digits=4)} AS mean,
  round(stddev_samp({value}), 4) AS std, min({value}) AS min, max({value}) AS max,
  round(quantile_cont({value}, 0.25), 4) AS p25, round(quantile_cont({value}, 0.5), 4) AS p50,
  round(quantile_cont({value}, 0.75), 4) AS p75,
  NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq
FROM trips"""


_FLAG = """
SELECT 'store_and_fwd_flag', sum(n)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  count(*), arg_max(flag, n), max(n)
FROM (SELECT store_and_fwd_flag AS flag, count(*) AS n FROM trips WHERE store_and_fwd_flag IS NOT NULL GROUP BY 1)"""

_PLAIN_FIELDS = ["VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID", "payment_type", "fare_amount", "pickup_hour", "is_weekend"]

_SAMPLE_KEY = (
    f"concat_ws('|', {stamp('tpep_pickup_datetime')}, CAST(PULocationID AS VARCHAR), "
    "CAST(DOLocationID AS VARCHAR), CAST(payment_type AS VARCHAR), '42')"
)


_EMPTY = "''"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL = {
    "s_parquet_concat": sql(
        TRIPS,
        f"""SELECT * REPLACE (CASE WHEN tpep_pickup_datetime >= '1998-01-01' THEN cbd_congestion_fee END
        AS cbd_congestion_fee, CAST(VendorID AS BIGINT) AS VendorID) FROM (SELECT {stamped(RAW)} FROM trips)""",
    ),
    "s_csv_all_string": sql(TEXT, f"SELECT {_ALL_TEXT} FROM text_trips"),
    "s_csv_typed": sql(
        f"""{LINES}, split AS (SELECT string_split(value, ',') AS f FROM lines),
        typed AS (SELECT {", ".join(_TYPED)} FROM split)""",
        "SELECT * FROM typed WHERE VendorID IS NOT NULL",
    ),
    "s_line_parse": sql(
        FIELDS,
        f"SELECT {', '.join(f'nullif({field(n)}, {_EMPTY}) AS {n}' for n in _PLAIN_FIELDS)} FROM fields",
    ),
    "s_quality_counts": sql(
        f"""{FIELDS}, keys AS (SELECT f, trim({field("PULocationID")}) AS z, trim({field("pickup_hour")}) AS ht,
          trim({field("payment_type")}) AS pt FROM fields),
        k AS (SELECT *, {whole("ht")} AS h, {whole("pt")} AS p FROM keys)""",
        f"""
        SELECT 'zone_performance' AS job, count(*) FILTER (WHERE z <> '' AND {unreadable(ZONE)}) AS skipped_records FROM k
        UNION ALL SELECT 'hourly_performance', count(*) FILTER (WHERE ht <> '' AND
          (h IS NULL OR (h BETWEEN 0 AND 23 AND {unreadable(HOUR)}))) FROM k
        UNION ALL SELECT 'tip_behavior', count(*) FILTER (WHERE lower(pt) NOT IN ('', 'null') AND
          (p IS NULL OR (p IN (1, 2) AND {unreadable(TIP)}))) FROM k""",
    ),
    "s_ctas_orc": sql(TEXT, f"SELECT {', '.join(_ORC)} FROM text_trips"),
    "s_csv_sink": sql(CLEANED, f"SELECT {_CLEAN_TEXT} FROM cleaned"),
    "s_result_files": sql(
        CLEANED,
        """SELECT 'q08_hourly' AS report, pickup_hour, NULL::VARCHAR AS day_type, count(*) AS trip_count,
          avg2(trip_duration_min) AS avg_duration_min, avg2(total_amount) AS avg_total_amount,
          NULL::DOUBLE AS avg_distance_miles, NULL::DOUBLE AS avg_tip FROM cleaned GROUP BY pickup_hour
        UNION ALL SELECT 'q09_weekend', NULL, CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END, count(*),
          NULL, avg2(total_amount), avg2(trip_distance), avg2(tip_amount) FROM cleaned GROUP BY is_weekend""",
    ),
    "s_sample_n": sql(
        CLEANED,
        f"SELECT {_CLEAN_TEXT} FROM (SELECT * FROM cleaned ORDER BY md5({_SAMPLE_KEY}) LIMIT 50000)",
    ),
    "s_sample_fewer": sql(
        CLEANED,
        f"SELECT {_CLEAN_TEXT} FROM (SELECT * FROM cleaned ORDER BY md5({_SAMPLE_KEY}) LIMIT 5000)",
    ),
    "s_roundtrip_check": sql(
        TEXT,
        f"""SELECT n AS rows_written, n AS rows_read, 31 AS columns_written, 31 AS columns_read,
        nulls AS null_cells, nulls = 0 AS passed FROM (SELECT count(*) AS n,
        sum({" + ".join(f"({c} IS NULL)::INTEGER" for c in CLEAN)})::BIGINT AS nulls FROM text_trips)""",
    ),
    "s_data_dictionary": sql(
        TRIPS,
        " UNION ALL ".join(
            f"SELECT '{c}' AS attribute, {_quoted(ATTRIBUTES[c])} AS description, count({c}) AS filled_rows FROM trips"
            for c in RAW
            if c in ATTRIBUTES
        ),
    ),
    "s_tsv_rows": sql(
        f"{HOUR_RECORDS}, job AS ({HOUR_JOB})",
        r"""SELECT concat_ws(chr(9), pickup_hour, CAST(total_trips AS VARCHAR), printf('%.2f', total_revenue),
        printf('%.2f', avg_revenue_per_trip), printf('%.2f', avg_passengers), printf('%.2f', avg_duration_min),
        printf('%.2f', avg_tip), printf('%.2f', tip_percentage) || '%') AS line FROM job""",
    ),
    "s_tsv_read": sql(TIP_RECORDS, TIP_JOB),
    "s_null_profile": sql(
        TRIPS,
        " UNION ALL ".join(
            f"SELECT {i}::INTEGER AS position, '{c}' AS column_name, '{_SPARK_TYPES[c]}' AS data_type, "
            f"count(*) AS total_rows, count(*) - count({c}) AS null_rows FROM trips"
            for i, c in enumerate(RAW, start=1)
        ),
    ),
    "s_describe": sql(TRIPS, " UNION ALL ".join([_described(c) for c in _NUMBERS] + [_FLAG])),
    "s_title_row": sql(TRIPS, "SELECT 'Q1: Total Taxi Trips' AS query_title, count(*) AS total_trips FROM trips"),
    "c14_guards": sql(
        f"{LINES}, heads AS (SELECT split_part(value, ',', 1) AS v FROM lines WHERE trim(value) <> '')",
        f"""SELECT count(*) AS rows, count(TRY_CAST(v AS INTEGER)) AS vendors FROM heads
        WHERE v <> '{CLEAN[0]}'""",
    ),
    "p_time_features": sql(
        TRIPS,
        f"SELECT {stamped(['tpep_pickup_datetime'])}, PULocationID, DOLocationID, {TIME_FEATURES} FROM trips",
    ),
    "p_trip_metrics": sql(
        FEATURED,
        """SELECT PULocationID, DOLocationID, trip_distance, trip_duration_min, avg_speed_mph, fare_per_mile
        FROM featured""",
    ),
    "p_row_key": sql(
        TRIPS,
        """SELECT strftime(tpep_pickup_datetime, '%Y%m%d%H%M%S') AS compact, CAST(VendorID AS VARCHAR) || '_' ||
        strftime(tpep_pickup_datetime, '%Y%m%d%H%M%S') || '_' || CAST(PULocationID AS VARCHAR) AS row_key FROM trips""",
    ),
    "p_hour_key": sql(
        f"{FIELDS}, h AS (SELECT {field('pickup_hour')} AS t FROM fields), n AS (SELECT t, {whole('trim(t)')} AS i FROM h)",
        """SELECT nullif(t, '') AS hour_text, CASE WHEN i BETWEEN 0 AND 23 THEN lpad(CAST(i AS VARCHAR), 2, '0') END AS hour_key
        FROM n""",
    ),
    "p_fare_bucket": sql(
        TRIPS,
        f"""SELECT fare_amount, {BUCKET} AS bucket, CAST(payment_type AS VARCHAR) || '_FARE_' || {BUCKET} AS tip_key
        FROM trips""",
    ),
    "p_lenient_double": sql(
        f"""{TEXT}, t AS (SELECT *, CASE WHEN trip_distance > 110 THEN CASE payment_type WHEN 1 THEN 'Infinity'
        WHEN 2 THEN '-Infinity' WHEN 3 THEN ' NaN ' WHEN 4 THEN 'inf' ELSE '1.5x' END
        ELSE CAST(fare_amount AS VARCHAR) END AS fare_text FROM text_trips)""",
        f"SELECT PULocationID, DOLocationID, payment_type, {lenient('fare_text')} AS fare FROM t",
    ),
    "m1_zone_performance": sql(ZONE_RECORDS, zone_job("zone_records")),
    "m2_hourly_performance": sql(HOUR_RECORDS, HOUR_JOB),
    "m3_tip_behavior": sql(TIP_RECORDS, TIP_JOB),
    "m1_clean_zone_performance": sql(
        f"""{CLEANED}, filled AS (SELECT * REPLACE (CAST(PULocationID AS VARCHAR) AS PULocationID) FROM cleaned)""",
        zone_job("filled"),
    ),
    "v1_hourly_series": sql(
        f"{HOUR_RECORDS}, job AS ({HOUR_JOB})",
        "SELECT CAST(pickup_hour AS INTEGER) AS hour, total_trips, total_revenue FROM job",
    ),
    "v2_top10_zones": sql(
        f"{ZONE_RECORDS}, job AS ({zone_job('zone_records')})",
        """SELECT 'Zone ' || PULocationID AS zone_label, PULocationID, total_trips FROM job
        ORDER BY total_trips DESC, PULocationID LIMIT 10""",
    ),
    "v6_speed_fare": sql(
        f"{ZONE_RECORDS}, job AS ({zone_job('zone_records')})",
        "SELECT PULocationID, avg_speed_mph, avg_fare, total_trips FROM job",
    ),
    "v7_tip_by_bucket": sql(
        f"{TIP_RECORDS}, job AS ({TIP_JOB})",
        """SELECT b AS bucket_code, avg_tip_pct AS tip_pct, i::BIGINT AS bucket_order, c AS bucket_label
        FROM job JOIN (VALUES ('0_5', 1, '$0-$5'), ('5_10', 2, '$5-$10'), ('10_25', 3, '$10-$25'),
          ('25_50', 4, '$25-$50'), ('50_100', 5, '$50-$100'), ('100_PLUS', 6, '$100+')) AS x(b, i, c)
        ON payment_fare_bucket = '1_FARE_' || b""",
    ),
}

