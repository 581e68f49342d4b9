"""SQL checks of the keyed wide table."""

from __future__ import annotations

from hackney.plans.checks.base import FEATURED, avg2, sql, stamp

TRIP_INFO = "passenger_count, trip_distance, PULocationID, DOLocationID, payment_type"
FINANCIALS = "fare_amount, tip_amount, total_amount, congestion_surcharge"
TIMING = "pickup_datetime, dropoff_datetime, trip_duration_min, pickup_hour, pickup_day_name"
METRICS = "avg_speed_mph, fare_per_mile, is_weekend"
ALL = f"row_key, {TRIP_INFO}, {FINANCIALS}, {TIMING}, {METRICS}"

WIDE = f"""{FEATURED},
puts AS (
  SELECT CAST(VendorID AS VARCHAR) || '_' || strftime(tpep_pickup_datetime, '%Y%m%d%H%M%S') || '_' ||
      CAST(PULocationID AS VARCHAR) AS row_key,
    * REPLACE (trunc(passenger_count)::INTEGER AS passenger_count),
    {stamp("tpep_pickup_datetime")} AS pickup_datetime, {stamp("tpep_dropoff_datetime")} AS dropoff_datetime
  FROM featured
),
wide AS (
  SELECT {ALL} FROM puts
  QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY dropoff_datetime DESC, DOLocationID DESC,
    payment_type DESC, total_amount DESC, trip_distance DESC) = 1
)"""

EDGES = f"""{WIDE},
ends AS (SELECT min(row_key) AS low, max(row_key) AS high FROM wide GROUP BY substr(row_key, 1, 1)),
edges AS (SELECT unnest([low, high, high || '_absent']) AS row_key FROM ends)"""

SPEED_TEXT = "CAST(avg_speed_mph AS VARCHAR)"


def k(body: str, tables: str = WIDE) -> str:
    return sql(tables, body)


SQL = {
    "k_wide_rows": k(f"SELECT {ALL} FROM wide"),
    "k_upsert_latest": """SELECT event_type, hour(ts)::INTEGER AS hour, user_id % 10 AS user_bucket,
      max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL""",
    "k_put_rows": k(
        """SELECT row_key, fare_amount, CASE WHEN payment_type = 1 THEN 0 ELSE tip_amount END AS tip_amount,
          total_amount, congestion_surcharge FROM wide
        UNION ALL SELECT '9_' || row_key, fare_amount, 0, total_amount, congestion_surcharge FROM wide
        WHERE payment_type = 1 AND trip_distance > 100"""
    ),
    "k_merge_cells": k(
        """SELECT row_key, fare_amount, CASE WHEN trip_distance > 100 THEN 0 ELSE tip_amount END AS tip_amount,
          total_amount, congestion_surcharge,
          CASE WHEN trip_distance > 100 THEN 'verified' END AS status, avg_speed_mph FROM wide
        UNION ALL SELECT '9_' || row_key, NULL, 0, NULL, NULL, 'new', NULL FROM wide WHERE trip_distance > 100"""
    ),
    "k_get_row": k(f"SELECT {ALL} FROM wide WHERE row_key = (SELECT max(row_key) FROM wide)"),
    "k_get_cell": k(
        f"SELECT row_key, {FINANCIALS}, is_weekend FROM wide WHERE row_key = (SELECT max(row_key) FROM wide)"
    ),
    "k_multi_get": k(
        """SELECT e.row_key, trip_distance, total_amount, w.row_key IS NOT NULL AS found
        FROM edges e LEFT JOIN wide w ON w.row_key = e.row_key""",
        EDGES,
    ),
    "k_delete_rows": k(
        "SELECT row_key, total_amount FROM wide WHERE row_key NOT IN (SELECT row_key FROM edges)", EDGES
    ),
    "k_change_stored": k(
        """SELECT row_key, fare_amount, CASE WHEN payment_type = 1 AND trip_distance > 100 THEN 0 ELSE tip_amount END AS tip_amount,
          total_amount, congestion_surcharge FROM wide
        WHERE row_key NOT IN (SELECT row_key FROM edges) OR (payment_type = 1 AND trip_distance > 100)
        UNION ALL SELECT '9_' || row_key, fare_amount, 0, total_amount, congestion_surcharge FROM wide
        WHERE payment_type = 1 AND trip_distance > 100""",
        EDGES,
    ),
    "k_delete_cell": k(
        """SELECT row_key, fare_amount, CASE WHEN payment_type <> 4 THEN tip_amount END AS tip_amount,
        total_amount, congestion_surcharge FROM wide"""
    ),
    "k_delete_audit": k(
        """SELECT count(*) AS rows_before,
        count(*) FILTER (WHERE row_key NOT IN (SELECT row_key FROM edges)) AS rows_after,
        0::BIGINT AS still_present FROM wide""",
        EDGES,
    ),
    "k_scan_limit": k(f"SELECT {ALL} FROM wide ORDER BY row_key LIMIT 3"),
    "k_scan_reverse": k(f"SELECT {ALL} FROM wide ORDER BY row_key DESC LIMIT 3"),
    "k_range_scan": k(f"SELECT {ALL} FROM wide WHERE row_key >= '1_199601' AND row_key < '2_199601'"),
    "k_prefix_scan": k(f"SELECT {ALL} FROM wide WHERE starts_with(row_key, '1_')"),
    "k_prefix_page": k(f"SELECT {ALL} FROM wide WHERE starts_with(row_key, '2_') ORDER BY row_key LIMIT 4"),
    "k_page_summary": k(
        """SELECT count(*) AS page_rows, sum2(total_amount) AS page_revenue
        FROM (SELECT total_amount FROM wide ORDER BY row_key LIMIT 5)"""
    ),
    "k_value_filter": k(f"SELECT row_key, {METRICS} FROM wide WHERE avg_speed_mph > 12"),
    "k_value_filter_bytes": k(f"SELECT row_key, {METRICS} FROM wide WHERE {SPEED_TEXT} > '12.0'"),
    "k_value_regex": k(f"SELECT row_key, {TRIP_INFO}, {METRICS} FROM wide WHERE passenger_count IN (1, 2)"),
    "k_key_regex_and_value": k(
        """SELECT row_key, trip_distance, fare_amount, total_amount FROM wide
        WHERE fare_amount >= 25 AND starts_with(row_key, '2_1997')"""
    ),
    "k_zero_tip_high_total": k(
        f"SELECT {ALL} FROM wide WHERE tip_amount = 0 AND total_amount >= 15 ORDER BY row_key DESC LIMIT 5"
    ),
    "k_column_prefix": k("SELECT row_key, fare_amount, fare_per_mile FROM wide WHERE avg_speed_mph > 15"),
    "k_project_columns": k("SELECT row_key, passenger_count, trip_distance, total_amount FROM wide"),
    "k_count": k("SELECT count(*) AS row_count FROM wide"),
    "k_schema_evolution": k(
        """SELECT max(row_key) AS row_key, 'verified' AS status, 'desk1' AS reviewed_by, 5 AS groups_with,
        4 AS groups_after, count(*) AS rows_after FROM wide"""
    ),
    "k_vendor_report": k(
        """SELECT vendor, trips, CAST(round(revenue, 2) AS DOUBLE) AS total_revenue, CAST(round(miles, 2) AS DOUBLE) AS total_distance,
          mean AS avg_revenue_per_trip,
          vendor = (SELECT max(vendor) FROM per WHERE revenue = (SELECT max(revenue) FROM per)) AS best FROM per
        UNION ALL SELECT 'TOTAL', sum(trips)::BIGINT, CAST(round(sum(revenue), 2) AS DOUBLE), NULL, NULL, NULL FROM per""",
        f"""{WIDE}, per AS (SELECT v AS vendor, count(row_key) AS trips, coalesce(sum(CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(28, 12))), 0) AS revenue,
          coalesce(sum(CAST(CAST(trip_distance AS VARCHAR) AS DECIMAL(28, 12))), 0) AS miles, coalesce(avg2(total_amount), 0) AS mean
          FROM (VALUES ('1'), ('2')) AS d(v) LEFT JOIN wide ON substr(row_key, 1, 1) = v GROUP BY v)""",
    ),
    "k_high_revenue": k(
        """SELECT count(*) FILTER (WHERE total_amount > 40) AS trips,
        sum2(CASE WHEN total_amount > 40 THEN total_amount END) AS combined_revenue,
        round(count(*) FILTER (WHERE total_amount > 40) * 100 / count(*), 1) AS pct_of_trips FROM wide"""
    ),
    "k_high_revenue_rows": k(
        """SELECT row_key, trip_distance, fare_amount, tip_amount, total_amount, avg_speed_mph, pickup_datetime
        FROM wide WHERE total_amount > 40"""
    ),
    "k_card_revenue": k(
        """SELECT count(*) AS card_trips, sum2(total_amount) AS card_revenue,
        sum2(tip_amount) AS card_tips, avg2(tip_amount) AS avg_tip FROM wide WHERE payment_type = 1"""
    ),
    "k_fast_trips": k(
        """SELECT count(*) AS fast_trips, avg2(trip_distance) AS avg_distance FROM wide
        WHERE avg_speed_mph > 12"""
    ),
    "k_fast_trips_bytes": k(
        f"""SELECT count(*) AS fast_trips, avg2(trip_distance) AS avg_distance FROM wide
        WHERE {SPEED_TEXT} > '12.0'"""
    ),
    "k_vendor_audit": k(
        """SELECT count(*) AS trips, avg2(trip_distance) AS avg_distance,
        sum2(total_amount) AS total_revenue FROM wide WHERE starts_with(row_key, '2_')"""
    ),
    "k_dashboard": k(
        """SELECT 1 AS line, 'card revenue' AS report, count(*) AS trips, 'revenue' AS measure,
          sum2(total_amount) AS value FROM wide WHERE payment_type = 1
        UNION ALL SELECT 2, 'fast trips', count(*), 'avg_distance', avg2(trip_distance) FROM wide
          WHERE avg_speed_mph > 12
        UNION ALL SELECT 3, 'vendor audit', count(*), 'avg_distance', avg2(trip_distance) FROM wide
          WHERE starts_with(row_key, '2_')
        UNION ALL SELECT 4, 'first page', count(*), 'revenue', sum2(total_amount)
          FROM (SELECT total_amount FROM wide ORDER BY row_key LIMIT 5)"""
    ),
    "k_speed_outliers": k(
        """SELECT e.row_key, trip_distance, total_amount, avg_speed_mph, trip_duration_min,
          p.row_key IS NOT NULL AS found, mean_speed, mean_total, threshold,
          CASE WHEN avg_speed_mph > 0 AND avg_speed_mph < ms / 2 THEN 'OUTLIER'
            WHEN avg_speed_mph > 0 THEN 'OK' END AS flag
        FROM edges e LEFT JOIN picked p ON p.row_key = e.row_key, means""",
        f"""{EDGES}, picked AS (SELECT * FROM wide WHERE row_key IN (SELECT row_key FROM edges)),
        filled AS (SELECT coalesce(avg_speed_mph, 0) AS speed, coalesce(total_amount, 0) AS total FROM picked),
        means AS (SELECT avg(speed) AS ms, avg2(speed) AS mean_speed, avg2(total) AS mean_total, {avg2("speed", parts=2)} AS threshold
          FROM filled)""",
    ),
    "k_zero_fare_cleanup": k(f"SELECT row_key, {FINANCIALS} FROM wide WHERE trip_distance <= 100 AND total_amount <> 0"),
}
