"""SQL checks of the reports and of the series made from them."""

from __future__ import annotations

from hackney.plans.checks.base import FEATURED, sql, stamp
from hackney.plans.checks.cleaning import CLEANED

# Labels and output names of the reports.
PAYMENT = """CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
  WHEN 4 THEN 'Dispute' ELSE 'Unknown' END"""
RATE_CODE = """CASE trunc(RatecodeID)::INTEGER WHEN 1 THEN 'Standard Rate' WHEN 2 THEN 'JFK Airport'
  WHEN 3 THEN 'Newark Airport' WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated Fare'
  WHEN 6 THEN 'Group Ride' ELSE 'Other/Unknown' END"""
PERIOD = """CASE WHEN pickup_hour BETWEEN 16 AND 19 THEN 'Peak Evening (16-19)'
  WHEN pickup_hour BETWEEN 7 AND 9 THEN 'Peak Morning (07-09)' ELSE 'Off-Peak' END"""
DAY_TYPE = "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"

_ZONES = """SELECT PULocationID, count(*) AS trip_count, avg2(total_amount) AS avg_total_amount,
  avg2(tip_amount) AS avg_tip, sum2(total_amount) AS total_revenue
  FROM featured GROUP BY PULocationID"""


def q(body: str) -> str:
    """Reports run over the cleaned trips."""
    return sql(f"{CLEANED}, featured AS (SELECT * FROM cleaned)", body)


SQL = {
    "q01_total_trips": q("SELECT count(*) AS total_trips FROM featured"),
    "q02_total_revenue": q("SELECT sum2(total_amount) AS total_revenue FROM featured"),
    "q03_averages": q(
        """SELECT avg2(fare_amount) AS avg_fare, avg2(trip_distance) AS avg_distance_miles,
        avg2(trip_duration_min) AS avg_duration_min, avg2(avg_speed_mph) AS avg_speed_mph
        FROM featured"""
    ),
    "q04_top_zones_volume": q(
        """SELECT PULocationID, count(*) AS trip_count FROM featured GROUP BY PULocationID
        ORDER BY trip_count DESC, PULocationID LIMIT 20"""
    ),
    "q05_top_zones_revenue": q(
        """SELECT PULocationID, count(*) AS trip_count, sum2(total_amount) AS total_revenue,
        avg2(total_amount) AS avg_revenue_per_trip FROM featured GROUP BY PULocationID
        ORDER BY total_revenue DESC, PULocationID LIMIT 20"""
    ),
    "q06_top_trips": q(
        f"""SELECT PULocationID, DOLocationID, {stamp("t.tpep_pickup_datetime")} AS tpep_pickup_datetime,
        once2(trip_distance) AS trip_distance_miles, once2(trip_duration_min) AS trip_duration_min,
        once2(fare_amount) AS fare_amount, once2(tip_amount) AS tip_amount,
        once2(total_amount) AS total_amount FROM (SELECT * FROM featured
        ORDER BY total_amount DESC, tpep_pickup_datetime, PULocationID, DOLocationID LIMIT 10) AS t"""
    ),
    "q07_distance_stats": q(
        """SELECT max(trip_distance) AS max_distance_miles, min(trip_distance) AS min_distance_miles,
        avg2(trip_distance) AS avg_distance_miles, count(*) AS total_trips FROM featured
        WHERE trip_distance > 0"""
    ),
    "q08_hourly": q(
        """SELECT pickup_hour, count(*) AS trip_count, avg2(trip_duration_min) AS avg_duration_min,
        avg2(total_amount) AS avg_total_amount FROM featured GROUP BY pickup_hour ORDER BY pickup_hour"""
    ),
    "q09_weekend": q(
        f"""SELECT {DAY_TYPE} AS day_type, count(*) AS trip_count, avg2(total_amount) AS avg_total_amount,
        avg2(trip_distance) AS avg_distance_miles, avg2(tip_amount) AS avg_tip
        FROM featured GROUP BY is_weekend ORDER BY is_weekend"""
    ),
    "q10_payment": q(
        f"""SELECT {PAYMENT} AS payment_method, count(*) AS trip_count, sum2(total_amount) AS total_revenue,
        avg2(tip_amount) AS avg_tip, avg2(total_amount) AS avg_fare
        FROM featured GROUP BY payment_type ORDER BY trip_count DESC, payment_type"""
    ),
    "q11_high_volume": q(f"SELECT * FROM ({_ZONES}) WHERE trip_count > 220"),
    "q11b_adaptive": q(
        f"SELECT * FROM ({_ZONES}) WHERE trip_count >= (SELECT greatest(10, count(*) // 500) FROM featured)"
    ),
    "q12_monthly": q(
        """SELECT pickup_year, pickup_month, count(*) AS trip_count, sum2(total_amount) AS total_revenue,
        avg2(trip_distance) AS avg_distance_miles, avg2(trip_duration_min) AS avg_duration_min,
        avg2(fare_amount) AS avg_fare FROM featured GROUP BY pickup_year, pickup_month
        ORDER BY pickup_year, pickup_month"""
    ),
    "q13_ratecode": q(
        f"""SELECT {RATE_CODE} AS rate_code_description, count(*) AS trip_count,
        sum2(total_amount) AS total_revenue, avg2(fare_amount) AS avg_fare,
        avg2(trip_distance) AS avg_distance_miles, avg2(avg_speed_mph) AS avg_speed_mph,
        avg2(fare_per_mile) AS avg_fare_per_mile FROM featured GROUP BY RatecodeID
        ORDER BY trip_count DESC, RatecodeID"""
    ),
    "q14_peak": q(
        f"""SELECT {PERIOD} AS time_period, count(*) AS trip_count, sum2(total_amount) AS total_revenue,
        sum2(congestion_surcharge) AS total_congestion_surcharge,
        sum2(cbd_congestion_fee) AS total_cbd_fee, sum2(Airport_fee) AS total_airport_fee,
        sum2(tolls_amount) AS total_tolls FROM featured GROUP BY 1 ORDER BY trip_count DESC, time_period"""
    ),
    "q15_occupancy": q(
        """SELECT trunc(t.passenger_count)::INTEGER AS passenger_count, count(*) AS trip_count,
        avg2(trip_distance) AS avg_distance_miles, avg2(total_amount) AS avg_total_amount,
        avg2(tip_amount) AS avg_tip_amount,
        round(sum(CAST(CAST(tip_amount AS VARCHAR) AS DECIMAL(28, 12)))::DOUBLE / nullif(sum(CAST(CAST(fare_amount AS VARCHAR) AS DECIMAL(28, 12)))::DOUBLE, 0) * 100, 2) AS tip_percentage
        FROM featured AS t WHERE t.passenger_count BETWEEN 1 AND 6 GROUP BY 1 ORDER BY 1"""
    ),
    "p_labels": sql(
        FEATURED,
        f"""SELECT CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
        ELSE 'Unknown' END AS vendor, {PAYMENT} AS payment_method, {RATE_CODE} AS rate_code_description,
        {DAY_TYPE} AS day_type, {PERIOD} AS time_period, count(*) AS trips FROM featured GROUP BY ALL""",
    ),
    "v3_payment_share": q(
        f"""SELECT {PAYMENT} AS payment_method, count(*) AS trip_count,
        round(100 * count(*) / (SELECT count(*) FROM featured), 1) AS share_pct FROM featured GROUP BY payment_type"""
    ),
    "v4_weekend_series": q(
        f"""SELECT {DAY_TYPE} AS day_type, count(*) AS trip_count, avg2(total_amount) AS avg_total_amount
        FROM featured GROUP BY is_weekend"""
    ),
    "v5_month_series": q(
        """SELECT pickup_month, strftime(make_date(1997, pickup_month, 1), '%b') || ' 1997' AS month_name,
        sum2(total_amount) AS total_revenue FROM featured
        WHERE pickup_year = 1997 AND pickup_month IN (1, 2, 3) GROUP BY pickup_month ORDER BY pickup_month"""
    ),
    "v8_ratecode_yield": q(
        f"""SELECT {RATE_CODE} AS rate_code_description, count(*) AS trip_count,
        avg2(fare_per_mile) AS avg_fare_per_mile FROM featured GROUP BY RatecodeID"""
    ),
}
