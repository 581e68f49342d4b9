"""Edge values of the parsers, the cleaning rules and the reports."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation

from hackney.functions import labels, numbers, times, trips
from hackney.operators import cleaning, jobs, profiling, reports, series
from hackney.schema import CLEAN_COLUMNS, RAW_COLUMNS, struct_of
from hackney.sources import delimited, parquet, tables
from hackney.sources.scratch import scratch_root

GOOD = {
    **dict.fromkeys(CLEAN_COLUMNS, "1"),
    "PULocationID": "7",
    "payment_type": "1",
    "fare_amount": "10.0",
    "tip_amount": "2.0",
    "total_amount": "12.0",
    "pickup_hour": "5",
}


def line(**changes: str) -> str:
    return ",".join({**GOOD, **changes}.values())


@pytest.fixture
def read(spark, tmp_path):
    def write_and_read(*lines: str):
        (tmp_path / "trips.txt").write_text("\n".join(lines) + "\n")
        return delimited.read_lines(spark, str(tmp_path))

    return write_and_read


def value(spark, sql: str):
    return spark.sql(f"SELECT {sql} AS v").first()["v"]


def test_unusable_lines_are_left_out(read):
    short = line().rsplit(",", 1)[0]
    rows = read("", "   ", ",".join(CLEAN_COLUMNS), short, line(), line() + ",extra", "  " + line() + " ")
    assert rows.columns == list(CLEAN_COLUMNS)
    assert rows.count() == 3
    assert {r["VendorID"] for r in rows.collect()} == {"1"}


def test_quotes_mean_nothing_to_lines_and_something_to_csv(spark, tmp_path, read):
    quoted = line(store_and_fwd_flag='"x,y"')
    row = read(quoted).first()
    assert (row["store_and_fwd_flag"], row["PULocationID"]) == ('"x', 'y"')
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "t.csv").write_text(",".join(CLEAN_COLUMNS) + "\n" + quoted + "\n")
    row = delimited.read_staging_csv(spark, str(folder)).first()
    assert (row["store_and_fwd_flag"], row["PULocationID"]) == ("x,y", "7")


@pytest.mark.parametrize("text", ["", "null", "NULL", "NA", "nan", "NaN", "Infinity", "-Infinity", "+Infinity", " ", "1e999"])
def test_missing_numbers_are_zero_and_counted(spark, read, text):
    assert value(spark, numbers.lenient_double(f"'{text}'")) == 0.0
    report = jobs.zone_performance(jobs.zone_records(read(line(fare_amount=text), line()))).first()
    assert (report["total_trips"], report["avg_fare"]) == (2, 5.0)


@pytest.mark.parametrize("text", ["abc", "1,5", "1.5x", "inf", "-inf", "infinity", "--1"])
def test_junk_numbers_are_null(spark, text):
    assert value(spark, numbers.lenient_double(f"'{text}'")) is None


def test_plain_numbers(spark):
    assert value(spark, numbers.lenient_double("' 1.5\\t'")) == 1.5
    assert value(spark, numbers.lenient_double("'1e3'")) == 1000.0
    assert value(spark, numbers.lenient_double("CAST(NULL AS string)")) == 0.0


def test_zone_job_skips_and_counts(read):
    lines = read(line(), line(fare_amount="abc"), line(PULocationID=""), line(PULocationID=" 7 "))
    quality = Observation()
    rows = jobs.zone_performance(jobs.zone_records(lines), quality).collect()
    assert [(r["PULocationID"], r["total_trips"]) for r in rows] == [("7", 2)]
    assert quality.get == {"skipped_records": 1}
    counts = {r["job"]: r["skipped_records"] for r in jobs.quality_counts(lines).collect()}
    assert counts == {"zone_performance": 1, "hourly_performance": 1, "tip_behavior": 1}


def test_reports_can_share_a_query(read):
    lines = read(line(), line(fare_amount="abc"))
    zones, hours = jobs.zone_records(lines), jobs.hour_records(lines)
    both = [jobs.zone_performance(zones), jobs.zone_performance(zones.where("true")), jobs.hourly_performance(hours)]
    counts = [frame.select("total_trips") for frame in both]
    assert [r[0] for r in counts[0].union(counts[1]).union(counts[2]).collect()] == [1, 1, 1]


def test_hour_job(read):
    hours = ["5", "24", "-1", "5.0", "", " 23 ", "x"]
    lines = read(*[line(pickup_hour=h) for h in hours])
    rows = jobs.hourly_performance(jobs.hour_records(lines)).collect()
    assert [(r["pickup_hour"], r["total_trips"]) for r in rows] == [("05", 1), ("23", 1)]
    counts = {r["job"]: r["skipped_records"] for r in jobs.quality_counts(lines).collect()}
    assert counts["hourly_performance"] == 2


def test_hour_job_without_fares(read):
    row = jobs.hourly_performance(jobs.hour_records(read(line(fare_amount="0")))).first()
    assert row["tip_percentage"] == 0.0


def test_tip_job_payments(read):
    lines = read(*[line(payment_type=p) for p in ["1", "2", "null", "", "3", "1.0"]])
    rows = jobs.tip_behavior(jobs.tip_records(lines)).collect()
    assert [r["payment_fare_bucket"] for r in rows] == ["1_FARE_10_25", "2_FARE_10_25"]
    counts = {r["job"]: r["skipped_records"] for r in jobs.quality_counts(lines).collect()}
    assert counts["tip_behavior"] == 1


def test_tip_job_buckets_and_text_order(read):
    fares = ["0", "-5", "4.99", "5", "9.99", "10", "25", "50", "100"]
    job = jobs.tip_behavior(jobs.tip_records(read(*[line(fare_amount=f) for f in fares])))
    rows = [(r["payment_fare_bucket"].removeprefix("1_FARE_"), r["total_trips"]) for r in job.collect()]
    assert rows == [("0_5", 1), ("100_PLUS", 1), ("10_25", 1), ("25_50", 1), ("50_100", 1), ("5_10", 2)]
    bars = series.tip_by_bucket(job).collect()
    assert [r["bucket_code"] for r in bars] == list(trips.FARE_BUCKET_ORDER)
    assert [r["bucket_label"] for r in bars] == list(series.BUCKET_CAPTIONS)


def test_zero_tip_rate(read):
    job = jobs.tip_behavior(jobs.tip_records(read(line(), line(tip_amount="0"), line(tip_amount=""))))
    assert job.first()["zero_tip_rate"] == 66.67


def test_zones_are_ordered_as_text(read):
    job = jobs.zone_performance(jobs.zone_records(read(*[line(PULocationID=z) for z in ["2", "10", "1", "100"]])))
    assert [r["PULocationID"] for r in job.collect()] == ["1", "10", "100", "2"]


def test_typed_records_count_missing_as_zero(spark):
    frame = spark.sql("SELECT * FROM VALUES (7, 10D), (7, NULL), (7, double('NaN')) AS t(PULocationID, fare_amount)")
    for name in jobs.ZONE_MEASURES[1:]:
        frame = frame.selectExpr("*", f"1D AS {name}")
    assert jobs.zone_performance(jobs.zone_records_of(frame)).first()["avg_fare"] == 3.33


@pytest.mark.parametrize(
    ("rule", "row", "kept"),
    [
        (cleaning.valid_passengers(), "passenger_count", {"0.9": False, "1.5": True, "6.9": True, "7": False, "x": False}),
        (cleaning.valid_distance(), "trip_distance", {"0": False, "100": True, "100.1": False, "NaN": False}),
        (cleaning.valid_flag(), "store_and_fwd_flag", {" y ": True, "n": True, "x": False}),
        (cleaning.valid_rate_code("RatecodeID"), "RatecodeID", {"1": True, "6": True, "99": False}),
        (cleaning.valid_vendor(), "VendorID", {"1": True, "2": True, "6": False}),
        (cleaning.valid_money(["total_amount"]), "total_amount", {"0": True, "500": True, "500.01": False, "-1": False, "NaN": False}),
        (cleaning.valid_money(["tip_amount"]), "tip_amount", {"0": True, "1000": True, "NaN": False, "-0.01": False}),
    ],
)
def test_rule_bounds(spark, rule, row, kept):
    for text, expected in kept.items():
        assert value_rule(spark, rule, **{row: f"'{text}'"}) is expected, text
    assert not value_rule(spark, rule, **{row: "CAST(NULL AS string)"})


def value_rule(spark, rule: str, **columns: str) -> bool:
    row = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return spark.sql(f"SELECT * FROM (SELECT {row}) WHERE {rule}").count() == 1


@pytest.mark.parametrize(("seconds", "kept"), [(59, False), (60, True), (10800, True), (10801, False), (-60, False)])
def test_duration_bounds(spark, seconds, kept):
    start = "timestamp_ntz'2026-01-01 00:00:00'"
    times_ = {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": f"timestampadd(SECOND, {seconds}, {start})",
    }
    assert value_rule(spark, cleaning.valid_duration(), **times_) is kept


@pytest.mark.parametrize(
    ("latitude", "longitude", "kept"),
    [("40.40", "-74.0", True), ("41.11", "-74.0", False), ("0", "0", False), ("40.7", "-73.5", False), ("'x'", "-74.0", False)],
)
def test_coordinate_bounds(spark, latitude, longitude, kept):
    point = {f"{end}_{axis}": v for end in ("pickup", "dropoff") for axis, v in (("latitude", latitude), ("longitude", longitude))}
    assert value_rule(spark, cleaning.valid_coordinates(), **point) is kept


def test_unreadable_times_fail(spark):
    assert not value_rule(
        spark, cleaning.valid_times(), tpep_pickup_datetime="'nonsense'", tpep_dropoff_datetime="'2026-01-01 00:00:00'"
    )


def test_rate_code_rule_follows_the_exact_spelling():
    def steps(columns, **options):
        return {r.step: r.keep for r in cleaning.row_rules(columns, **options)}

    base = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance"]
    step = cleaning.RATE_CODE_STEP
    assert steps([*base, "RatecodeID"])[step] == "true"
    assert "RateCodeID" in steps([*base, "RateCodeID"])[step]
    assert "RatecodeID" in steps([*base, "RatecodeID"], apply_ratecode_rule=True)[step]
    assert steps(base)[cleaning.PASSENGERS_STEP] == "true"
    assert cleaning.GEO_STEP in steps([*base, *cleaning.GEO_COLUMNS])
    assert cleaning.ZONES_STEP not in steps(base)


def raw_rows(spark, *changes: dict):
    base = {name: f"CAST(NULL AS {kind})" for name, kind in RAW_COLUMNS.items()}
    base |= {
        "VendorID": "1",
        "tpep_pickup_datetime": "timestamp_ntz'2026-01-03 10:00:00'",
        "tpep_dropoff_datetime": "timestamp_ntz'2026-01-03 10:14:02'",
        "passenger_count": "2.9D",
        "trip_distance": "2.6D",
        "store_and_fwd_flag": "' n '",
        "PULocationID": "1",
        "DOLocationID": "2",
        "total_amount": "20.65D",
        "RatecodeID": "99D",
    }
    base |= {name: "1D" for name in cleaning.MONEY_COLUMNS if name != "total_amount"}
    rows = ["SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in {**base, **c}.items()) for c in changes]
    return spark.sql(" UNION ALL ".join(rows))


def test_clean_trip(spark):
    raw = raw_rows(spark, {}, {}, {"VendorID": "6"}, {"extra": "double('NaN')"}, {"trip_distance": "99D"})
    clean = cleaning.clean_trips(raw)
    assert clean.columns == list(CLEAN_COLUMNS)
    row = clean.collect()
    assert len(row) == 1
    row = row[0]
    assert (row["passenger_count"], row["store_and_fwd_flag"], row["RatecodeID"]) == (2, "N", 99.0)
    assert (row["trip_duration_min"], row["avg_speed_mph"], row["fare_per_mile"]) == (14.03, 11.12, 7.94)
    assert (row["pickup_date"], row["pickup_day_name"], row["pickup_dayofweek"], row["is_weekend"]) == (
        "2026-01-03", "Saturday", 5, 1,
    )


def test_report_adds_up(spark):
    raw = raw_rows(spark, {}, {}, {}, {"VendorID": "6"}, {"extra": "double('NaN')"}, {"trip_distance": "99D"}, {"DOLocationID": "NULL"})
    report = {r["cleaning_step"]: (r["rows_removed"], r["rows_remaining"]) for r in cleaning.removal_report(raw).collect()}
    assert report[cleaning.DUPLICATES_STEP] == (2, 5)
    assert report[cleaning.VENDOR_STEP] == (1, 4)
    assert report[cleaning.ZONES_STEP] == (1, 3)
    assert report[cleaning.SPEED_STEP] == (1, 1)
    assert report["TOTAL"] == (6, 1)
    assert cleaning.clean_trips(raw).count() == 1


def test_copies_with_nan_and_null_collapse(spark):
    raw = raw_rows(spark, {"extra": "double('NaN')"}, {"extra": "double('NaN')"}, {"extra": "NULL"}, {"extra": "NULL"})
    assert cleaning.drop_copies(raw).count() == 2


def test_rounding_rules(spark):
    assert value(spark, numbers.round_half_even("0.125D")) == 0.12
    assert value(spark, "round(0.125D, 2)") == 0.13
    assert value(spark, numbers.strict_int("' 05 '")) == 5
    assert value(spark, numbers.strict_int("'5.0'")) is None
    assert value(spark, numbers.truncated_int("'1.9'")) == 1
    assert value(spark, numbers.percent("1D", "0D")) is None
    assert value(spark, numbers.percent_or_zero("1D", "0D")) == 0.0


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = "timestamp_ntz'2026-03-08 02:30:00'"
        assert value(spark, times.compact_time(gap)) == "20260308023000"
        assert value(spark, f"hour({gap})") == 2
        assert value(spark, times.minutes_between("timestamp_ntz'2026-03-08 01:30:00'", gap)) == 60.0
        assert value(spark, times.day_name(gap)) == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_labels_share_names_but_not_rows(spark):
    frame = spark.sql(
        "SELECT payment_type, 1D AS total_amount, 0D AS tip_amount FROM VALUES (5), (6), (CAST(NULL AS int)) AS t(payment_type)"
    )
    rows = reports.payment(frame).collect()
    assert [(r["payment_method"], r["trip_count"]) for r in rows] == [("Unknown", 1)] * 3
    assert value(spark, labels.rate_code_label("99D")) == "Other/Unknown"
    assert value(spark, labels.rate_code_label("2D")) == "JFK Airport"


def test_occupancy_cuts_fractions(spark):
    frame = spark.sql(
        "SELECT passenger_count, 1D AS trip_distance, 1D AS total_amount, 1D AS tip_amount, 0D AS fare_amount "
        "FROM VALUES (1.5D), (1D), (6D), (6.5D), (0.5D) AS t(passenger_count)"
    )
    rows = reports.occupancy(frame).collect()
    assert [(r["passenger_count"], r["trip_count"], r["tip_percentage"]) for r in rows] == [(1, 2, None), (6, 1, None)]


def test_parquet_folder_is_matched_by_name(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 2 AS b").write.parquet(str(tmp_path / "raw"))
    spark.sql("SELECT 5 AS c, 4 AS a").write.mode("append").parquet(str(tmp_path / "raw"))
    rows = {(r["a"], r["b"], r["c"]) for r in parquet.read_trip_files(spark, str(tmp_path / "raw")).collect()}
    assert rows == {(1, 2, None), (4, None, 5)}
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="schema"):
        parquet.read_trip_files(spark, str(tmp_path / "empty"))
    wide = parquet.concat_trips(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2.5D AS a, 'x' AS b"))
    assert {(r["a"], r["b"]) for r in wide.collect()} == {(1.0, None), (2.5, "x")}


def test_typed_table_turns_bad_values_into_null(spark, tmp_path):
    (tmp_path / "t.txt").write_text(line(VendorID="x") + "\n" + line(passenger_count="abc", payment_type="1.0") + "\n")
    rows = reports.guarded(delimited.read_typed_csv(spark, str(tmp_path))).collect()
    assert [(r["VendorID"], r["passenger_count"], r["payment_type"], r["fare_amount"]) for r in rows] == [(1, None, 1, 10.0)]


def test_round_trip_check_notices_empty_cells(spark, tmp_path):
    frame = spark.sql("SELECT '1' AS a, CAST(NULL AS string) AS b")
    tables.write_csv(frame, str(tmp_path / "t"))
    back = spark.read.option("header", True).csv(str(tmp_path / "t"))
    row = tables.round_trip_check(frame, back).first()
    assert (row["rows_written"], row["rows_read"], row["null_cells"], row["passed"]) == (1, 1, 1, False)


def test_data_dictionary_knows_exact_names_only(spark):
    frame = spark.createDataFrame([], struct_of(RAW_COLUMNS))
    names = {r["attribute"] for r in profiling.data_dictionary(frame).collect()}
    assert "VendorID" in names and "RatecodeID" not in names and "congestion_surcharge" not in names


def test_scratch_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    else:
        assert scratch_root(spark)
