"""Every query by name: a callable from (session, table folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions import labels, numbers, times
from hackney.functions import trips as trip_exprs
from hackney.operators import (
    cleaning,
    features,
    jobs,
    keyed,
    keyed_reports,
    profiling,
    reports,
    sampling,
    series,
)
from hackney.plans import binding
from hackney.sources import delimited, parquet, tables
from hackney.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that suit the value ranges of the test tables.
MAX_TOTAL = binding.MAX_TOTAL
MIN_TRIPS = 220
SERIES_YEAR, SERIES_MONTHS = 1997, (1, 2, 3)

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def portable(frame: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare across engines."""
    late = {n: times.time_text(n) for n, kind in frame.dtypes if kind.startswith("timestamp")}
    return features.with_columns(frame, late) if late else frame


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_lines(spark, binding.lines_path(spark, sf_dir))


def written_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv")
    tables.write_csv(binding.text_trips(spark, sf_dir), path)
    return path


# --- sources and sinks ---------------------------------------------------


@query("s_parquet_concat")
def s_parquet_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files: the older one lacks the newest surcharge column and has other number types."""
    path = scratch_path(spark, "raw")
    trips = binding.trips(spark, sf_dir)
    older = F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")
    narrow = {"VendorID": "CAST(VendorID AS bigint)", "passenger_count": "CAST(passenger_count AS bigint)"}
    features.with_columns(trips.where(older).drop("cbd_congestion_fee"), narrow).write.parquet(path)
    trips.where(~older).write.mode("append").parquet(path)
    return portable(parquet.read_trip_files(spark, path))


@query("s_csv_all_string")
def s_csv_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_staging_csv(spark, written_csv(spark, sf_dir))


@query("s_csv_typed")
def s_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.guarded(delimited.read_typed_csv(spark, binding.lines_path(spark, sf_dir)))


@query("s_line_parse")
def s_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID"]
    names += ["payment_type", "fare_amount", "pickup_hour", "is_weekend"]
    return fields(spark, sf_dir).select(*names)


@query("s_quality_counts")
def s_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.quality_counts(fields(spark, sf_dir))


@query("s_ctas_orc")
def s_ctas_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    tables.write_orc(tables.typed_trips(delimited.read_staging_csv(spark, written_csv(spark, sf_dir))), path)
    return tables.read_orc(spark, path)


@query("s_csv_sink")
def s_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips written as CSV and read back as text."""
    clean = cleaning.clean_trips(binding.raw_trips(spark, sf_dir), max_total=MAX_TOTAL)
    path = scratch_path(spark, "clean")
    tables.write_csv(portable(clean), path)
    return delimited.read_staging_csv(spark, path)


@query("s_result_files")
def s_result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files with a header, one set per report, all read back."""
    trips = binding.stored_clean(spark, sf_dir)
    results = {"q08_hourly": reports.hourly(trips), "q09_weekend": reports.weekend(trips)}
    paths = tables.write_results(results, scratch_path(spark, "results"))
    hourly, weekend = (
        spark.read.schema(frame.schema).option("header", True).csv(paths[name]).withColumn("report", F.lit(name))
        for name, frame in results.items()
    )
    return hourly.unionByName(weekend, allowMissingColumns=True)


def _sampled(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    key = ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "payment_type"]
    path = scratch_path(spark, "sample")
    tables.write_csv(portable(sampling.sample_rows(binding.stored_clean(spark, sf_dir), key, n)), path)
    return delimited.read_staging_csv(spark, path)


@query("s_sample_n")
def s_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of the cleaned trips, written as CSV and read back."""
    return _sampled(spark, sf_dir, sampling.SAMPLE_SIZE)


@query("s_sample_fewer")
def s_sample_fewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of fewer rows than the small test tables have."""
    return _sampled(spark, sf_dir, 5_000)


@query("s_roundtrip_check")
def s_roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = binding.text_trips(spark, sf_dir)
    path = scratch_path(spark, "csv")
    tables.write_csv(text, path)
    return tables.round_trip_check(text, delimited.read_staging_csv(spark, path))


@query("s_data_dictionary")
def s_data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.data_dictionary(binding.trips(spark, sf_dir))


@query("s_tsv_rows")
def s_tsv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.tsv_rows(m2(spark, sf_dir), jobs.HOUR_PERCENTS)


@query("s_tsv_read")
def s_tsv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = m3(spark, sf_dir)
    path = scratch_path(spark, "tsv")
    tables.write_tsv(job, path, jobs.TIP_PERCENTS)
    return tables.read_tsv(spark, path, job.schema, jobs.TIP_PERCENTS)


@query("s_null_profile")
def s_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.null_profile(binding.trips(spark, sf_dir))


@query("s_describe")
def s_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = profiling.describe(binding.trips(spark, sf_dir))
    exact = ["mean", "std", *profiling.QUARTILES]
    return features.with_columns(told, {name: f"round({name}, 4)" for name in exact})


@query("s_title_row")
def s_title_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.total_trips(binding.trips(spark, sf_dir))
    return tables.titled(report, reports.TITLES["q01_total_trips"])


# --- cleaning ------------------------------------------------------------


def _rule(name: str, keep: str, **rewrites: str) -> None:
    """One rule alone: the raw rows it keeps, with the columns it rewrites."""

    @query(name)
    def rule(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = binding.raw_trips(spark, sf_dir).where(keep)
        return portable(features.with_columns(kept, rewrites) if rewrites else kept)


@query("c01_dedupe")
def c01_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cleaning.drop_copies(binding.raw_trips(spark, sf_dir)))


@query("c02_timestamps")
def c02_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times arrive as text; the longest trips have an impossible month."""
    pickup = "tpep_pickup_datetime"
    text = times.time_text(pickup)
    broken = f"CASE WHEN trip_distance > 115 THEN regexp_replace({text}, '-[0-9]+-', '-13-') ELSE {text} END"
    raw = features.with_columns(binding.raw_trips(spark, sf_dir), {pickup: broken})
    kept = raw.where(cleaning.valid_times())
    return portable(features.with_columns(kept, {pickup: times.to_time(pickup)}))


_rule("c03_duration", cleaning.valid_duration(), trip_duration_min=trip_exprs.raw_duration())
_rule("c04_passengers", cleaning.valid_passengers(), passenger_count=numbers.truncated_int("passenger_count"))
_rule("c05_distance", cleaning.valid_distance())
_rule("c06_vendor", cleaning.valid_vendor())
_rule("c07_ratecode", cleaning.valid_rate_code("RatecodeID"))
_rule("c08_flag", cleaning.valid_flag(), store_and_fwd_flag=trip_exprs.flag_letter("store_and_fwd_flag"))
_rule("c10_money", cleaning.valid_money(max_total=MAX_TOTAL))
_rule("c11_speed", cleaning.valid_speed())


@query("c09a_bbox")
def c09a_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(binding.located_trips(spark, sf_dir).where(cleaning.valid_coordinates()))


@query("c09b_zones")
def c09b_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of payment type 7 have no drop-off zone here."""
    missing = {"DOLocationID": "CASE WHEN payment_type <> 7 THEN DOLocationID END"}
    raw = features.with_columns(binding.raw_trips(spark, sf_dir), missing)
    return portable(raw.where(cleaning.valid_zones()))


@query("c12_report")
def c12_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.removal_report(binding.raw_trips(spark, sf_dir), apply_ratecode_rule=True, max_total=MAX_TOTAL)


@query("c13_clean_trips")
def c13_clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cleaning.clean_trips(binding.raw_trips(spark, sf_dir), max_total=MAX_TOTAL))


@query("c14_guards")
def c14_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines in a staging file are left out by the typed table."""
    staging = spark.read.schema(delimited.staging_schema()).csv(binding.lines_path(spark, sf_dir))
    return tables.typed_trips(staging).agg(F.count("*").alias("rows"), F.count("VendorID").alias("vendors"))


# --- features ------------------------------------------------------------


@query("p_time_features")
def p_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = features.with_time_features(binding.trips(spark, sf_dir))
    ends = ("tpep_pickup_datetime", "PULocationID", "DOLocationID")
    return portable(trips.select(*ends, *features.time_features()))


@query("p_trip_metrics")
def p_trip_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ("trip_distance", "trip_duration_min", "avg_speed_mph", "fare_per_mile")
    return binding.featured_trips(spark, sf_dir).select("PULocationID", "DOLocationID", *metrics)


@query("p_row_key")
def p_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = "tpep_pickup_datetime"
    key = trip_exprs.row_key("VendorID", pickup, "PULocationID")
    return binding.trips(spark, sf_dir).selectExpr(f"{times.compact_time(pickup)} AS compact", f"{key} AS row_key")


@query("p_hour_key")
def p_hour_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = trip_exprs.hour_key("pickup_hour")
    return fields(spark, sf_dir).selectExpr("pickup_hour AS hour_text", f"{key} AS hour_key")


@query("p_fare_bucket")
def p_fare_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.trips(spark, sf_dir).selectExpr(
        "fare_amount",
        f"{trip_exprs.fare_bucket('fare_amount')} AS bucket",
        f"{trip_exprs.tip_key('payment_type', 'fare_amount')} AS tip_key",
    )


@query("p_lenient_double")
def p_lenient_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infinite and unreadable spellings in the fares of the longest trips."""
    junk = """CASE payment_type WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity' WHEN 3 THEN ' NaN '
      WHEN 4 THEN 'inf' ELSE '1.5x' END"""
    fare = f"CASE WHEN trip_distance > 110 THEN {junk} ELSE CAST(fare_amount AS string) END"
    trips = features.with_columns(binding.text_trips(spark, sf_dir), {"fare_text": fare})
    parsed = f"{numbers.lenient_double('fare_text')} AS fare"
    return trips.selectExpr("PULocationID", "DOLocationID", "payment_type", parsed)


@query("p_labels")
def p_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "vendor": labels.vendor_label("VendorID"),
        "payment_method": labels.payment_label("payment_type"),
        "rate_code_description": labels.rate_code_label("RatecodeID"),
        "day_type": labels.day_type("is_weekend"),
        "time_period": labels.time_period("pickup_hour"),
    }
    trips = binding.featured_trips(spark, sf_dir)
    labelled = trips.selectExpr(*[f"{sql} AS {name}" for name, sql in names.items()])
    return labelled.groupBy(*names).agg(F.count("*").alias("trips"))


# --- reports -------------------------------------------------------------

_REPORT_OPTIONS = {"q11_high_volume": {"min_trips": MIN_TRIPS}}


def _report(name: str) -> None:
    @query(name)
    def report(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = binding.stored_clean(spark, sf_dir)
        return portable(reports.REPORTS[name](trips, **_REPORT_OPTIONS.get(name, {})))


for _name in reports.REPORTS:
    _report(_name)


# --- jobs ----------------------------------------------------------------


@query("m1_zone_performance")
def m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.zone_performance(jobs.zone_records(fields(spark, sf_dir)))


@query("m2_hourly_performance")
def m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.hourly_performance(jobs.hour_records(fields(spark, sf_dir)))


@query("m3_tip_behavior")
def m3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.tip_behavior(jobs.tip_records(fields(spark, sf_dir)))


@query("m1_clean_zone_performance")
def clean_zone_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw trips to the zone report: clean, derive, aggregate."""
    clean = cleaning.clean_trips(binding.raw_trips(spark, sf_dir), max_total=MAX_TOTAL)
    return jobs.zone_performance(jobs.zone_records_of(clean))


# --- keyed wide table ----------------------------------------------------


def _keyed(name: str) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    def register(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        @query(name)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(binding.stored_wide(spark, sf_dir))

        return fn

    return register


def _last_key(table: DataFrame) -> Column:
    return table.agg(F.max(keyed.KEY)).scalar()


def _edge_keys(table: DataFrame) -> DataFrame:
    """First and last key of every vendor, and one absent key each."""
    ends = table.groupBy(F.substring(keyed.KEY, 1, 1).alias("vendor")).agg(
        F.min(keyed.KEY).alias("low"), F.max(keyed.KEY).alias("high")
    )
    three = F.array("low", "high", F.concat("high", F.lit("_absent")))
    return ends.select(F.explode(three).alias(keyed.KEY))


@query("k_wide_rows")
def k_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.flatten(keyed.ingest(binding.trips(spark, sf_dir), derive=features.with_features))


@query("k_upsert_latest")
def k_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = binding.table(spark, sf_dir, "events")
    key = {"event_type": F.col("event_type"), "hour": F.hour("ts"), "user_bucket": F.col("user_id") % 10}
    puts = events.select(*[c.alias(n) for n, c in key.items()], "event_id", "value")
    return keyed.latest_per_key(puts, list(key), ["event_id"])


@_keyed("k_put_rows")
def k_put_rows(table: DataFrame) -> DataFrame:
    """Card trips are put twice, with a zero tip last, and long ones under a new key too."""
    card = table.where(keyed.cell_filter("trip_info.payment_type", "=", 1))
    twice = card.withColumn("put", F.explode(F.array(F.lit(1), F.lit(2))))
    tip = F.when(F.col("put") == 1, 9.0).otherwise(0.0)
    puts = twice.withColumn("financials", F.col("financials").withField("tip_amount", tip))
    far = puts.where((F.col("put") == 2) & keyed.cell_filter("trip_info.trip_distance", ">", 100))
    fresh = far.withColumn(keyed.KEY, F.concat(F.lit("9_"), keyed.KEY))
    changes = puts.unionByName(fresh)
    return keyed.project(keyed.put_rows(table, changes, ["put"]), ["financials"])


@_keyed("k_merge_cells")
def k_merge_cells(table: DataFrame) -> DataFrame:
    """Two changes for each long trip: the last tip and status stay, also where the last change leaves them out."""
    far = table.where(keyed.cell_filter("trip_info.trip_distance", ">", 100))

    def cells(key: Column, status: str) -> DataFrame:
        tips = F.struct(F.col("tip").alias("tip_amount"), F.lit(None).cast("double").alias("fare_amount"))
        state = F.struct(F.when(F.col("put") == 1, F.lit(status)).alias("status"))
        puts = far.withColumn("put", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("tip", F.when(F.col("put") == 1, 9.0).otherwise(0.0))
        return puts.select(key.alias(keyed.KEY), "put", tips.alias("financials"), state.alias("audit"))

    changes = cells(F.col(keyed.KEY), "verified").unionByName(cells(F.concat(F.lit("9_"), keyed.KEY), "new"))
    merged = keyed.merge_cells(table, changes, ["put"])
    return keyed.project(merged, ["financials", "audit", "metrics.avg_speed_mph"])


@_keyed("k_get_row")
def k_get_row(table: DataFrame) -> DataFrame:
    return keyed.get_row(table, _last_key(table))


@_keyed("k_get_cell")
def k_get_cell(table: DataFrame) -> DataFrame:
    return keyed.get_row(table, _last_key(table), ["financials", "metrics.is_weekend"])


@_keyed("k_multi_get")
def k_multi_get(table: DataFrame) -> DataFrame:
    return keyed.get_rows(table, _edge_keys(table), ["trip_info.trip_distance", "financials.total_amount"])


@_keyed("k_delete_rows")
def k_delete_rows(table: DataFrame) -> DataFrame:
    return keyed.project(keyed.delete_rows(table, _edge_keys(table)), ["financials.total_amount"])


@query("k_change_stored")
def k_change_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In place: edge keys go, then far card trips are put, without a tip, and under a new key too."""

    def change(table: DataFrame, path: str) -> None:
        far = keyed.cell_filter("trip_info.payment_type", "=", 1) & keyed.cell_filter("trip_info.trip_distance", ">", 100)
        puts = keyed.put_cells(table.where(far), F.lit(True), "financials", {"tip_amount": 0.0})
        fresh = puts.withColumn(keyed.KEY, F.concat(F.lit("9_"), keyed.KEY))
        keyed.change_stored(spark, path, deletes=_edge_keys(table), puts=puts.unionByName(fresh), sequence=[keyed.KEY])

    return keyed.project(keyed.read_wide(spark, binding.changed_wide_path(spark, sf_dir, change)), ["financials"])


@_keyed("k_delete_cell")
def k_delete_cell(table: DataFrame) -> DataFrame:
    dispute = keyed.cell_filter("trip_info.payment_type", "=", 4)
    return keyed.project(keyed.delete_cell(table, "financials.tip_amount", dispute), ["financials"])


@_keyed("k_delete_audit")
def k_delete_audit(table: DataFrame) -> DataFrame:
    keys = _edge_keys(table)
    return keyed.delete_audit(table, keyed.delete_rows(table, keys), keys)


@query("k_scan_limit")
def k_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.scan(keyed.read_first(spark, binding.wide_path(spark, sf_dir), 3), limit=3)


@query("k_scan_reverse")
def k_scan_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.scan(keyed.read_first(spark, binding.wide_path(spark, sf_dir), 3, reverse=True), reverse=True, limit=3)


@_keyed("k_range_scan")
def k_range_scan(table: DataFrame) -> DataFrame:
    return keyed.scan(table, start="1_199601", stop="2_199601")


@_keyed("k_prefix_scan")
def k_prefix_scan(table: DataFrame) -> DataFrame:
    return keyed.scan(table, prefix="1_")


@query("k_prefix_page")
def k_prefix_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = keyed.read_first(spark, binding.wide_path(spark, sf_dir), 4, prefix="2_")
    return keyed.scan(first, prefix="2_", limit=4)


@query("k_page_summary")
def k_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = keyed.read_first(spark, binding.wide_path(spark, sf_dir), keyed_reports.PAGE_ROWS)
    return keyed_reports.page_summary(first)


@_keyed("k_value_filter")
def k_value_filter(table: DataFrame) -> DataFrame:
    return keyed.scan(table, where=keyed.cell_filter(keyed_reports.SPEED, ">", 12.0), columns=["metrics"])


@_keyed("k_value_filter_bytes")
def k_value_filter_bytes(table: DataFrame) -> DataFrame:
    where = keyed.cell_filter(keyed_reports.SPEED, ">", 12.0, compare="bytes")
    return keyed.scan(table, where=where, columns=["metrics"])


@_keyed("k_value_regex")
def k_value_regex(table: DataFrame) -> DataFrame:
    where = keyed.cell_matches("trip_info.passenger_count", "^[1-2]$")
    return keyed.scan(table, where=where, columns=["trip_info", "metrics"])


@_keyed("k_key_regex_and_value")
def k_key_regex_and_value(table: DataFrame) -> DataFrame:
    where = keyed.cell_filter("financials.fare_amount", ">=", 25.0)
    return keyed.scan(table, pattern="^2_1997.*", where=where, columns=["trip_info.trip_distance", "financials.fare_amount", "financials.total_amount"])


@_keyed("k_zero_tip_high_total")
def k_zero_tip_high_total(table: DataFrame) -> DataFrame:
    where = keyed.cell_filter("financials.tip_amount", "=", 0.0) & keyed.cell_filter("financials.total_amount", ">=", 15.0)
    return keyed.scan(table, where=where, reverse=True, limit=5)


@_keyed("k_column_prefix")
def k_column_prefix(table: DataFrame) -> DataFrame:
    return keyed.project_prefix(table.where(keyed.cell_filter(keyed_reports.SPEED, ">", 15.0)), "fare")


@_keyed("k_project_columns")
def k_project_columns(table: DataFrame) -> DataFrame:
    return keyed.project(table, ["trip_info.passenger_count", "trip_info.trip_distance", "financials.total_amount"])


@_keyed("k_count")
def k_count(table: DataFrame) -> DataFrame:
    return keyed.count_rows(table)


@_keyed("k_schema_evolution")
def k_schema_evolution(table: DataFrame) -> DataFrame:
    """A new group is added, filled for one row, read, and dropped again."""
    wider = keyed.add_family(table, "audit", {"status": "string", "reviewed_by": "string"})
    last = F.col(keyed.KEY) == _last_key(table)
    filled = keyed.put_cells(wider, last, "audit", {"status": "verified", "reviewed_by": "desk1"})
    audit = keyed.project(filled.where(F.col("audit.status").isNotNull()), ["audit"])
    after = keyed.drop_family(filled, "audit")
    return audit.select(
        "*",
        F.lit(len(keyed.families(filled))).alias("groups_with"),
        F.lit(len(keyed.families(after))).alias("groups_after"),
        after.agg(F.count("*")).scalar().alias("rows_after"),
    )


_REPORTS = {
    "k_vendor_report": keyed_reports.vendor_report,
    "k_high_revenue": keyed_reports.high_revenue,
    "k_high_revenue_rows": keyed_reports.high_revenue_rows,
    "k_card_revenue": keyed_reports.card_revenue,
    "k_fast_trips": keyed_reports.fast_trips,
    "k_vendor_audit": keyed_reports.vendor_audit,
    "k_dashboard": keyed_reports.dashboard,
}
for _name, _fn in _REPORTS.items():
    _keyed(_name)(_fn)


@_keyed("k_fast_trips_bytes")
def k_fast_trips_bytes(table: DataFrame) -> DataFrame:
    return keyed_reports.fast_trips(table, compare="bytes")


@_keyed("k_speed_outliers")
def k_speed_outliers(table: DataFrame) -> DataFrame:
    return keyed_reports.speed_outliers(table, _edge_keys(table))


@_keyed("k_zero_fare_cleanup")
def k_zero_fare_cleanup(table: DataFrame) -> DataFrame:
    """No total is zero in the test tables, so those of the longest trips are set to zero first."""
    far = keyed.cell_filter("trip_info.trip_distance", ">", 100)
    zeroed = keyed.put_cells(table, far, "financials", {"total_amount": 0.0})
    return keyed.project(keyed_reports.zero_fare_cleanup(zeroed), ["financials"])


# --- series --------------------------------------------------------------


@query("v1_hourly_series")
def v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.hourly_series(m2(spark, sf_dir))


@query("v2_top10_zones")
def v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.busiest_zones(m1(spark, sf_dir))


@query("v3_payment_share")
def v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.payment_share(reports.payment(binding.stored_clean(spark, sf_dir)))


@query("v4_weekend_series")
def v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.weekend_series(reports.weekend(binding.stored_clean(spark, sf_dir)))


@query("v5_month_series")
def v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.monthly(binding.stored_clean(spark, sf_dir))
    return series.month_series(report, SERIES_YEAR, SERIES_MONTHS)


@query("v6_speed_fare")
def v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.speed_and_fare(m1(spark, sf_dir))


@query("v7_tip_by_bucket")
def v7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.tip_by_bucket(m3(spark, sf_dir))


@query("v8_ratecode_yield")
def v8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rate_code_yield(reports.rate_code(binding.stored_clean(spark, sf_dir)))
