"""Keyed operators on the twelve trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hackney.operators import keyed, keyed_reports
from hackney.operators.keyed import KEY, cell_filter, scan
from tests.trips12 import trips12

TOTAL, SPEED = keyed_reports.TOTAL, keyed_reports.SPEED
ZERO = "1_20260101004035_161"


@pytest.fixture(scope="module", params=["built", "stored"])
def table(request, spark, tmp_path_factory):
    wide = keyed.ingest(trips12(spark))
    if request.param == "built":
        return wide
    path = str(tmp_path_factory.mktemp("wide") / "t")
    keyed.write_wide(wide, path)
    return keyed.read_wide(spark, path)


def one(frame):
    (row,) = frame.collect()
    return tuple(row)


def keys(frame):
    return [row[KEY] for row in frame.collect()]


def test_wide_rows_have_every_cell(table):
    assert keyed.flatten(table).count() == 12
    assert sum(len(cells) for cells in keyed.families(table).values()) == 17


def test_vendor_report(table):
    rows = [tuple(r) for r in keyed_reports.vendor_report(table).collect()]
    assert rows == [
        ("1", 4, 131.6, 23.3, 32.9, False),
        ("2", 8, 176.42, 16.26, 22.05, True),
        ("TOTAL", 12, 308.02, None, None, None),
    ]


def test_vendor_report_keeps_vendors_without_trips(table):
    none = keyed_reports.vendor_report(table.where(F.lit(False)))
    assert [tuple(r)[:3] for r in none.collect()] == [("1", 0, 0.0), ("2", 0, 0.0), ("TOTAL", 0, 0.0)]
    # A tie goes to the later vendor.
    assert [r["best"] for r in none.collect()] == [False, True, None]


def test_high_revenue(table):
    assert one(keyed_reports.high_revenue(table)) == (3, 165.06, 25.0)
    assert keyed_reports.high_revenue_rows(table).count() == 3


def test_card_revenue(table):
    assert one(keyed_reports.card_revenue(table)) == (10, 295.77, 40.28, 4.03)


@pytest.mark.parametrize(("compare", "expected"), [("numeric", (5, 4.43)), ("bytes", (10, 2.76))])
def test_fast_trips(table, compare, expected):
    assert one(keyed_reports.fast_trips(table, compare=compare)) == expected


def test_vendor_audit_and_page(table):
    assert one(keyed_reports.vendor_audit(table)) == (8, 2.03, 176.42)
    assert one(keyed_reports.page_summary(table)) == (5, 150.41)


def test_dashboard(table):
    lines = [(r["report"], r["trips"], r["value"]) for r in keyed_reports.dashboard(table).collect()]
    assert sorted(lines) == [
        ("card revenue", 10, 295.77),
        ("fast trips", 5, 4.43),
        ("first page", 5, 150.41),
        ("vendor audit", 8, 2.03),
    ]


def test_range_scan_is_half_open(table):
    found = keys(scan(table, start="1_20260101", stop="2_20260101"))
    assert len(found) == 4 and all(k.startswith("1_") for k in found)
    assert keys(scan(table, start=found[0], stop=found[-1])) == found[:-1]


@pytest.mark.parametrize(("compare", "count"), [("numeric", 1), ("bytes", 5)])
def test_key_regex_and_value(table, compare, count):
    where = cell_filter("financials.fare_amount", ">=", 25.0, compare) & keyed.key_matches("^2_20260101.*")
    found = keys(scan(table, where=where))
    assert len(found) == count and "2_20260101001931_137" in found


def test_zero_tip_reversed(table):
    where = cell_filter("financials.tip_amount", "=", 0.0) & cell_filter(TOTAL, ">=", 15.0)
    found = keys(scan(table, where=where, reverse=True, limit=5))
    assert found == ["1_20260101003854_170", "1_20260101002316_48"]


def test_regex_on_value(table):
    assert scan(table, where=keyed.cell_matches("trip_info.passenger_count", "^[1-2]$")).count() == 10


@pytest.mark.parametrize(("compare", "count"), [("numeric", 3), ("bytes", 8)])
def test_column_prefix(table, compare, count):
    fares = keyed.project_prefix(table.where(cell_filter(SPEED, ">", 15.0, compare)), "fare")
    assert fares.columns == [KEY, "fare_amount", "fare_per_mile"]
    assert fares.count() == count


def test_reverse_scan_and_prefix_page(table):
    assert keys(scan(table, reverse=True, limit=3)) == [
        "2_20260101005817_79",
        "2_20260101003629_143",
        "2_20260101003046_161",
    ]
    assert keys(scan(table, prefix="2_", limit=4)) == [
        "2_20260101000708_239",
        "2_20260101001016_249",
        "2_20260101001055_239",
        "2_20260101001931_137",
    ]


AUDIT = ["1_20260101004153_142", "2_20260101001931_137", "1_20260101002316_48"]


def test_speed_audit(table):
    rows = keyed_reports.speed_outliers(table, AUDIT).collect()
    assert {(r["mean_speed"], r["mean_total"], r["threshold"]) for r in rows} == {(14.11, 47.24, 7.05)}
    assert [r["flag"] for r in rows] == ["OK"] * 3


def test_speed_audit_flags_slow_and_absent_rows(table):
    rows = keyed_reports.speed_outliers(table, ["2_20260101003046_161", *AUDIT, *["x"]]).collect()
    assert {r[KEY]: r["flag"] for r in rows}["x"] is None
    slow = keyed.put_cells(table, F.col(KEY) == AUDIT[2], "metrics", {"avg_speed_mph": 1.0})
    flags = {r[KEY]: r["flag"] for r in keyed_reports.speed_outliers(slow, AUDIT).collect()}
    assert flags == {AUDIT[0]: "OK", AUDIT[1]: "OK", AUDIT[2]: "OUTLIER"}


def test_multi_get_reports_absent_keys(table):
    rows = keyed.get_rows(table, [ZERO, "nowhere"], [TOTAL]).collect()
    assert [tuple(r) for r in rows] == [(ZERO, 0.0, True), ("nowhere", None, False)]
    assert keyed.get_rows(table, [], [TOTAL]).count() == 0


def test_get(table):
    assert keyed.get_row(table, AUDIT[1]).count() == 1
    assert keyed.get_row(table, "nowhere").count() == 0
    assert one(keyed.get_row(table, AUDIT[0], [TOTAL])) == (AUDIT[0], 66.95)
    assert one(keyed.get_row(table, AUDIT[1], ["financials"])) == (AUDIT[1], 32.4, 9.02, 54.11, 2.5)


def test_delete_is_idempotent(table):
    once = keyed.delete_rows(table, [ZERO])
    twice = keyed.delete_rows(once, [ZERO])
    assert (once.count(), twice.count()) == (11, 11)
    assert one(keyed.delete_audit(table, once, [ZERO])) == (12, 11, 0)
    assert keyed_reports.zero_fare_cleanup(table).count() == 11
    assert keyed.delete_rows(table, []).count() == 12


def test_delete_cell_keeps_the_row(table):
    less = keyed.delete_cell(table, "financials.tip_amount", F.col(KEY) == ZERO)
    assert less.count() == 12
    assert one(keyed.get_row(less, ZERO, ["financials.tip_amount"])) == (ZERO, None)
    # A filter leaves rows without the cell out unless told otherwise.
    zero = cell_filter("financials.tip_amount", "=", 0.0)
    assert ZERO not in keys(scan(less, where=zero))
    assert ZERO in keys(scan(less, where=cell_filter("financials.tip_amount", "=", 0.0, keep_missing=True)))


def test_second_put_wins(spark):
    trips = trips12(spark).withColumn("trip", F.lit(1))
    again = trips.withColumn("total_amount", F.lit(1.0))
    table = keyed.wide_rows(trips).withColumn("seq", F.lit(1))
    table = table.unionByName(keyed.wide_rows(again).withColumn("seq", F.lit(2)))
    last = keyed.latest_per_key(table, [KEY], ["seq"])
    assert last.count() == 12
    assert last.where("financials.total_amount = 1").count() == 12


def test_put_rows_replaces_and_inserts(table):
    new = table.where(F.col(KEY) == ZERO).withColumn(KEY, F.lit("3_new"))
    changed = keyed.put_cells(table.where(F.col(KEY) == ZERO), F.lit(True), "financials", {"total_amount": 9.0})
    put = keyed.put_rows(table, changed.unionByName(new), [TOTAL])
    assert put.count() == 13
    assert one(keyed.get_row(put, ZERO, [TOTAL])) == (ZERO, 9.0)


def test_merge_cells_and_schema_evolution(spark, table):
    changes = spark.createDataFrame(
        [(ZERO, (1.5, None), ("checked",), 1), ("3_new", (2.5, None), ("new",), 1)],
        f"{KEY} string, financials struct<tip_amount double, fare_amount double>, audit struct<status string>, put int",
    )
    merged = keyed.merge_cells(table, changes, ["put"])
    rows = {r[KEY]: r for r in keyed.flatten(merged).collect()}
    assert len(rows) == 13
    assert (rows[ZERO]["tip_amount"], rows[ZERO]["fare_amount"], rows[ZERO]["status"]) == (1.5, 0.0, "checked")
    assert (rows["3_new"]["tip_amount"], rows["3_new"]["total_amount"]) == (2.5, None)
    assert rows[AUDIT[0]]["status"] is None and rows[AUDIT[0]]["tip_amount"] == 13.4
    assert "audit" not in keyed.families(keyed.drop_family(merged, "audit"))


def test_key_tables_and_lists_give_the_same_rows(spark, table):
    asked = spark.createDataFrame([(k,) for k in [*AUDIT, "nowhere"]], f"{KEY} string")
    for chosen in (asked, [*AUDIT, "nowhere"]):
        found = {r[KEY]: r["found"] for r in keyed.get_rows(table, chosen, [TOTAL]).collect()}
        assert found == {**dict.fromkeys(AUDIT, True), "nowhere": False}
        assert keyed.delete_rows(table, chosen).count() == 9
