"""Reports over a keyed wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.operators.keyed import (
    KEY,
    cell_filter,
    chosen,
    delete_where,
    get_rows,
    key_prefix,
    project,
    scan,
    with_prefix,
)

# Thresholds and sizes of the reports.
HIGH_REVENUE = 40.0
FAST_MPH = 12.0
CARD_PAYMENT = 1
AUDIT_PREFIX = "2_"
PAGE_ROWS = 5
VENDOR_CODES = ("1", "2")

TOTAL = "financials.total_amount"
TIP = "financials.tip_amount"
DISTANCE = "trip_info.trip_distance"
SPEED = "metrics.avg_speed_mph"
PAYMENT = "trip_info.payment_type"


def _number(path: str) -> Column:
    """A missing cell counts as zero."""
    return F.coalesce(F.col(path).try_cast("double"), F.lit(0.0))


def _amount(value: Column) -> Column:
    """As `numbers.amount`: decimals, whose sums do not depend on their order."""
    return value.try_cast("decimal(28, 12)")


def _rounded(value: Column, digits: int = 2) -> Column:
    return F.round(value, digits).cast("double")


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(_amount(value)), F.lit(0).cast("decimal(38, 12)"))


def _over(total: Column, rows: Column) -> Column:
    """Zero when there are no rows."""
    return F.coalesce(F.try_divide(total, rows), F.lit(0))


def _sum(value: Column) -> Column:
    return _rounded(_total(value))


def _mean(value: Column, rows: Column) -> Column:
    return _rounded(_over(_total(value), rows))


def vendor_report(table: DataFrame, vendors: Sequence[str] = VENDOR_CODES) -> DataFrame:
    """Trips, revenue, miles and mean revenue per vendor, plus a total row.

    One global aggregate with a column set per vendor: vendors without trips
    show up with zeros. `best` marks the vendor with the highest revenue; on a
    tie the later one wins. The total row has trips and revenue only.
    """
    # One character names the vendor, so ten and up read as their first digit.
    vendor = F.substring(KEY, 1, 1)
    total, miles = _number(TOTAL), _number(DISTANCE)
    measures = []
    for v in vendors:
        mine = vendor == v
        measures += [
            F.count_if(mine).alias(f"trips_{v}"),
            _total(F.when(mine, total)).alias(f"revenue_{v}"),
            _total(F.when(mine, miles)).alias(f"miles_{v}"),
        ]
    revenues = [F.col(f"revenue_{v}") for v in vendors]
    highest = F.greatest(*revenues, revenues[0])
    best = F.coalesce(*[F.when(F.col(f"revenue_{v}") == highest, F.lit(v)) for v in reversed(vendors)])

    def line(name: str, trips: Column, revenue: Column, miles: Column, mean: Column, top: Column) -> Column:
        return F.struct(
            F.lit(name).alias("vendor"),
            trips.alias("trips"),
            _rounded(revenue).alias("total_revenue"),
            _rounded(miles).alias("total_distance"),
            _rounded(mean).alias("avg_revenue_per_trip"),
            top.alias("best"),
        )

    none = F.lit(None).cast("double")
    lines = [
        line(
            v,
            F.col(f"trips_{v}"),
            F.col(f"revenue_{v}"),
            F.col(f"miles_{v}"),
            _over(F.col(f"revenue_{v}"), F.col(f"trips_{v}")),
            best == v,
        )
        for v in vendors
    ]
    all_trips = sum((F.col(f"trips_{v}") for v in vendors), start=F.lit(0))
    all_revenue = sum(revenues, start=F.lit(0).cast("decimal(38, 12)"))
    lines.append(line("TOTAL", all_trips, all_revenue, none, none, F.lit(None).cast("boolean")))
    return table.agg(*measures).select(F.inline(F.array(*lines)))


def high_revenue_rows(table: DataFrame, threshold: float = HIGH_REVENUE, compare: str = "numeric") -> DataFrame:
    return scan(
        table,
        where=cell_filter(TOTAL, ">", threshold, compare),
        columns=[DISTANCE, "financials.fare_amount", TIP, TOTAL, SPEED, "timing.pickup_datetime"],
    )


def high_revenue(table: DataFrame, threshold: float = HIGH_REVENUE, compare: str = "numeric") -> DataFrame:
    """Count, revenue and percent of all rows above the threshold, in one pass."""
    hit = F.coalesce(cell_filter(TOTAL, ">", threshold, compare), F.lit(False))
    share = F.try_divide(F.count_if(hit) * 100.0, F.count("*"))
    return table.agg(
        F.count_if(hit).alias("trips"),
        _sum(F.when(hit, _number(TOTAL))).alias("combined_revenue"),
        F.round(share, 1).alias("pct_of_trips"),
    )


def card_revenue(table: DataFrame, payment: int = CARD_PAYMENT) -> DataFrame:
    return table.where(cell_filter(PAYMENT, "=", payment)).agg(
        F.count("*").alias("card_trips"),
        _sum(_number(TOTAL)).alias("card_revenue"),
        _sum(_number(TIP)).alias("card_tips"),
        _mean(_number(TIP), F.count("*")).alias("avg_tip"),
    )


def fast_trips(table: DataFrame, mph: float = FAST_MPH, compare: str = "numeric") -> DataFrame:
    return table.where(cell_filter(SPEED, ">", mph, compare)).agg(
        F.count("*").alias("fast_trips"),
        _mean(_number(DISTANCE), F.count("*")).alias("avg_distance"),
    )


def vendor_audit(table: DataFrame, prefix: str = AUDIT_PREFIX) -> DataFrame:
    return with_prefix(table, prefix).agg(
        F.count("*").alias("trips"),
        _mean(_number(DISTANCE), F.count("*")).alias("avg_distance"),
        _sum(_number(TOTAL)).alias("total_revenue"),
    )


def page_rows(table: DataFrame, n: int = PAGE_ROWS) -> DataFrame:
    """The first rows in key order."""
    return scan(table, columns=["timing.pickup_datetime", DISTANCE, TOTAL], limit=n)


def page_summary(table: DataFrame, n: int = PAGE_ROWS) -> DataFrame:
    return page_rows(table, n).agg(
        F.count("*").alias("page_rows"),
        _sum(F.coalesce("total_amount", F.lit(0.0))).alias("page_revenue"),
    )


def dashboard(table: DataFrame, compare: str = "numeric") -> DataFrame:
    """One line per report: card revenue, fast trips, vendor audit, first page.

    The three filtered reports share a single pass over the table.
    """
    no = F.lit(False)
    card = F.coalesce(cell_filter(PAYMENT, "=", CARD_PAYMENT), no)
    fast = F.coalesce(cell_filter(SPEED, ">", FAST_MPH, compare), no)
    audit = key_prefix(AUDIT_PREFIX)
    total, miles = _number(TOTAL), _number(DISTANCE)
    shared = table.agg(
        F.count_if(card).alias("card_n"),
        _sum(F.when(card, total)).alias("card_value"),
        F.count_if(fast).alias("fast_n"),
        _mean(F.when(fast, miles), F.count_if(fast)).alias("fast_value"),
        F.count_if(audit).alias("audit_n"),
        _mean(F.when(audit, miles), F.count_if(audit)).alias("audit_value"),
    )

    def line(number: int, name: str, trips: str, measure: str, value: str) -> Column:
        return F.struct(
            F.lit(number).alias("line"),
            F.lit(name).alias("report"),
            F.col(trips).alias("trips"),
            F.lit(measure).alias("measure"),
            F.col(value).alias("value"),
        )

    lines = shared.select(
        F.inline(
            F.array(
                line(1, "card revenue", "card_n", "revenue", "card_value"),
                line(2, "fast trips", "fast_n", "avg_distance", "fast_value"),
                line(3, "vendor audit", "audit_n", "avg_distance", "audit_value"),
            )
        )
    )
    page = page_summary(table).select(
        F.inline(F.array(line(4, "first page", "page_rows", "revenue", "page_revenue")))
    )
    return lines.unionByName(page)


def speed_outliers(table: DataFrame, keys: Sequence[str] | DataFrame) -> DataFrame:
    """Audit of chosen rows against half of their mean speed.

    `flag` is OUTLIER below the threshold, OK otherwise, and empty for rows
    without a positive speed and for keys that were not found.
    """
    cells = [DISTANCE, TOTAL, SPEED, "timing.trip_duration_min"]
    # The means come from the hits alone, before the outer join to the asked keys.
    found = project(chosen(table, keys), cells)
    speed = F.coalesce("avg_speed_mph", F.lit(0.0))
    total = F.coalesce("total_amount", F.lit(0.0))
    rows = F.count("*")
    mean = found.agg(
        F.struct(
            F.try_divide(_total(speed), rows).alias("speed"),
            F.try_divide(_total(total), rows).alias("total"),
        )
    ).scalar()
    threshold = F.try_divide(mean["speed"], F.lit(2))
    flag = F.when((speed > 0) & (speed < threshold.cast("double")), F.lit("OUTLIER")).when(speed > 0, F.lit("OK"))
    return get_rows(table, keys, cells).select(
        "*",
        _rounded(mean["speed"]).alias("mean_speed"),
        _rounded(mean["total"]).alias("mean_total"),
        _rounded(threshold).alias("threshold"),
        flag.alias("flag"),
    )


def zero_fare_cleanup(table: DataFrame, cell: str = TOTAL) -> DataFrame:
    """The table without the rows whose amount is zero."""
    return delete_where(table, cell_filter(cell, "=", 0.0))
