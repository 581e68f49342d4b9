"""Exactness under skew, and the shape of the physical plans."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hackney.operators import keyed, profiling, reports, sampling
from hackney.plans import binding, catalog


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_stay_in_the_engine(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_hot_key_keeps_one_row_per_task_before_the_shuffle(spark):
    rows = spark.range(0, 90_000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', CAST(id % 500 AS string)) AS k", "id AS seq")
    latest = keyed.latest_per_key(rows, ["k"], ["seq"])
    text = plan(latest)
    assert text.index("Partial") > text.index("Exchange")
    expected = rows.groupBy("k").agg(F.max("seq").alias("seq"))
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [5.0] * 1000 + [1.0, 9.0],
        [-1e9, -0.5, -0.25, 0.0, 0.25, 1e12],
        list(np.random.default_rng(1).normal(0, 50, 5001)),
        list(np.round(np.random.default_rng(2).exponential(10, 4000), 2)),
        [0.0] * 40 + list(np.random.default_rng(3).uniform(-1, 1, 61)),
    ],
)
def test_quantiles_are_exact(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    row = profiling.quantiles(frame, {"x": F.col("x")}).first()
    expected = np.quantile(np.array(values), [0.25, 0.5, 0.75])
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(expected), rel=1e-12, abs=1e-12)


def test_quantiles_are_narrowed(spark, monkeypatch):
    """Ranges far narrower than their distance from zero, values that a third of all rows have, ranks between two heavy values."""
    monkeypatch.setattr(profiling, "FEW", 50)
    monkeypatch.setattr(profiling, "SAMPLED", 300)
    draw = np.random.default_rng(5)
    day = 1.7e15 + draw.integers(0, 86_400_000_000, 6000)
    heavy = np.where(draw.random(6000) < 0.34, 7.5, np.where(draw.random(6000) < 0.5, -3.25, np.round(draw.normal(0, 9, 6000), 1)))
    halves = np.where(np.arange(6000) < 3000, 1.0, 2.0)
    holes = np.where(draw.random(6000) < 0.97, np.nan, day)
    table = np.stack([day, heavy, halves, holes], axis=1)
    frame = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in row) for row in table], "a double, b double, c double, d double").repartition(5)
    found = profiling.quantiles(frame, {c: F.col(c) for c in frame.columns}).collect()
    for row, column in zip(found, table.T, strict=True):
        assert list(row)[1:] == pytest.approx(list(np.nanquantile(column, [0.25, 0.5, 0.75])), rel=1e-15)


def test_quantiles_of_nothing(spark):
    frame = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert [tuple(r) for r in profiling.quantiles(frame, {"x": F.col("x"), "y": F.col("y")}).collect()] == [("y", 1.0, 1.0, 1.0)]
    assert profiling.quantiles(frame.limit(0), {"x": F.col("x")}).collect() == []


def test_describe_skips_missing_values(spark):
    frame = spark.sql("SELECT * FROM VALUES (1D, 'a'), (NULL, 'b'), (3D, 'b'), (double('NaN'), NULL) AS t(x, s)")
    rows = {r["column_name"]: r for r in profiling.describe(frame).collect()}
    assert (rows["x"]["count"], rows["x"]["mean"], rows["x"]["p50"]) == (2, 2.0, 2.0)
    assert (rows["s"]["count"], rows["s"]["unique"], rows["s"]["top"], rows["s"]["freq"]) == (3, 2, "b", 2)


@pytest.mark.parametrize("n", [0, 1, 777, 5000, 20_000])
def test_sample_is_the_n_smallest_hashes(spark, n):
    frame = spark.range(5000).selectExpr("id", "id % 7 AS t")
    sample = sampling.sample_rows(frame, ["id"], n=n, order_by="t")
    ranked = frame.withColumn("r", sampling.sample_rank(["id"])).orderBy("r").limit(n)
    assert sorted(r["id"] for r in sample.collect()) == sorted(r["id"] for r in ranked.collect())
    assert [r["id"] for r in sample.collect()] == [r["id"] for r in sample.collect()]


def test_sample_orders_one_small_slice_only(spark):
    """A key that a third of all rows have falls into one slice; the cut inside it is exact, and no top-n of n rows is planned."""
    frame = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS string)) AS k", "id AS t")
    for n in (100, 9_000, 25_000):
        sample = sampling.sample_rows(frame, ["k"], n=n, order_by="t")
        ranked = frame.withColumn("r", sampling.sample_rank(["k"])).orderBy("r").limit(n)
        assert sorted(r["k"] for r in sample.collect()) == sorted(r["k"] for r in ranked.collect())
        hashed = frame.where("k <> 'hot'")
        assert f"limit={n}," not in plan(sampling.sample_rows(hashed, ["k"], n=n, order_by="t"))


@pytest.mark.parametrize("name", ["m1_zone_performance", "m2_hourly_performance", "m3_tip_behavior", "s_line_parse", "v2_top10_zones"])
def test_a_line_is_split_once(spark, sf_dir, name):
    text = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1


def test_finite_values_of_any_size_stay_in_sums(spark):
    from hackney.functions import numbers

    frame = spark.sql("SELECT * FROM VALUES (1e16D, 1), (5D, 1), (NULL, 1), (double('NaN'), 1), (double('Infinity'), 1), (0.125D, 2), (NULL, 3), (-2e300D, 4) AS t(x, k)")
    found = frame.groupBy("k").agg(*[F.expr(f("x")).alias(f.__name__) for f in (numbers.total, numbers.mean, numbers.whole_sum)])
    told = {r["k"]: tuple(r)[1:] for r in found.collect()}
    assert told == {1: (1e16 + 5, (1e16 + 5) / 2, 1e16 + 5), 2: (0.13, 0.13, 0.125), 3: (None, None, None), 4: (-2e300,) * 3}


def test_reports_read_only_their_columns_and_aggregate_before_the_shuffle(spark, sf_dir):
    text = plan(reports.top_zones_by_volume(binding.featured_trips(spark, sf_dir)))
    assert "ReadSchema: struct<l_suppkey:bigint>" in text
    assert text.index("partial_count") > text.index("Exchange")
    assert "TakeOrderedAndProject" in text


def test_stored_keys_prune_folders_and_row_groups(spark, sf_dir):
    table = binding.stored_wide(spark, sf_dir)
    text = plan(keyed.scan(table, prefix="2_", limit=4))
    assert "StringStartsWith(row_key,2_)" in text
    assert "key_vendor" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    text = plan(keyed.scan(table, where=keyed.cell_filter("metrics.avg_speed_mph", ">", 15.0), columns=["metrics"]))
    assert "GreaterThan(metrics.avg_speed_mph,15.0)" in text
    assert "financials" not in text


def test_cleaning_filters_before_it_shuffles(spark, sf_dir):
    from hackney.operators import cleaning

    text = plan(cleaning.clean_trips(binding.raw_trips(spark, sf_dir)))
    assert text.rindex("Filter") > text.index("Exchange")


def test_invariants(spark, sf_dir):
    queries = entry.queries()

    def total(name, column):
        return queries[name](spark, sf_dir).agg(F.sum(column)).first()[0]

    everything = queries["q01_total_trips"](spark, sf_dir).first()[0]
    for name in ("q08_hourly", "q09_weekend", "q10_payment", "q12_monthly", "q13_ratecode", "q14_peak"):
        assert total(name, "trip_count") == everything
    assert total("v3_payment_share", "share_pct") == pytest.approx(100, abs=0.5)
    report = {r["cleaning_step"]: r for r in queries["c12_report"](spark, sf_dir).collect()}
    assert report["TOTAL"]["rows_removed"] == sum(r["rows_removed"] for s, r in report.items() if s != "TOTAL")


def test_cleaning_funnel(spark, sf_dir):
    rows = entry.queries()["c12_report"](spark, sf_dir).orderBy("step").collect()
    left = [r["rows_remaining"] for r in rows]
    assert rows[0]["rows_removed"] + left[0] == 6057
    assert left == [6000, 6000, 5378, 4106, 3691, 3569, 3024, 3024, 3024, 2533, 2179, 2179]


def test_latest_events(spark):
    latest = entry.queries()["k_upsert_latest"](spark, "/root/testdata/sf0.01")
    assert tuple(latest.agg(F.count("*"), F.sum("event_id")).first()) == (1200, 10_538_111)
