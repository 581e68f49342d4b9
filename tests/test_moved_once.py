"""What is shuffled, sorted and written: little of each row, once, in parts that fit a task."""

from __future__ import annotations

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from hackney.operators import keyed
from hackney.operators.features import with_features
from hackney.operators.keyed import KEY
from hackney.plans import binding, catalog
from tests.trips12 import trips12


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def texts(frame) -> list[str]:
    return sorted(map(str, frame.collect()))


@pytest.fixture
def many_puts(spark):
    """Twelve trips, and one of them 60 times more with other totals."""
    trips = trips12(spark)
    again = trips.where("PULocationID = 48").withColumn("n", F.explode(F.sequence(F.lit(100), F.lit(159))))
    return trips.unionByName(again.withColumn("total_amount", F.col("n").cast("double")).drop("n"))


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(keyed, "RANGE_ROWS", 2)
    monkeypatch.setattr(keyed, "_BUCKETS", 64)


def test_trips_are_shuffled_before_they_are_wide(spark, sf_dir):
    text = plan(keyed.ingest(binding.trips(spark, sf_dir), derive=with_features))
    assert "Partial" not in text and text.count("Exchange") == 1
    for late in ("named_struct", "date_format", "Sort ["):
        assert text.index(late) < text.index("Exchange")
        assert late not in text[text.index("Exchange") :]


def test_keys_with_very_many_rows_are_reduced_first(spark, many_puts, small_ranges):
    found = keyed.ingest(many_puts)
    assert "Partial" in plan(found)
    assert texts(found) == texts(keyed.latest_per_key(keyed.wide_rows(many_puts), [KEY], keyed.TRIP_SEQUENCE))


@pytest.mark.parametrize("characters", [0, 4])
def test_stored_trips_are_in_as_many_ranges_as_their_rows_need(spark, many_puts, small_ranges, tmp_path, characters):
    """what one task sorts does not grow with the table."""
    path = str(tmp_path / "t")
    keyed.store_trips(many_puts, path, folder_characters=characters)
    stored = keyed.read_wide(spark, path)
    assert len(stored.inputFiles()) > 8
    assert texts(stored.drop(keyed.VENDOR)) == texts(keyed.latest_per_key(keyed.wide_rows(many_puts), [KEY], keyed.TRIP_SEQUENCE))


def test_derived_columns_are_the_same_behind_the_shuffle(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    keyed.store_trips(binding.trips(spark, sf_dir), path, derive=with_features)
    before = keyed.latest_per_key(keyed.wide_rows(binding.featured_trips(spark, sf_dir)), [KEY], keyed.TRIP_SEQUENCE)
    assert texts(keyed.read_wide(spark, path).drop(keyed.VENDOR)) == texts(before)


def test_a_change_moves_stored_rows_once(spark, small_ranges, tmp_path, monkeypatch):
    """no join shuffles the stored rows a second time, and ranges are as many as the rows need."""
    path = str(tmp_path / "t")
    keyed.store_trips(trips12(spark), path)
    table = keyed.read_wide(spark, path)
    puts = keyed.put_cells(table.where(F.col(KEY).startswith("2_")), F.lit(True), "financials", {"tip_amount": 7.0})
    expected = texts(keyed.put_rows(keyed.delete_rows(table, ["1_20260101004035_161"]), puts, [KEY]))

    def joined(*_, **__):
        raise AssertionError("a join")

    monkeypatch.setattr(type(table), "join", joined)
    keyed.change_stored(spark, path, deletes=["1_20260101004035_161"], puts=puts, sequence=[KEY])
    changed = keyed.read_wide(spark, path)
    assert texts(changed.drop(keyed.VENDOR)) == expected and len(expected) == 11
    assert len(changed.inputFiles()) > 4


def test_lines_are_packed_in_files_of_few_lines(spark, sf_dir):
    """F3."""
    files = glob.glob(f"{binding.lines_path(spark, sf_dir).removeprefix('file:')}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    found = []
    for file in files:
        with gzip.open(file, "rt", encoding="utf-8", newline="\n") as f:
            found.append(f.read().split("\n")[:-1])
    assert max(map(len, found)) <= binding.FILE_LINES
    assert sorted(line for lines in found for line in lines) == sorted(r["value"] for r in binding.lines(spark, sf_dir).collect())


def test_both_puts_of_a_key_meet_before_the_shuffle(spark, sf_dir):
    """a scan for the table, and, for their keys and again for their rows, one for both puts and one for the new keys."""
    assert plan(catalog.QUERIES["k_put_rows"](spark, sf_dir)).count("FileScan parquet") == 5
