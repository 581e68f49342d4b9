"""Null keys, key ranges over stored folders, exact sums, repeated puts and odd files."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.functions import numbers
from hackney.operators import keyed
from hackney.operators.keyed import KEY
from hackney.sources import delimited, parquet, tables


def wide(spark, rows):
    return spark.createDataFrame(rows, f"{KEY} string, cells struct<a: double, b: string>")


def keys(frame):
    return sorted(str(r[KEY]) for r in frame.select(KEY).collect())


@pytest.fixture(scope="module")
def ten(spark):
    return wide(spark, [(f"1_{i}", (float(i), "x")) for i in range(9)] + [(None, (9.0, "y"))])


@pytest.mark.parametrize("extra", [0, 999, 1000])
def test_null_keys_delete_and_find_nothing(spark, ten, extra):
    listed = ["1_3", None, *(f"absent_{i}" for i in range(extra))]
    table = spark.createDataFrame([(k,) for k in listed], f"{KEY} string")
    for asked in (listed, table):
        assert keys(keyed.delete_rows(ten, asked)) == sorted(["None", *(f"1_{i}" for i in range(9) if i != 3)])
        assert keys(keyed.chosen(ten, asked)) == ["1_3"]
        found = keyed.get_rows(ten, asked, ["cells"])
        assert found.count() == 1 + extra
        assert [r[KEY] for r in found.where("found").collect()] == ["1_3"]
    for none in ([None], spark.createDataFrame([(None,)], f"{KEY} string")):
        assert keyed.delete_rows(ten, none).count() == 10
        assert keyed.chosen(ten, none).count() == 0


def test_planning_a_get_runs_no_job(spark, ten):
    spark.sparkContext.setJobGroup("plan", "plan")
    listed = spark.range(3).select(F.concat(F.lit("1_"), "id").alias(KEY))
    keyed.get_rows(ten, listed, ["cells"])
    keyed.delete_audit(ten, keyed.delete_rows(ten, listed), listed)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")


@pytest.fixture(scope="module")
def odd_keys(spark, tmp_path_factory):
    draw = random.Random(5)
    parts = ["1", "10", "2", "abc", "v" * 120, "é", "Z-z", ""]
    made = {draw.choice(parts) + draw.choice(["", "_", "_19", "_20260101", "A", "_" + "w" * 9]) + str(draw.randint(0, 9)) for _ in range(120)}
    plain = wide(spark, [(k, (1.0, "x")) for k in sorted(made)])
    path = str(tmp_path_factory.mktemp("odd") / "t")
    keyed.write_wide(plain, path, files=3)
    return sorted(made), keyed.read_wide(spark, path)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_stored_scans_find_what_plain_ones_do(odd_keys, data):
    known, stored = odd_keys
    bound = st.one_of(st.none(), st.sampled_from(known), st.sampled_from(known).map(lambda k: k[:2]), st.text("1_abvZ", max_size=4))
    start, stop, prefix = data.draw(bound), data.draw(bound), data.draw(bound)
    found = keys(keyed.scan(stored, start=start, stop=stop, prefix=prefix))
    expected = [
        k
        for k in known
        if (start is None or k.encode() >= start.encode()) and (stop is None or k.encode() < stop.encode()) and k.startswith(prefix or "")
    ]
    assert found == sorted(expected)


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    made = [f"{v}_{i:03d}" for v in ("1", "2", "10", "ab") for i in range(40)] + ["1", "x", "", None, None]
    path = str(tmp_path_factory.mktemp("spans of") / "t")
    keyed.write_wide(wide(spark, [(k, (float(i), "x")) for i, k in enumerate(made)]), path, files=9)
    return path


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_first_rows_are_those_of_the_whole_table(spark, many_files, data):
    bound = st.one_of(st.none(), st.sampled_from(["1", "1_010", "10_", "2_03", "2_039", "ab", "z", ""]), st.text("12_abx0", max_size=4))
    limits = {"start": data.draw(bound), "stop": data.draw(bound), "prefix": data.draw(bound)}
    n, reverse = data.draw(st.sampled_from([1, 3, 30, 500])), data.draw(st.booleans())
    whole = keyed.scan(keyed.read_wide(spark, many_files), **limits, limit=n, reverse=reverse)
    first = keyed.scan(keyed.read_first(spark, many_files, n, **limits, reverse=reverse), **limits, limit=n, reverse=reverse)
    assert keys(first) == keys(whole)


def test_a_few_rows_are_read_from_a_few_files(spark, many_files):
    files = len(keyed.read_wide(spark, many_files).inputFiles())
    assert files >= 9
    for asked in ({"prefix": "2_"}, {"prefix": "10_01"}, {"reverse": True}, {"prefix": "ab_", "reverse": True}):
        assert len(keyed.read_first(spark, many_files, 3, **asked).inputFiles()) <= 3


def test_one_shuffle_stores_the_last_put_of_each_key(spark, tmp_path):
    rows = [(f"1_{i % 50}", (float(i), "x")) for i in range(500)]
    keyed.write_wide(wide(spark, rows).repartition(5), str(tmp_path / "t"), sequence=["cells.a"])
    stored = keyed.read_wide(spark, str(tmp_path / "t"))
    assert sorted(r.cells.a for r in stored.collect()) == [float(i) for i in range(450, 500)]


CHANGES = [
    # deletes, puts
    (["1_010", "absent", None], []),
    ([], [("1_0005", 1), ("1_0005", 2), ("2_039", 1)]),
    (["2_001", "x", "ab_000"], [("2_001", 5), ("new_1", 1), (None, 3), ("x", 9)]),
    ([f"ab_{i:03d}" for i in range(40)], []),
    ([], []),
]


@pytest.mark.parametrize("characters", [0, 2])
def test_changes_in_place_are_those_of_whole_tables(spark, tmp_path, characters):
    made = [f"{v}_{i:03d}" for v in ("1", "2", "10", "ab") for i in range(40)] + ["1", "x", "", "é b/%_1", None, None]
    path = str(tmp_path / "in place")
    plain = wide(spark, [(k, (float(i), "x")) for i, k in enumerate(made)])
    keyed.write_wide(plain, path, files=4, folder_characters=characters)
    for deletes, new in CHANGES:
        puts = spark.createDataFrame([(k, (float(n), "put"), n) for k, n in new], f"{KEY} string, cells struct<a: double, b: string>, n int")
        plain = keyed.put_rows(keyed.delete_rows(plain, deletes), puts, ["n"])
        keyed.change_stored(spark, path, deletes=deletes, puts=puts if new else None, sequence=["n"], files=2)
        stored = keyed.read_wide(spark, path)
        assert sorted(map(str, stored.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
        for asked in ({"prefix": "ab_"}, {"reverse": True}):
            first = keyed.scan(keyed.read_first(spark, path, 4, **asked), **asked, limit=4)
            assert keys(first) == keys(keyed.scan(plain, **asked, limit=4))
        assert keys(keyed.chosen(stored, ["1_011", "2_001", "new_1"])) == keys(keyed.chosen(plain, ["1_011", "2_001", "new_1"]))


def test_a_change_leaves_other_folders_alone_and_a_failed_one_all(spark, tmp_path):
    made = [f"1_2024{m:02d}{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    path = str(tmp_path / "t")
    keyed.write_wide(wide(spark, [(k, (1.0, "x")) for k in made]), path, files=3, folder_characters=6)
    before = set(keyed.read_wide(spark, path).inputFiles())
    ten = [k for k in made if k.startswith("1_202403")][:10]
    puts = wide(spark, [(k, (2.0, "y")) for k in ten])
    failing = puts.withColumn("cells", F.when(F.col(KEY) == ten[9], F.raise_error(F.lit("lost"))).otherwise(F.col("cells")))
    with pytest.raises(Exception, match="lost"):
        keyed.change_stored(spark, path, puts=failing, sequence=[KEY])
    assert set(keyed.read_wide(spark, path).inputFiles()) == before
    assert keyed.read_wide(spark, path).where("cells.b = 'x'").count() == len(made)
    keyed.change_stored(spark, path, puts=puts, sequence=[KEY])
    after = keyed.read_wide(spark, path)
    assert {f.split("key_vendor=")[1].split("/")[0] for f in before ^ set(after.inputFiles())} == {"v1_202403"}
    assert keys(after.where("cells.b = 'y'")) == ten and after.count() == len(made)
    keyed.change_stored(spark, path, deletes=after.select(KEY))
    assert keyed.read_wide(spark, path).count() == 0 and keyed.read_first(spark, path, 3).count() == 0


@pytest.mark.parametrize(
    ("pattern", "start"),
    [("^2_1997.*", "2_1997"), ("2_", ""), ("^ab*", "a"), ("^ab|c", ""), ("^a+b", "a"), ("^(x)", ""), ("^a?b", "")],
)
def test_start_of_a_pattern(pattern, start):
    assert keyed.literal_start(pattern) == start


def test_the_last_of_several_puts_stays(spark, ten):
    puts = wide(spark, [("1_1", (70.0, "old")), ("1_1", (71.0, "new")), ("2_9", (1.0, "a")), ("2_9", (2.0, "b"))])
    put = keyed.put_rows(ten, puts.withColumn("n", F.col("cells.a")), ["n"])
    assert put.count() == 11 and put.columns == ten.columns
    assert {r.cells.b for r in put.where(F.col(KEY).isin("1_1", "2_9")).collect()} == {"new", "b"}


def test_merge_keeps_the_last_value_of_each_cell(spark, ten):
    changes = spark.createDataFrame(
        [("1_1", (70.0, None), 1), ("1_1", (None, "new"), 2), ("2_9", (5.0, None), 1)],
        f"{KEY} string, cells struct<a: double, b: string>, n int",
    )
    merged = {r[KEY]: tuple(r.cells) for r in keyed.merge_cells(ten, changes, ["n"]).collect()}
    assert len(merged) == 11
    assert merged["1_1"] == (70.0, "new") and merged["2_9"] == (5.0, None) and merged[None] == (9.0, "y")


def test_sums_do_not_depend_on_partitioning(spark):
    frame = spark.range(200_000).selectExpr("(id * 7919 % 1000003) * 123.457D + 99999999.01D AS x")
    told = {
        tuple(frame.repartition(n).selectExpr(f"{numbers.total('x')} AS t", f"{numbers.mean('x')} AS m").first())
        for n in (1, 7, 64)
    }
    assert len(told) == 1 and next(iter(told))[0] > 1e13


def test_means_are_rounded_once(spark):
    frame = spark.sql("SELECT * FROM VALUES (0.12499999999D), (NULL), (double('NaN')) AS t(x)")
    assert frame.selectExpr(numbers.mean("x")).first()[0] == 0.12
    assert spark.sql("SELECT 2.675D AS x").selectExpr(numbers.mean("x")).first()[0] == 2.68


def test_bytes_of_large_numbers_have_no_exponent(spark):
    table = wide(spark, [("1_1", (12345678.0, "x")), ("1_2", (12345678.25, "x")), ("1_3", (9.5, "x"))])
    found = keyed.scan(table, where=keyed.cell_filter("cells.a", "=", "12345678.0", compare="bytes"))
    assert keys(found) == ["1_1"]
    assert keys(keyed.scan(table, where=keyed.cell_filter("cells.a", "=", "12345678.25", compare="bytes"))) == ["1_2"]


def test_long_lines_are_read(spark, tmp_path):
    (tmp_path / "t.txt").write_text(",".join(["1"] * 25_000) + "\n" + ",".join(["2"] * 31) + "\n")
    assert sorted(r["VendorID"] for r in delimited.read_lines(spark, str(tmp_path / "t.txt")).collect()) == ["1", "2"]


def test_a_whole_number_with_a_point_is_read_alike(spark, tmp_path):
    (tmp_path / "t.csv").write_text(",".join(["1.0"] * 31) + "\n")
    assert delimited.read_typed_csv(spark, str(tmp_path / "t.csv")).first()["VendorID"] == 1


def test_percent_marks_go_from_named_columns_only(spark, tmp_path):
    frame = spark.sql("SELECT 'a%' AS key, 12.5D AS share")
    tables.write_tsv(frame, str(tmp_path / "t"), ["share"])
    assert tuple(tables.read_tsv(spark, str(tmp_path / "t"), frame.schema, ["share"]).first()) == ("a%", 12.5)


def test_files_of_different_types_are_widened(spark, tmp_path):
    spark.sql("SELECT 1 AS VendorID, 2L AS passenger_count").write.parquet(str(tmp_path / "t"))
    spark.sql("SELECT 3L AS VendorID, 2.5D AS passenger_count, 1D AS extra").write.mode("append").parquet(str(tmp_path / "t"))
    read = parquet.read_trip_files(spark, str(tmp_path / "t"))
    assert dict(read.dtypes) == {"VendorID": "bigint", "passenger_count": "double", "extra": "double"}
    assert sorted((r["VendorID"], r["passenger_count"], r["extra"]) for r in read.collect()) == [(1, 2.0, None), (3, 2.5, 1.0)]
