"""Typed tables and result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hackney.sources.delimited import HEADER_WORD, typed_columns


def typed_trips(staging: DataFrame) -> DataFrame:
    """Cast the all-text layout; bad values become null, header rows go."""
    return staging.where(f"{HEADER_WORD} <> '{HEADER_WORD}'").selectExpr(*typed_columns())


def write_orc(trips: DataFrame, path: str) -> None:
    trips.write.mode("overwrite").option("compression", "snappy").orc(path)


def read_orc(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.orc(path)


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header; also the result-file format of a query."""
    frame.write.mode("overwrite").options(
        header=True, escape="\\", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_results(results: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One result file set per query; gives back the paths by name."""
    paths = {name: f"{folder}/{name}" for name in results}
    for name, frame in results.items():
        write_csv(frame, paths[name])
    return paths


def tsv_rows(frame: DataFrame, percents: Sequence[str] = ()) -> DataFrame:
    """Job output lines: tab-joined, two decimals, `%` after the named columns."""
    pattern, cells = [], []
    for name, kind in frame.dtypes:
        if kind == "double":
            pattern.append("%.2f%%" if name in percents else "%.2f")
        else:
            pattern.append("%s")
        cells.append(F.col(name))
    return frame.select(F.format_string("\t".join(pattern), *cells).alias("line"))


def write_tsv(frame: DataFrame, path: str, percents: Sequence[str] = ()) -> None:
    tsv_rows(frame, percents).write.mode("overwrite").text(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType, percents: Sequence[str] = ()) -> DataFrame:
    """Job output read back with typed columns; the `%` marks of the named columns are dropped."""
    text = StructType.fromDDL(", ".join(f"`{f.name}` string" for f in schema))
    frame = spark.read.schema(text).options(sep="\t", header=False).csv(path)
    return frame.select(
        *[
            (F.rtrim(F.col(f.name), F.lit("%")) if f.name in percents else F.col(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def round_trip_check(written: DataFrame, read_back: DataFrame) -> DataFrame:
    """Row and column counts on both sides and the empty cells read back."""
    empty = sum(
        (F.col(f"`{c}`").isNull().cast("bigint") for c in read_back.columns), start=F.lit(0)
    )
    before = written.agg(F.count("*"))
    after = read_back.agg(
        F.count("*").alias("rows_read"),
        F.coalesce(F.sum(empty), F.lit(0)).cast("bigint").alias("null_cells"),
    )
    same_width = len(written.columns) == len(read_back.columns)
    return after.select(
        before.scalar().alias("rows_written"),
        "rows_read",
        F.lit(len(written.columns)).alias("columns_written"),
        F.lit(len(read_back.columns)).alias("columns_read"),
        "null_cells",
    ).withColumn(
        "passed",
        F.lit(same_width) & (F.col("rows_written") == F.col("rows_read")) & (F.col("null_cells") == 0),
    )


def titled(result: DataFrame, title: str) -> DataFrame:
    """A report with its title in front."""
    return result.select(F.lit(title).alias("query_title"), "*")

