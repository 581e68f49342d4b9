"""Raw trip files in Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_trip_files(
    spark: SparkSession, folder: str, schema: StructType | None = None
) -> DataFrame:
    """All `*.parquet` files of a folder as one table, columns matched by name.

    Files may lack columns; those rows hold null there. Where a column's type differs between
    files (whole numbers in one, fractions in the next), files of one schema are read together
    and widened to a type that holds both. A folder without files raises an analysis error.
    Pass `schema` to skip reading every file footer.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        return reader.schema(schema).parquet(folder)
    try:
        return reader.option("mergeSchema", True).parquet(folder)
    except Exception as error:  # the class that says so differs between kinds of sessions
        if "MERGE_SCHEMA" not in str(error) and "merge" not in str(error).lower():
            raise
    return concat_trips(*[spark.read.parquet(*files) for files in _by_schema(spark, folder)])


def _by_schema(spark: SparkSession, folder: str) -> list[list[str]]:
    """The folder's files, those of one schema together, in order of their names.

    One footer is read for each file; a folder holds a file or some for each month.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path")
    groups: dict[str, list[str]] = {}
    for path in sorted(row["path"] for row in listed.collect()):
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return list(groups.values())


def concat_trips(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, widening types and filling gaps with null."""
    if not frames:
        raise ValueError("no trip frames to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
