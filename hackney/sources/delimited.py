"""Clean trips as delimited text: quoted CSV, typed CSV and plain lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hackney.functions.numbers import number, truncated_int
from hackney.functions.text import strip
from hackney.schema import CLEAN_COLUMNS, staging_schema, stored_types

HEADER_WORD = next(iter(CLEAN_COLUMNS))
ARITY = len(CLEAN_COLUMNS)


def read_staging_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header; every column is text."""
    return (
        spark.read.schema(staging_schema())
        .options(header=True, sep=",", quote='"', escape="\\", enforceSchema=True)
        .csv(path)
    )


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with typed columns and no header; bad values become null.

    Fields are read as text and cast as the typed table casts them, so that `1.0` is the
    whole number 1 wherever it is read.
    """
    texts = spark.read.schema(staging_schema()).options(header=False, sep=",", quote="", mode="PERMISSIVE").csv(path)
    return texts.selectExpr(*typed_columns())


def typed_columns() -> list[str]:
    """The all-text layout cast to the stored types."""
    casts = {"int": truncated_int, "double": number, "string": str}
    return [f"{casts[kind](name)} AS {name}" for name, kind in stored_types().items()]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain comma-split lines as the clean layout, every column text.

    Quotes have no meaning, an empty field is null, and fields beyond the
    layout are cut off, however many there are. Blanks around a line belong to no
    field. Blank lines, header lines and lines with too few fields are left out.
    """
    # A generator of one row: what reads a field further on would otherwise split the line again, each time it names it.
    split = spark.read.text(path).selectExpr(f"explode(array(split({strip('value')}, ',', -1))) AS fields")
    names = list(CLEAN_COLUMNS)
    whole = split.where(f"size(fields) >= {ARITY} AND {strip('fields[0]')} <> '{HEADER_WORD}'")
    ends = (names[0], names[-1])
    cells = {n: strip(f"fields[{i}]") if n in ends else f"fields[{i}]" for i, n in enumerate(names)}
    return whole.selectExpr(*[f"nullif({cell}, '') AS {name}" for name, cell in cells.items()])
