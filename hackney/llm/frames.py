"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hackney.sources.scratch import scratch_root

# Rows handled at a time inside a task, so that a batch of long texts stays small in Python.
SLICE_ROWS = 256


def pick(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact spelling, whatever other columns the frame has.

    Spark resolves names without regard to case and reads dots as field access,
    so a frame with `text`, `TEXT` and `a.b` is picked from by position.
    """
    plain = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    return plain.select(*[plain[f"c{frame.columns.index(name)}"].alias(name) for name in names])


def kind_of(frame: DataFrame, name: str) -> str:
    """The SQL type of a column."""
    return frame.schema[name].dataType.simpleString()


def texts_of(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text, a null text read as the empty text."""
    return pick(frame, key, text).withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))


def map_slices(frame: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, rows: int = SLICE_ROWS) -> DataFrame:
    """Apply a function to slices of Arrow batches; a row in may give any number of rows out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))

    return frame.mapInArrow(run, schema)


def cut(frame: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back, so that lost executors cost no recomputation.

    The folder is the session's; one of its own is set only in local mode and only where the session names none.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(frame.sparkSession))
    return frame.checkpoint()
