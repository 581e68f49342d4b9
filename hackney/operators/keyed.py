"""Keyed wide rows: build, put, get, delete and scan.

A wide table has a text `row_key` and one struct column per column group, with
typed cells, so cell predicates and single cells are read straight from the
file. Stored tables are split into vendor folders and sorted by key. They keep
the folder name as a column, from which key conditions also skip whole folders;
within a folder they skip row groups by the statistics of the sorted key.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions import times, trips
from hackney.functions.numbers import truncated_int
from hackney.schema import FAMILIES

KEY = "row_key"

# Folder column of stored tables: `v` and the vendor part of the key. The letter
# keeps Spark from reading the folder name as a number.
VENDOR = "key_vendor"

COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}


def families(table: DataFrame) -> dict[str, list[str]]:
    """Column groups and their cells, from the schema."""
    return {
        f.name: f.dataType.names for f in table.schema if isinstance(f.dataType, T.StructType)
    }


# --- build ---------------------------------------------------------------


def _cell(column: str, kind: str) -> str:
    if column.endswith("_datetime"):
        return times.time_text(column)
    if column == "passenger_count":
        return truncated_int(column)
    return f"CAST({column} AS {kind})"


# Every cell of a wide row by group and name, from the columns of a trip.
_CELLS = {f"{group}.{name}": _cell(*source) for group, cells in FAMILIES.items() for name, source in cells.items()}
_TRIP_KEY = trips.row_key("VendorID", "tpep_pickup_datetime", "PULocationID")


def _grouped(frame: DataFrame, *others: str) -> DataFrame:
    groups = [
        f"named_struct({', '.join(f'{name!r}, {_CELLS[f"{group}.{name}"]}' for name in cells)}) AS {group}"
        for group, cells in FAMILIES.items()
    ]
    return frame.selectExpr(*others, *groups)


def wide_rows(frame: DataFrame) -> DataFrame:
    """One wide row per trip; equal keys are not merged here."""
    return _grouped(frame, f"{_TRIP_KEY} AS {KEY}")


def latest_per_key(frame: DataFrame, key: Sequence[str], sequence: Sequence[str | Column]) -> DataFrame:
    """The last row per key in sequence order.

    Spark keeps one row per key and task before the shuffle, so a key with very
    many versions does not land in one task.
    """
    newest = [F.col(s).desc() if isinstance(s, str) else s.desc() for s in sequence]
    place = F.row_number().over(W.partitionBy(*key).orderBy(*newest))
    return frame.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


# The order of puts of trips that share a key.
TRIP_SEQUENCE = (
    "timing.dropoff_datetime",
    "trip_info.DOLocationID",
    "trip_info.payment_type",
    "financials.total_amount",
    "trip_info.trip_distance",
)


Derive = Callable[[DataFrame], DataFrame]

# Rows of a key range or a hash partition, about: what one task sorts then fits its memory.
RANGE_ROWS = 1_250_000

# Keys are counted by this many hash buckets, to find out whether some have very many rows.
_BUCKETS = 4096


def _partitions(spark: SparkSession, rows: int) -> list[int]:
    """The number of partitions that so many rows need; none where the session's own setting makes them as small."""
    asked = -(-rows // RANGE_ROWS)
    usual = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return [asked] if asked > usual else []


def _cells_of(sequence: Sequence[str | Column]) -> list[Column] | None:
    """A sequence of cells, said of the trips themselves; none if it names anything else."""
    plain = all(isinstance(s, str) and s in _CELLS for s in sequence)
    return [F.expr(_CELLS[s]) for s in sequence] if plain else None


def ingest(frame: DataFrame, sequence: Sequence[str | Column] = TRIP_SEQUENCE, derive: Derive | None = None) -> DataFrame:
    """Trips as wide rows with one row per key; the last put of a key stays.

    Trips are shuffled as they are, without a sort before, and become wide rows behind the shuffle; so do the columns that
    `derive` adds. Only keys of buckets with very many rows are reduced to a row per key and task first. One pass counts the buckets.
    """
    ready = derive or (lambda trip: trip)
    order = _cells_of(sequence)
    if order is None:
        return latest_per_key(wide_rows(ready(frame)), [KEY], sequence)
    key = F.expr(_TRIP_KEY)
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS))
    counts = {r["bucket"]: r["count"] for r in frame.groupBy(bucket.alias("bucket")).count().collect()}
    rows = sum(counts.values())
    often = [b for b, n in counts.items() if n > max(RANGE_ROWS, 4 * rows // _BUCKETS)]

    def latest(trip: DataFrame) -> DataFrame:
        return _grouped(latest_per_key(ready(trip).withColumn(KEY, key), [KEY], order), KEY)

    rest = frame.where(~bucket.isin(often)) if often else frame
    dealt = latest(rest.repartition(*_partitions(frame.sparkSession, rows), key))
    return dealt.unionByName(latest(frame.where(bucket.isin(often)))) if often else dealt


def store_trips(frame: DataFrame, path: str, files: int | None = None, derive: Derive | None = None, folder_characters: int = 0) -> None:
    """Trips stored as a wide table, with one shuffle for the upsert and the layout together.

    Trips are shuffled as they are, and become wide rows behind the shuffle; so do the columns that `derive` adds.
    """
    ready = derive or (lambda trip: trip)
    key = F.expr(_TRIP_KEY)
    folder = _folder_of(key, folder_characters)
    ranges = _partitions(frame.sparkSession, frame.count()) if files is None else [files]
    ranged = ready(frame.repartitionByRange(*ranges, folder, key)).withColumns({VENDOR: folder, KEY: key})
    last = latest_per_key(ranged, [VENDOR, KEY], _cells_of(TRIP_SEQUENCE)).sortWithinPartitions(VENDOR, KEY)
    _write_sorted(_grouped(last, KEY, VENDOR), path, "static")
    _note_spans(read_wide(frame.sparkSession, path), path)


# Where the key spans of a stored table's files are noted; readers of the table pass over such a name.
_SPANS = "_spans"


# The notes: one row for each file, apart by the table's own folders.
_SPAN_COLUMNS = f"file string, least string, most string, rows bigint, keyless bigint, {VENDOR} string"


def _folder_of(key: Column, characters: int = 0) -> Column:
    vendor = F.substring_index(key, "_", 1)
    name = F.left(key, F.length(vendor) + 1 + characters) if characters else vendor
    return F.concat(F.lit("v"), name)


def _with_folder(table: DataFrame, characters: int = 0) -> DataFrame:
    return _unstored(table).withColumn(VENDOR, _folder_of(F.col(KEY), characters))


def _write_sorted(table: DataFrame, path: str, mode: str) -> None:
    """Write sorted rows that know their folder; `dynamic` replaces the folders that get rows and no others."""
    table.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd").partitionBy(VENDOR).parquet(path)


def _write_folders(table: DataFrame, path: str, files: int | None, sequence: Sequence[str | Column], mode: str) -> None:
    """Write rows that know their folder, in key ranges."""
    ranged = table.repartitionByRange(*([] if files is None else [files]), VENDOR, KEY)
    if sequence:
        ranged = latest_per_key(ranged, [VENDOR, KEY], sequence)
    _write_sorted(ranged.sortWithinPartitions(VENDOR, KEY), path, mode)


def _note_spans(stored: DataFrame, path: str) -> None:
    noted = stored.groupBy(VENDOR, F.col("_metadata.file_path").alias("file")).agg(
        F.min(KEY).alias("least"), F.max(KEY).alias("most"), F.count(KEY).alias("rows"), F.count_if(F.col(KEY).isNull()).alias("keyless")
    )
    spans = noted.select("file", "least", "most", "rows", "keyless", VENDOR).coalesce(1)
    spans.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VENDOR).parquet(f"{path}/{_SPANS}")


def _plain_name(file: str) -> str:
    """A file's name as it is; Spark gives local ones with one slash or three."""
    return unquote(file).replace("file:///", "file:/", 1)


def _spans_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SPAN_COLUMNS).parquet(f"{path}/{_SPANS}")


def write_wide(
    table: DataFrame, path: str, files: int | None = None, sequence: Sequence[str | Column] = (), folder_characters: int = 0
) -> None:
    """Store a wide table split by vendor and sorted by key.

    The range shuffle gives every file its own key range. Files stay apart even
    when one vendor holds most rows, because the ranges cut through vendors.
    `files` sets the number of ranges; the session's shuffle setting otherwise.
    With `sequence` the table may hold several rows per key, and the last of each
    is stored; the ranges bring them together, so that takes no further shuffle.
    `folder_characters` puts that many characters that follow the vendor into the folder's name
    (6: a folder for each month), for tables that are changed in place.
    """
    _write_folders(_with_folder(table, folder_characters), path, files, sequence, "static")
    _note_spans(read_wide(table.sparkSession, path), path)


def _in_folders(table: DataFrame, folders: Sequence[str | None]) -> DataFrame:
    named = F.col(VENDOR).isin(*[f for f in folders if f is not None])
    return table.where(named | F.col(VENDOR).isNull() if None in folders else named)


# What a row is to a change: stored (0), taken away (1) or put (2); rows of a key's highest step stay, those taken away do not.
_STEP = "_step"


def change_stored(
    spark: SparkSession,
    path: str,
    *,
    deletes: Sequence[str | None] | DataFrame = (),
    puts: DataFrame | None = None,
    sequence: Sequence[str | Column] = (),
    files: int | None = None,
) -> None:
    """Delete keys from a stored table and then put rows, in place; only the folders of those keys are written.

    Semantics are those of `delete_rows` and `put_rows`; puts may come from the table itself. Stored rows, deletes and puts
    meet in the range shuffle that lays the folders out, so the stored rows move once. Other folders' files are neither read nor touched. New files are written beside the old ones and take their place when all are done,
    so a change whose tasks fail leaves the table as it was; a driver lost during that last step, which only renames,
    may leave some folders changed and others not. One change at a time. A folder that lost all
    its rows keeps an empty file. What goes to the driver are names of folders and files.
    """
    table = read_wide(spark, path)
    names = [r[VENDOR][1:].split("_", 1) for r in _spans_of(spark, path).where(f"{VENDOR} IS NOT NULL").select(VENDOR).distinct().collect()]
    # A shorter key is its folder's whole name, so the longest name tells the width that all folders agree with.
    characters = max((len(name[1]) for name in names if len(name) > 1), default=0)
    gone = deletes if isinstance(deletes, DataFrame) else _key_frame(table, deletes)
    # A null key deletes nothing, but a row without a key can be put.
    changed = gone.select(KEY).where(F.col(KEY).isNotNull())
    if puts is not None:
        changed = changed.unionByName(puts.select(KEY))
    touched = {r[VENDOR]: r["count"] for r in _with_folder(changed, characters).groupBy(VENDOR).count().collect()}
    folders = list(touched)
    if not folders:
        return
    before = set(table.inputFiles())
    noted = _in_folders(_spans_of(spark, path), folders).agg(F.sum(F.col("rows") + F.col("keyless"))).first()[0] or 0
    stored = _unstored(_in_folders(table, folders))
    steps = stored.withColumn(_STEP, F.lit(0))
    away = gone.select(KEY).where(F.col(KEY).isNotNull()).withColumn(_STEP, F.lit(1))
    steps = steps.unionByName(away, allowMissingColumns=True)
    if puts is not None:
        newest = latest_per_key(puts, [KEY], sequence).select(*stored.columns)
        steps = steps.unionByName(newest.withColumn(_STEP, F.lit(2)))
    ranges = _partitions(spark, noted + sum(touched.values())) if files is None else [files]
    ranged = _with_folder(steps, characters).repartitionByRange(*ranges, VENDOR, KEY)
    place = F.rank().over(W.partitionBy(VENDOR, KEY).orderBy(F.col(_STEP).desc()))
    last = ranged.withColumn("_place", place).where(((F.col("_place") == 1) & (F.col(_STEP) != 1)) | F.col(KEY).isNull())
    _write_sorted(last.drop("_place", _STEP).sortWithinPartitions(VENDOR, KEY), path, "dynamic")

    after = read_wide(spark, path)
    named = {f"{VENDOR}={'__HIVE_DEFAULT_PARTITION__' if f is None else f}" for f in folders}
    kept = {unquote(file).rpartition("/")[0] for file in before.intersection(after.inputFiles())}
    # Only a folder that got no rows at all still has its old files.
    emptied = [folder for folder in kept if unquote(folder.rpartition("/")[2]) in named]
    for folder in emptied:
        none = table.drop(VENDOR).where("false").coalesce(1)
        none.write.mode("overwrite").parquet(folder)
        noted = spark.createDataFrame([], _SPAN_COLUMNS).drop(VENDOR).coalesce(1)
        noted.write.mode("overwrite").parquet(f"{path}/{_SPANS}/{folder.rpartition('/')[2]}")
    _note_spans(_in_folders(read_wide(spark, path), folders), path)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_first(
    spark: SparkSession,
    path: str,
    n: int,
    *,
    start: str | None = None,
    stop: str | None = None,
    prefix: str | None = None,
    reverse: bool = False,
) -> DataFrame:
    """As much of a stored table as holds its first n rows in key order, or its last ones, of a key range or prefix.

    For `scan` with the same range and a limit of up to n. What `write_wide` noted of each file, its least and largest key and its
    rows, tells which files those rows must be in; mostly one. Files that reach beyond the range count for no rows, as
    nothing is known of how many are inside, but are read. Rows of null keys are in no range and come before all others.
    Files without notes (a change was cut short) are read too, and the whole table where noted files are gone.
    """
    least, most = F.col("least"), F.col("most")
    met, inside = most.isNotNull(), F.lit(True)
    keyless = F.lit(start is None and stop is None and prefix is None) & (F.col("keyless") > 0)
    if start is not None:
        met, inside = met & (most >= start), inside & (least >= start)
    if stop is not None:
        met, inside = met & (least <= stop), inside & (most < stop)
    if prefix is not None:
        met = met & (F.left(most, F.lit(len(prefix))) >= prefix) & (F.left(least, F.lit(len(prefix))) <= prefix)
        inside = inside & least.startswith(prefix) & most.startswith(prefix)
    table = read_wide(spark, path)
    present = {_plain_name(file) for file in table.inputFiles()}
    noted = {_plain_name(row["file"]) for row in _spans_of(spark, path).select("file").collect()}
    if not noted <= present:
        return table
    spans = _spans_of(spark, path).where(met | keyless)
    # All rows of the files that end soonest come before whatever begins after them. One row for each file.
    upto = F.sum(F.when(inside, F.col("rows")).otherwise(0)).over(W.orderBy(least.desc() if reverse else most.asc()))
    enough = spans.withColumn("upto", upto).where(F.col("upto") >= n)
    border = enough.agg(F.max(least) if reverse else F.min(most)).first()[0]
    if border is not None:
        spans = spans.where(most >= border if reverse else (least <= border) | keyless)
    files = {_plain_name(row["file"]) for row in spans.select("file").collect()} | (present - noted)
    return spark.read.option("basePath", path).parquet(*sorted(files)) if files else table.where("false")


def _unstored(table: DataFrame) -> DataFrame:
    return table.drop(VENDOR)


def _folders(
    table: DataFrame,
    *,
    start: str | None = None,
    stop: str | None = None,
    prefix: str | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Cut a stored table to the folders that can hold the keys.

    Every key starts with its folder's name, so comparing that name with as much
    of the bound never leaves out a wanted key, whether or not the key has an
    underscore.
    """
    if VENDOR not in table.columns:
        return table
    head = F.expr(f"substring({VENDOR}, 2)")
    size = F.length(head)
    if start is not None:
        table = table.where(head >= F.left(F.lit(start), size))
    if stop is not None:
        table = table.where(head <= F.left(F.lit(stop), size))
    if prefix is not None:
        table = table.where(F.left(head, F.lit(len(prefix))) == F.left(F.lit(prefix), size))
    if keys is not None:
        # A folder's name goes beyond the vendor by a number of characters that the table chose.
        shortest = ((k, len(k.split("_")[0])) for k in keys)
        names = {"v" + k[:n] for k, least in shortest for n in range(least, len(k) + 1)}
        table = table.where(F.col(VENDOR).isin(*sorted(names)))
    return table


def flatten(table: DataFrame) -> DataFrame:
    """The key and every cell as plain columns."""
    cells = [F.col(f"{group}.{name}") for group, names in families(table).items() for name in names]
    return table.select(KEY, *cells)


# --- put -----------------------------------------------------------------


def put_rows(table: DataFrame, changes: DataFrame, sequence: Sequence[str | Column], key: Sequence[str] = (KEY,)) -> DataFrame:
    """Insert or replace whole rows; of several changes for a key the last in sequence order stays.

    Columns of the changes that the table does not have only serve the sequence. Which side
    is broadcast, if any, is left to the optimizer and the sizes it sees.
    """
    table = _unstored(table)
    newest = latest_per_key(changes, key, sequence).select(*table.columns)
    return table.join(newest.select(*key), list(key), "left_anti").unionByName(newest)


def merge_cells(table: DataFrame, changes: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """Put single cells: given cells replace, missing cells stay as they are.

    `changes` has structs named like the column groups, with any subset of their cells, and the
    columns of the sequence; a new group or cell joins the table. Of several changes for a key the
    last value given for each cell stays. Keys the table does not have become new rows, a null key
    matches none. Changes are reduced to a row per key where they are read, and one outer join
    brings both sides together, so the table is read once.
    """
    table, changes = _unstored(table), _unstored(changes)
    old, new = families(table), families(changes)
    groups = list(dict.fromkeys([*old, *new]))
    kinds = {
        (group, f.name): f.dataType
        for frame in (changes, table)
        for group in families(frame)
        for f in frame.schema[group].dataType
    }
    order = F.struct(*[F.col(c) for c in sequence])
    path = {(group, name): F.col(f"{group}.{name}") for group, names in new.items() for name in names}
    last = changes.groupBy(KEY).agg(
        *[
            F.struct(*[F.max_by(path[group, name], F.when(path[group, name].isNotNull(), order)).alias(name) for name in names]).alias(group)
            for group, names in new.items()
        ]
    )

    def cells(group: str) -> Column:
        """A group whose cells come from the changes, else from the table."""
        names = dict.fromkeys([*old.get(group, []), *new.get(group, [])])
        sources = (("c", new), ("t", old))
        return F.struct(
            *[
                F.coalesce(
                    *[F.col(f"{alias}.{group}.{name}") for alias, has in sources if name in has.get(group, [])],
                    F.lit(None),
                )
                .cast(kinds[group, name])
                .alias(name)
                for name in names
            ]
        ).alias(group)

    both = table.alias("t").join(last.alias("c"), F.col(f"t.{KEY}") == F.col(f"c.{KEY}"), "full_outer")
    return both.select(F.coalesce(f"t.{KEY}", f"c.{KEY}").alias(KEY), *[cells(group) for group in groups])


def add_family(table: DataFrame, group: str, cells: Mapping[str, str]) -> DataFrame:
    """A new, empty column group."""
    kind = T.StructType.fromDDL(", ".join(f"`{name}` {t}" for name, t in cells.items()))
    return table.withColumn(group, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind]))


def put_cells(table: DataFrame, where: Column, group: str, values: Mapping[str, object]) -> DataFrame:
    """Set cells of the chosen rows."""
    cell = F.col(group)
    for name, value in values.items():
        cell = cell.withField(name, F.when(where, F.lit(value)).otherwise(F.col(f"{group}.{name}")))
    return table.withColumn(group, cell)


def drop_family(table: DataFrame, group: str) -> DataFrame:
    return table.drop(group)


# --- get -----------------------------------------------------------------


def project(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The key plus column groups (`metrics`) or cells (`metrics.is_weekend`)."""
    groups = families(table)
    cells = [
        F.col(f"{name}.{cell}") if name in groups else F.col(name)
        for name in columns
        for cell in (groups.get(name) or [""])
    ]
    return table.select(KEY, *cells)


def project_prefix(table: DataFrame, prefix: str) -> DataFrame:
    """The key plus every cell whose name starts with the prefix."""
    cells = [
        f"{group}.{name}"
        for group, names in families(table).items()
        for name in names
        if name.startswith(prefix)
    ]
    return table.select(KEY, *cells)


def get_row(table: DataFrame, key: str | Column, columns: Sequence[str] | None = None) -> DataFrame:
    """The row with this key, or no row. Column groups and cells are optional."""
    if isinstance(key, str):
        table = _folders(table, keys=[key])
    row = table.where(F.col(KEY) == key)
    return project(row, columns) if columns else flatten(row)


def chosen(table: DataFrame, keys: Sequence[str | None] | DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (`left_semi`) or is not (`left_anti`) among the keys.

    A null key, asked or stored, equals none: rows with one are never chosen and never taken away.
    A caller's own list is a literal filter, which skips files and row groups by their
    statistics. A table of keys is a join, whatever its size; the optimizer sees the size and
    broadcasts a small one.
    """
    if isinstance(keys, DataFrame):
        return table.join(keys.select(KEY).where(F.col(KEY).isNotNull()).distinct(), KEY, how)
    listed = [k for k in keys if k is not None]
    if not listed:
        return table.where(F.lit(how == "left_anti"))
    inside = F.col(KEY).isin(*listed)
    if how == "left_semi":
        return _folders(table, keys=listed).where(inside)
    return table.where(F.coalesce(~inside, F.lit(True)))


def _key_frame(table: DataFrame, keys: Sequence[str | None]) -> DataFrame:
    return table.sparkSession.createDataFrame([(k,) for k in keys], f"{KEY} string")


def get_rows(table: DataFrame, keys: Sequence[str | None] | DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per asked key, in key order, with `found` false for absent keys; null keys are not asked.

    The table is first cut down to the asked keys, by a literal list or a
    semi-join, so the outer join only sees rows that are wanted.
    """
    hits = project(chosen(table, keys), columns).withColumn("found", F.lit(True))
    asked = keys if isinstance(keys, DataFrame) else _key_frame(table, keys)
    return (
        asked.select(KEY)
        .where(F.col(KEY).isNotNull())
        .distinct()
        .join(hits, KEY, "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
        .orderBy(KEY)
    )


# --- delete --------------------------------------------------------------


def delete_rows(table: DataFrame, keys: Sequence[str | None] | DataFrame) -> DataFrame:
    """Without the rows of these keys; absent keys change nothing."""
    return chosen(table, keys, "left_anti")


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Without the rows the condition holds for; one filter, no join."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def delete_cell(table: DataFrame, path: str, where: Column) -> DataFrame:
    """Empty one cell of the chosen rows; the rows stay."""
    group, name = path.split(".")
    kept = F.when(F.coalesce(where, F.lit(False)), F.lit(None)).otherwise(F.col(path))
    return table.withColumn(group, F.col(group).withField(name, kept))


def delete_audit(before: DataFrame, after: DataFrame, keys: Sequence[str | None] | DataFrame) -> DataFrame:
    """Row counts around a deletion and how many deleted keys can still be read."""
    left = chosen(after, keys)
    return before.agg(F.count("*").alias("rows_before")).select(
        "rows_before",
        after.agg(F.count("*")).scalar().alias("rows_after"),
        left.agg(F.count("*")).scalar().alias("still_present"),
    )


# --- scan ----------------------------------------------------------------


def _plain_text(path: str) -> Column:
    """A cell as text without an exponent: numbers from ten million on too have their digits written out."""
    text = F.col(path).cast("string")
    whole = F.concat(F.col(path).try_cast("decimal(38, 0)").cast("string"), F.lit(".0"))
    fraction = F.regexp_replace(F.col(path).try_cast("decimal(38, 17)").cast("string"), "0+$", "")
    return F.when(text.rlike("^-?[0-9.]+E[0-9]+$"), F.when(F.col(path).try_cast("double") % 1 == 0, whole).otherwise(fraction)).otherwise(text)


def cell_filter(path: str, op: str, value: object, compare: str = "numeric", keep_missing: bool = False) -> Column:
    """Compare a cell with a value, as numbers or byte by byte as text.

    Rows without the cell are left out unless `keep_missing` is set.
    """
    if compare == "bytes":
        test = COMPARE[op](_plain_text(path), F.lit(str(value)))
    elif compare == "numeric":
        test = COMPARE[op](F.col(path).try_cast("double"), F.lit(float(value)))
    else:
        raise ValueError(f"compare must be 'numeric' or 'bytes', not {compare!r}")
    return F.coalesce(test, F.lit(True)) if keep_missing else test


def cell_matches(path: str, pattern: str) -> Column:
    return F.col(path).cast("string").rlike(pattern)


def key_matches(pattern: str) -> Column:
    return F.col(KEY).rlike(pattern)


def literal_start(pattern: str) -> str:
    """What every match of a pattern starts with, as far as it is plain from the pattern."""
    if "|" in pattern or not (plain := re.match(r"\^([A-Za-z0-9_ \-]*)", pattern)):
        return ""
    rest = pattern[plain.end() :]
    # A quantifier rules over the last character.
    return plain[1][:-1] if rest[:1] in ("*", "?", "{") else plain[1]


def key_range(start: str | None = None, stop: str | None = None) -> Column:
    """Keys from `start` up to but without `stop`, in byte order."""
    test = F.lit(True)
    if start is not None:
        test &= F.col(KEY) >= start
    if stop is not None:
        test &= F.col(KEY) < stop
    return test


def key_prefix(prefix: str) -> Column:
    return F.col(KEY).startswith(prefix)


def with_prefix(table: DataFrame, prefix: str) -> DataFrame:
    return _folders(table, prefix=prefix).where(key_prefix(prefix))


def in_range(table: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    return _folders(table, start=start, stop=stop).where(key_range(start, stop))


def scan(
    table: DataFrame,
    *,
    start: str | None = None,
    stop: str | None = None,
    prefix: str | None = None,
    pattern: str | None = None,
    where: Column | None = None,
    columns: Sequence[str] | None = None,
    reverse: bool = False,
    limit: int | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Rows cut by key range, prefix, key pattern, condition and row limit.

    Rows come as they are stored, unless `ordered` or `reverse` asks for a sort of the whole
    result. With a limit they are the first in key order, and every task keeps that many.
    What a pattern starts with is used as a prefix, to skip files.
    """
    rows = in_range(table, start, stop) if start is not None or stop is not None else table
    if prefix is not None:
        rows = with_prefix(rows, prefix)
    if pattern is not None:
        begins = literal_start(pattern)
        rows = (with_prefix(rows, begins) if begins else rows).where(key_matches(pattern))
    if where is not None:
        rows = rows.where(where)
    if ordered or reverse or limit is not None:
        rows = rows.orderBy(F.col(KEY).desc() if reverse else F.col(KEY).asc())
    if limit is not None:
        rows = rows.limit(limit)
    return project(rows, columns) if columns else flatten(rows)


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("row_count"))
