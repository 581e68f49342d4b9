"""Exact dedup by 128-bit content hash, with the texts compared inside groups.

Texts are grouped by hash and by their own bytes, so two texts that share a hash
stay apart. Copies collapse in the tasks that read them: of a text with a third
of all rows each task sends one row.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.frames import pick


def normalised(text: Column) -> Column:
    """Lower case for A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def content_keys(normal: Column) -> list[Column]:
    """The 128-bit hash that groups, and the digest that names a class of equal texts."""
    return [F.unhex(F.md5(normal)).alias("hash"), F.sha2(normal, 256).alias("digest")]


def text_classes(rows: DataFrame) -> DataFrame:
    """One row per different text of rows (id, normal): hash, digest, keep_id, group_size."""
    grouped = rows.groupBy(F.unhex(F.md5("normal")).alias("hash"), "normal").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return grouped.select("hash", F.sha2("normal", 256).alias("digest"), "keep_id", "group_size")


def find_copies(documents: DataFrame) -> DataFrame:
    """The class of each document: doc_id, keep_id, group_size, kept, text_sha256.

    One row per row of `documents`, dropped ones too. Of equal texts the one with the
    largest doc_id stays; a null doc_id is below all others, and stays only where all
    ids of its text are null. Rows that repeat both id and text are one document and
    get the same verdict. Null and empty texts are equal. Other columns are ignored; an
    empty table gives an empty table.
    """
    rows = pick(documents, "doc_id", "text").select(F.col("doc_id").alias("id"), normalised(F.col("text")).alias("normal"))
    classes = text_classes(rows)
    keyed = rows.select("id", *content_keys(F.col("normal")))
    return keyed.join(classes, ["hash", "digest"]).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(documents: DataFrame) -> DataFrame:
    """The documents that stay, one row per different text, all columns as they were.

    The join that picks them is by text and id, so that no task gathers the copies of
    a text, and a row that repeats both is dropped where the join has put it.
    """
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    normal = normalised(F.col(text))
    classes = text_classes(plain.select(F.col(doc_id).alias("id"), normal.alias("normal")))
    # A null id is given as a word, so that the join and the grouping agree on it.
    told = [F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("id")]
    kept = classes.select("hash", "digest", F.coalesce(F.col("keep_id").cast("string"), F.lit("null")).alias("id"))
    keys = ["hash", "digest", "id"]
    chosen = plain.select("*", *content_keys(normal), *told).join(kept, keys, "left_semi").dropDuplicates(keys)
    return chosen.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])
