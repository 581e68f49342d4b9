"""The corpus pipeline: toxic documents out, copies out, near copies out, sources mixed, texts encoded.

Each stage takes the documents that the one before it kept, and returns rows of the same
columns; the last returns the ids of the texts' pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hackney.llm import exact_dedup, mixing, near_dedup, pieces, registry, toxicity
from hackney.sources.scratch import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; labels come from the labels table."""
    return toxicity.drop_toxic(docs, registry.table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the least id stays."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document: doc_id, ids, n_ids, lossless."""
    return pieces.encode(docs, registry.PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# A conditional random field, signatures and piece merging are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = registry.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"corpus-{name.split()[0].lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
