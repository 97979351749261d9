"""Corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join, source mix, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes each stage's rows as Parquet in the shared checkpoint folder and reads
them again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dispatchkit.llm import exact_dedup, jaccard_join, mixing, packing, quality
from dispatchkit.llm.common import materialize, read_table
from dispatchkit.llm.queries import vocabulary

TOKENIZER, END_ID = "byte_bpe_50k.json", 0


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text (the smallest id)."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate component (the smallest id)."""
    return jaccard_join.one_per_component(docs)


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the source mix uses them (a document may appear twice)."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed token sequences, with their ids."""
    return packing.pack(docs, vocabulary(TOKENIZER), END_ID)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_by_source),
    ("packing", pack_sequences),
]

#: Training, tokenizer and packing have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
