"""Corpus pipeline: quality filter, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's `docs`.  All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerframe.llm import jaccard, mixing, packing, quality, trie_dedup
from offerframe.llm.common import fold_of, ship, table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject (labels of the held-out fifth are not learned from).

    Every row is scored by its text alone: NULL and empty texts alike, repeated rows and rows without an id too."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"), 0.3, usable=fold_of("doc_id", 5) != 0)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the longest original, of these the smallest id (no id: last).

    NULL and blank texts are one group.  Of rows that are equal in all that, exactly one stays."""
    ship(spark)
    return trie_dedup.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near duplicates: the smallest id.

    Rows without an id or without words link with nothing and stay; rows that share an id stay or go together."""
    ship(spark)
    return jaccard.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, by the target weights, no document twice.

    Rows without words (empty or NULL text) go; a NULL language or source is one of its own, ''; rows without an id
    are chosen like others, rows with one id in one leaf together."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 4096 tokens.

    An empty or NULL text is the end token alone; long texts are cut; every row is packed, repeated ids too."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# A learned classifier cannot be stated in SQL; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
