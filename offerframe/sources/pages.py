"""Stored pages (S10): the input that replaces fetching live sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import PAGES


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages, as many tasks as the scan has splits.  Parsing is CPU
    work: for more tasks lower `spark.sql.files.maxPartitionBytes` or store
    smaller row groups; pages are never dealt out anew."""
    return spark.read.schema(PAGES).parquet(path)
