"""Link lists: one URL per line, sorted and distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs

PREFIX = "links_"


def write_link_list(links: DataFrame, root: str, stamp: str, link_col: str = "url") -> str:
    """Distinct links, sorted (range-partitioned sort, so part files are
    in order and no task holds the whole list) under `links_<stamp>`."""
    path = f"{root.rstrip('/')}/{PREFIX}{stamp}"
    (links.select(F.col(link_col).alias("value")).filter(F.col("value").isNotNull())
     .distinct().sort("value").write.mode("overwrite").text(path))
    return path


def read_link_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("url"))


def read_newest_links(spark: SparkSession, root: str) -> tuple[str, DataFrame]:
    """The newest link list under `root` (ties -> greatest path).
    An empty folder raises FileNotFoundError."""
    entries = [e for e in fs.list_entries(spark, root) if e.name.startswith(PREFIX)]
    pick = fs.newest(entries)
    return pick.path, read_link_list(spark, pick.path)
