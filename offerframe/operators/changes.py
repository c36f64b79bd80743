"""Changes of a merge, and counts kept up to date by them.

A merge into a bucketed table knows its touched rows before and after
(`sources.buckets.Merged`).  Their difference, one row per changed url with both
images, is all that counts have to be corrected by: the old image counts -1, the
new one +1.  So counts after a merge cost what the merge touched, not a scan of
the table, and equal a full recount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_present
from ..schema import VALUE_COLUMNS
from .quality import MEASURED

COUNTED = ("category", "website")
COUNTS = "measure string, value string, n long"


def change_feed(before: DataFrame, after: DataFrame, key: str = "url", columns=VALUE_COLUMNS) -> DataFrame:
    """(key, before, after): both images of every row that was inserted, changed or removed (no image: NULL)."""
    image = lambda df, name: df.select(key, F.struct(*columns).alias(name))
    both = image(before, "before").join(image(after, "after"), key, "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def signed_images(feed: DataFrame) -> DataFrame:
    """One row per image: its columns and `sign`, -1 for the old one and 1 for the new one."""
    both = F.array(F.struct(F.col("before").alias("image"), F.lit(-1).alias("sign")),
                   F.struct(F.col("after").alias("image"), F.lit(1).alias("sign")))
    one = feed.select(F.explode(both).alias("e")).where(F.col("e.image").isNotNull())
    return one.select("e.image.*", "e.sign")


def count_changes(images: DataFrame, counted=COUNTED, measured=MEASURED, by: str = "website") -> DataFrame:
    """(measure, value, n) of signed rows: rows per value of the `counted` columns, and per `by` the rows with
    a real value in each of the `measured` columns.  One partial aggregate."""
    rows = [F.struct(F.lit(c).alias("measure"), F.col(c).alias("value"), F.col("sign").alias("n")) for c in counted]
    rows += [F.struct(F.lit(f"{c}_present").alias("measure"), F.col(by).alias("value"),
                      F.when(is_present(F.col(c)), F.col("sign")).otherwise(F.lit(0)).alias("n")) for c in measured]
    one = images.select(F.explode(F.array(*rows)).alias("e")).select("e.*").where(F.col("value").isNotNull())
    return one.groupBy("measure", "value").agg(F.sum("n").cast("long").alias("n"))


def recount(table: DataFrame) -> DataFrame:
    """All counts of a table, from a full scan."""
    return count_changes(table.withColumn("sign", F.lit(1))).where("n <> 0")


def add_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts corrected by signed changes; counts that become 0 go."""
    return counts.unionByName(changes).groupBy("measure", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def completeness_of(counts: DataFrame, measured=MEASURED, digits: int = 4) -> DataFrame:
    """A7 from counts: the same rows as `quality.completeness`, per website and overall."""
    wide = counts.where((F.col("measure") == "website") | F.col("measure").endswith("_present")).groupBy("value").agg(
        F.sum(F.when(F.col("measure") == "website", F.col("n"))).alias("n_offers"),
        *[F.sum(F.when(F.col("measure") == f"{c}_present", F.col("n"))).alias(c) for c in measured])
    total = wide.rollup(F.col("value").alias("website")).agg(
        F.sum("n_offers").alias("n_offers"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measured])
    return total.select("website", "n_offers", *[F.round(F.col(c) / F.col("n_offers"), digits).alias(f"{c}_complete") for c in measured])
