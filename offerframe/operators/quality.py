"""Completeness of the offers data.

Share of values per column that are real values (not NULL, blank or one
of the sentinel texts), overall and per website, in one aggregate with
ROLLUP (the row with `website` NULL is the overall one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_present

MEASURED = ("category", "offer_id", "price", "offer_title", "location", "active")


def completeness(offers: DataFrame, by: str = "website", columns=MEASURED,
                 digits: int = 4) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_offers")]
    for c in columns:
        share = F.avg(F.when(is_present(F.col(c)), 1.0).otherwise(0.0))
        aggs.append(F.round(share, digits).alias(f"{c}_complete"))
    return offers.rollup(by).agg(*aggs)
