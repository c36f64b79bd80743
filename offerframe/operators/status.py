"""Page state: dead (title markers), expired (notice element), live."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import Selector
from ..profiles import PageRules
from .elements import ELEMENTS, fragment_text, has_element, select_element, with_elements


def is_dead(title: Column, markers) -> Column:
    """Case-sensitive literal markers in the title; an empty title is live."""
    if not markers:
        return F.lit(False)
    t = F.coalesce(title, F.lit(""))
    return reduce(lambda a, b: a | b, [t.contains(m) for m in markers])


def is_expired(els: Column, html: Column, notice: Selector) -> Column:
    """The inactive-notice element is present, whatever its text."""
    return has_element(els, html, notice)


def page_state(dead: Column, expired: Column) -> Column:
    """P3 gate order: dead first, then expired, else live."""
    return (F.when(dead, F.lit("dead"))
             .when(expired, F.lit("expired"))
             .otherwise(F.lit("live")))


def classify_pages(pages: DataFrame, rules: PageRules, keep=("page_id", "url"),
                   html_col: str = "html") -> DataFrame:
    """P1-P3 over pages: (keep..., title, is_dead, is_expired, status)."""
    own = with_elements(pages.select(*keep, F.col(html_col).alias("_html")), "_html")
    els, html = F.col(ELEMENTS), F.col("_html")
    staged = own.select(*keep, "_html", select_element(els, html, Selector("title")).alias("_title"),
                        is_expired(els, html, rules.expired).alias("is_expired"))
    flagged = staged.select(*keep, fragment_text(html, F.col("_title")).alias("title"), "is_expired")
    flagged = flagged.withColumn("is_dead", is_dead(F.col("title"), rules.dead_title_markers))
    return flagged.withColumn("status", page_state(F.col("is_dead"), F.col("is_expired")))
