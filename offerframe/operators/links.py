"""Link discovery: anchors -> offer links -> tagged, overlaid link map.

Everything is a projection or filter over the page rows except the
distinct (L6), the per-slice de-duplication (L7) and the last-wins overlay
(L8), which shuffle only the narrow `(url, category, ord)` rows -- the
`html` column never crosses a shuffle.  L8 is a partial (map-side)
aggregate, so a URL found in every slice is collapsed before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import clean_html, unescape
from ..functions.text import base_of_url
from ..profiles import LinkRules

_SP = r"[ \t\r\n\f]"
# An anchor's tag up to the end of its href value, which is the group: the attribute itself (not data-href), in any quoting.
ANCHOR_PATTERN = (rf"""(?is)<a(?:{_SP}[^>]*?)?{_SP}href{_SP}*={_SP}*("[^">]*"|'[^'>]*'|[^ \t\r\n\f>"']+)""")


def extract_anchors(pages: DataFrame, keep=("page_id", "url"), html_col: str = "html") -> DataFrame:
    """L1 as rows: every `href` of every anchor on cleaned markup, entities
    decoded, one row per anchor next to the page columns.

    Quotes and entities are dealt with after the rows are made, in generated code, not inside an array."""
    values = F.regexp_extract_all(clean_html(F.col(html_col)), F.lit(ANCHOR_PATTERN), F.lit(1))
    rows = pages.select(*keep, F.explode(values).alias("_value"))
    return rows.select(*keep, unescape(F.regexp_replace("_value", "^[\"']|[\"']$", "")).alias("href"))


def offer_link(href: Column, page_url: Column, rules: LinkRules) -> Column:
    """L2-L4 for one href: the absolute offer link, or NULL when dropped."""
    base = F.lit(rules.base) if rules.base else base_of_url(page_url)
    relative = href.startswith("/")
    partner = reduce(lambda a, b: a | b,
                     [href.startswith(p) for p in rules.allowed_prefixes], F.lit(False))
    link = F.when(relative, F.concat(base, href)).when(partner, href)
    return F.when(href.isNotNull() & href.endswith(rules.suffix), link)


def absolute_links(anchors: DataFrame, rules: LinkRules, keep=("page_id",),
                   href_col: str = "href", page_url_col: str = "url") -> DataFrame:
    """Keep suffix matches, absolutise relative links, keep partner
    links; both lists end up in one frame with duplicates kept (UNION ALL)."""
    link = offer_link(F.col(href_col), F.col(page_url_col), rules)
    return (anchors.select(*keep, link.alias("link"))
            .filter(F.col("link").isNotNull()))


def distinct_links(links: DataFrame, link_col: str = "link", sort: bool = False) -> DataFrame:
    """Distinct links; `sort=True` for the code-point order of the link file."""
    out = links.select(F.col(link_col).alias("url")).distinct()
    return out.sort("url") if sort else out


def tag_links(links: DataFrame, category: str, ord_: int, link_col: str = "link") -> DataFrame:
    """L7 for one slice: a constant tag, so first occurrence wins = DISTINCT."""
    return (links.select(F.col(link_col).alias("url"))
            .distinct()
            .withColumn("category", F.lit(category))
            .withColumn("ord", F.lit(ord_)))


def dedupe_in_slice(tagged: DataFrame) -> DataFrame:
    """L7 over many slices at once."""
    return tagged.dropDuplicates(["url", "category"])


def overlay_last_wins(tagged: DataFrame, url_col: str = "url",
                      category_col: str = "category", ord_col: str = "ord") -> DataFrame:
    """A URL seen in several slices keeps the tag of the last slice.

    `max_by` on the explicit slice order, never on row order; partial
    aggregation collapses hot URLs before the shuffle.
    """
    return (tagged.groupBy(url_col)
            .agg(F.max_by(F.col(category_col), F.col(ord_col)).alias(category_col)))


def reconcile(links: DataFrame, keys: DataFrame, link_col: str = "url",
              key_col: str = "url") -> DataFrame:
    """A real two-way check between a link set and map keys.

    One full outer join of the two distinct sets (a single shuffle of each
    side) and one global count; returns a single row.
    """
    a = links.select(F.col(link_col).alias("_k")).distinct().withColumn("_in_links", F.lit(True))
    b = keys.select(F.col(key_col).alias("_k")).distinct().withColumn("_in_keys", F.lit(True))
    both = a.join(b, "_k", "full_outer")
    return both.agg(
        F.count(F.col("_in_links")).alias("n_links"),
        F.count(F.col("_in_keys")).alias("n_keys"),
        F.count(F.when(F.col("_in_keys").isNull(), 1)).alias("links_without_key"),
        F.count(F.when(F.col("_in_links").isNull(), 1)).alias("keys_without_link"),
    )


def link_map(pages: DataFrame, rules: LinkRules, slice_col: str, ord_col: str) -> DataFrame:
    """Whole link job on result pages that carry their slice: L1-L8.

    `pages` has (url, html, <slice label>, <slice ord>); returns (url, category).
    """
    anchors = extract_anchors(pages, keep=("url", slice_col, ord_col))
    links = absolute_links(anchors, rules, keep=(slice_col, ord_col))
    tagged = links.select(F.col("link").alias("url"),
                          F.col(slice_col).alias("category"), F.col(ord_col).alias("ord"))
    return overlay_last_wins(tagged)
