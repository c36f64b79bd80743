"""Offer extraction from stored pages (P4-P13) with a quarantine.

One chain over the page rows: number the page's elements once, decide the page
state, route the URL to a site profile and pull the fields with the
profile's selectors from the elements (`operators.elements`).  Every input page yields exactly one row: a record
(`reason` NULL) or a quarantined row with its reason.  Nothing here
shuffles; `html` is dropped as soon as the fields are out.

Check order follows the original tool: website from the URL first (no
`www.` -> quarantine), then dead, then expired (both emit a fresh default
record, so nothing leaks from the previous page), then the site router
(unknown site -> quarantine), then the fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import Selector
from ..functions.text import split_after, website_from_url
from ..profiles import PageRules
from ..schema import ACTIVE_NO, NOT_FOUND, OFFER_COLUMNS, UNKNOWN
from ..session import shared_dir
from . import bloom
from .elements import ELEMENT, ELEMENTS, fragment_text, select_element, with_elements
from .merge import latest_per_key
from .status import is_dead, is_expired, page_state

FIELDS = ("offer_id", "price", "offer_title", "location")

# quarantine reasons
EMPTY_PAGE = "empty page"
NO_WEBSITE = "no www. in url"
UNKNOWN_SITE = "unknown site"
NO_PAGE = "page missing"


def route(url: Column, rules: PageRules) -> Column:
    """P5: first profile whose token is in the URL; NULL when none."""
    out = None
    for p in rules.profiles:
        cond = url.contains(p.url_contains)
        out = F.when(cond, F.lit(p.site)) if out is None else out.when(cond, F.lit(p.site))
    return out if out is not None else F.lit(None).cast("string")


def _by_site(site: Column, rules: PageRules, name: str, make, kind="string") -> Column:
    """CASE over the routed site: the value `make(rule)` of that site's rule
    for field `name` (NULL when the site has none)."""
    out = None
    for p in rules.profiles:
        rule = next((f for f in p.fields if f.name == name), None)
        expr = make(rule) if rule is not None else F.lit(None).cast(kind)
        out = F.when(site == p.site, expr) if out is None else out.when(site == p.site, expr)
    return out if out is not None else F.lit(None).cast(kind)


def parse_pages(pages: DataFrame, rules: PageRules, category: Column | None = None,
                keep=("page_id",), html_col: str = "html") -> DataFrame:
    """(keep..., url, category, website, offer_id, price, offer_title,
    location, active, status, reason).

    Staged projections: the page's elements are numbered once, and a field's
    selector runs only for the site the URL routes to and only on a live page.
    """
    category = category if category is not None else F.lit(UNKNOWN)
    keep = list(keep)
    pages = pages.select(*keep, "url", category.alias("category"), F.col(html_col).alias("_html"))
    els, html = F.col(ELEMENTS), F.col("_html")
    s1 = with_elements(pages, "_html")
    s2 = s1.select(
        "*",
        (html.isNull() | (F.trim(html) == "")).alias("_empty"),
        website_from_url(F.col("url"), rules.tld_token).alias("website"),
        select_element(els, html, Selector("title")).alias("_title_el"),
        is_expired(els, html, rules.expired).alias("_expired"),
        route(F.col("url"), rules).alias("_site"))
    s3 = s2.select("*", fragment_text(html, F.col("_title_el")).alias("_title")).drop("_title_el")
    status = page_state(is_dead(F.col("_title"), rules.dead_title_markers), F.col("_expired"))
    reason = (F.when(F.col("_empty"), F.lit(EMPTY_PAGE))
               .when(F.col("website").isNull(), F.lit(NO_WEBSITE))
               .when(F.col("_state") != "live", F.lit(None).cast("string"))
               .when(F.col("_site").isNull(), F.lit(UNKNOWN_SITE)))
    s3 = s3.withColumn("_state", status).withColumn("reason", reason)
    s3 = (s3.withColumn("_ok", F.col("reason").isNull())
            .withColumn("_live", (F.col("_state") == "live") & F.col("_ok")))

    site, live = F.col("_site"), F.col("_live")
    s4 = s3.select("*", *[
        F.when(live, _by_site(site, rules, n, lambda r: select_element(els, html, r.selector), ELEMENT))
         .alias(f"_el_{n}") for n in FIELDS]).drop(ELEMENTS)
    s5 = s4.select("*", *[fragment_text(html, F.col(f"_el_{n}")).alias(f"_txt_{n}") for n in FIELDS])
    s5 = s5.drop("_html", *[f"_el_{n}" for n in FIELDS])

    def piece(n):
        txt = F.col(f"_txt_{n}")
        return _by_site(site, rules, n,
                        lambda r: split_after(txt, r.post_split) if r.post_split else txt)

    ok = F.col("_ok")
    active = F.when(ok & ~live, F.lit(ACTIVE_NO))
    for p in rules.profiles:
        active = active.when(live & (site == p.site), F.lit(p.active_text))
    return s5.select(
        *keep, "url",
        F.when(ok, F.col("category")).alias("category"),
        F.when(ok, F.col("website")).alias("website"),
        *[F.when(live, F.coalesce(piece(n), F.lit(NOT_FOUND))).when(ok, F.lit(UNKNOWN)).alias(n)
          for n in FIELDS],
        active.alias("active"),
        F.when(ok, F.col("_state")).otherwise(F.lit("quarantine")).alias("status"),
        "reason")


def parse_metrics() -> list[Column]:
    """Result counts as aggregate expressions for `DataFrame.observe`."""
    status, reason = F.col("status"), F.col("reason")
    return [F.count(F.lit(1)).alias("pages"),
            F.count(F.when(reason.isNull(), 1)).alias("offers"),
            F.count(F.when(status == "live", 1)).alias("live"),
            F.count(F.when(status == "dead", 1)).alias("dead"),
            F.count(F.when(status == "expired", 1)).alias("expired"),
            F.count(F.when(reason.isNotNull(), 1)).alias("quarantined")]


def offers_only(parsed: DataFrame) -> DataFrame:
    """Good records in table order (read from a written parsed frame)."""
    return parsed.filter(F.col("reason").isNull()).select(*OFFER_COLUMNS)


def quarantine_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("url", "reason")


def wanted_pages(links: DataFrame, pages: DataFrame, params: bloom.Params = bloom.Params()) -> DataFrame:
    """The pages worth parsing: of each url in the map the latest stored one, and few others.

    Their keys come from narrow columns, are written once and counted; a Bloom
    filter of that size goes to the scan, whatever their number, and pages are
    probed where they lie, before anything is done with their html.  The join of
    the parsed records in `offer_pages` is exact."""
    spark = pages.sparkSession
    keys = (pages.select("url", "page_id").join(links.select("url").distinct(), "url", "left_semi")
            .groupBy("url").agg(F.max("page_id").alias("page_id")))
    path = shared_dir(spark, "wanted-pages")
    keys.write.parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    blocks = bloom.blocks_for(keys.count(), params)
    return bloom.probe(pages, ["url", "page_id"], bloom.build(keys, ["url", "page_id"], blocks), blocks)


def offer_pages(links: DataFrame, pages: DataFrame, rules: PageRules) -> DataFrame:
    """P12 driven by a link map (url, category): parse the wanted pages
    (narrow output, no `html` in any shuffle), then join the narrow records
    to the link map on url.  Links without a stored page are quarantined as
    `page missing`; pages that are not in the map are not returned; of a
    URL stored several times the latest page (greatest `page_id`, of equal ones
    the greatest hash of the html) counts."""
    stored = pages.select("page_id", "url", "html", F.xxhash64("html").alias("_copy"))
    parsed = parse_pages(wanted_pages(links, stored), rules, keep=("page_id", "_copy"))
    parsed = parsed.drop("category")
    # One record per URL (the latest stored page) before the join: a URL
    # stored many times is collapsed map-side, so the join is one-to-one.
    parsed = latest_per_key(parsed, "url", ["page_id", "_copy"],
                            columns=[c for c in parsed.columns if c not in ("url", "_copy")])
    joined = links.select("url", F.col("category").alias("_cat")).join(parsed, "url", "left")
    missing = F.col("page_id").isNull()
    ok = F.col("reason").isNull() & ~missing
    return joined.select(
        "page_id", "url",
        F.when(ok, F.coalesce(F.col("_cat"), F.lit(UNKNOWN))).alias("category"),
        *[F.when(~missing, F.col(c)).alias(c) for c in
          ("website", "offer_id", "price", "offer_title", "location", "active")],
        F.when(missing, F.lit("quarantine")).otherwise(F.col("status")).alias("status"),
        F.when(missing, F.lit(NO_PAGE)).otherwise(F.col("reason")).alias("reason"),
    )
