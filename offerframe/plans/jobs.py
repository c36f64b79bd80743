"""End-to-end jobs: link discovery, offer extraction, map loading, analysis.

Each job reads and writes through the sources, so intermediate results land
in shared storage (cutting lineage, surviving executor loss) instead of
being recomputed or passed through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_TLD_TOKEN
from ..operators import extract as X
from ..operators import links as L
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import stats as A
from ..profiles import LinkRules, PageRules
from ..sources import buckets as BK
from ..sources import linkfiles as LF
from ..sources import offermap as OM
from ..sources import snapshots as SN


def discover_links(result_pages: DataFrame, rules: LinkRules, out_root: str, stamp: str,
                   slice_col: str = "slice", ord_col: str = "slice_ord") -> dict:
    """Entry A: result pages carrying their slice -> link list + offer map.

    The absolute links are written once (narrow rows) and both outputs and
    the reconciliation read that, so the pages are scanned once.
    """
    spark = result_pages.sparkSession
    root = out_root.rstrip("/")
    anchors = L.extract_anchors(result_pages, keep=("url", slice_col, ord_col))
    links = L.absolute_links(anchors, rules, keep=(slice_col, ord_col))
    work = f"{root}/_work/links_{stamp}"
    links.write.mode("overwrite").parquet(work)
    links = spark.read.parquet(work)
    tagged = links.select(F.col("link").alias("url"), F.col(slice_col).alias("category"),
                          F.col(ord_col).alias("ord"))
    list_path = LF.write_link_list(links, root, stamp, link_col="link")
    map_path = OM.write_offer_map(L.overlay_last_wins(tagged), root, stamp)
    check = L.reconcile(LF.read_link_list(spark, list_path), OM.read_offer_map(spark, map_path))
    return {"links": list_path, "offers": map_path, "reconcile": check, "stamp": stamp}


def _base(spark, table_root, records, bucketed):
    """The rows of the current version that a merge of `records` can touch."""
    if bucketed:
        return SN.read_bucketed(spark, table_root, bucketed[0]), None
    base = BK.touched_base(spark, table_root, records)
    return base.df, base


def _write(merged, table_root, base, bucketed):
    if bucketed:
        return SN.write_bucketed(merged, table_root, bucketed[0], bucketed[1])
    return BK.write_merged(merged, base).version


def extract_offers(spark: SparkSession, map_root: str, pages: DataFrame, rules: PageRules,
                   table_root: str, quarantine_root: str,
                   bucketed: tuple[str, int] | None = None) -> dict:
    """Entry B on stored pages: newest offer map -> parse pages -> upsert.

    The parsed frame is written before it is split into offers and
    quarantine (a filter on extracted fields would repeat the cleaning).
    Only the buckets that the offers fall into are read and rewritten (see
    `sources.buckets`).  `bucketed=(name, buckets)` keeps table versions as catalog
    tables bucketed by url instead (`sources.snapshots.write_bucketed`): the
    upsert then leaves the table where it lies and shuffles only the new records.
    """
    map_path, offer_map = OM.read_newest_offer_map(spark, map_root)
    links = offer_map.select("url", F.col("size_category").alias("category"))
    parsed = X.offer_pages(links, pages, rules)
    work = f"{quarantine_root.rstrip('/')}/parsed_{uuid.uuid4().hex[:12]}"
    # Counts gathered while the parsed frame is written (no extra pass).
    counts = Observation("parse_counts")
    parsed.observe(counts, *X.parse_metrics()).write.mode("overwrite").parquet(work)
    parsed = spark.read.parquet(work)
    good = parsed.filter(F.col("reason").isNull())
    rows, base = _base(spark, table_root, good, bucketed)
    version = _write(M.upsert_overwrite(rows, good, "page_id"), table_root, base, bucketed)
    return {"map": map_path, "version": version, "parsed": work, "counts": counts.get,
            "quarantine": X.quarantine_only(parsed)}


def rejects_path(table_root: str, version: int) -> str:
    """Where the rows kept out of a version are, with their reasons."""
    return f"{table_root.rstrip('/')}/_rejects/load/{SN.version_name(version)}"


def load_offer_map(spark: SparkSession, map_path: str, table_root: str,
                   policy: str = "fill_unknown", bucketed: tuple[str, int] | None = None,
                   tld_token: str = DEFAULT_TLD_TOKEN) -> int:
    """Read an offer map and merge it into the table (M2 or M3).

    Input the table cannot take -- text that is no entry, new urls without a
    website -- is written to `rejects_path` (raw, url, reason).
    `bucketed=(name, buckets)` keeps versions as catalog tables bucketed by
    url, so the merge shuffles only the offer map, not the table."""
    offer_map = OM.open_offer_map(spark, map_path)
    rows, base = _base(spark, table_root, offer_map.rows, bucketed)
    merge = M.merge_fill_unknown if policy == "fill_unknown" else M.merge_conditional
    merged = merge(rows, offer_map.rows, "seq", tld_token).drop("change")
    version = _write(merged, table_root, base, bucketed)
    texts = offer_map.rejects.select("raw", F.lit(None).cast("string").alias("url"), "reason")
    keys = (M.merge_rejects(rows, offer_map.rows, "seq", tld_token)
            .select(F.lit(None).cast("string").alias("raw"), "url", "reason"))
    texts.unionByName(keys).write.mode("overwrite").parquet(rejects_path(table_root, version))
    return version


def analyse(offers: DataFrame) -> dict[str, DataFrame]:
    """Entry C: the data behind every chart, plus completeness."""
    priced = A.with_price_numeric(offers)
    clean = A.numeric_only(priced)
    return {
        "category_counts": A.value_counts(offers, "category"),
        "website_counts": A.value_counts(offers, "website"),
        "price_boxplot": A.boxplot(clean, "category", "price_numeric", tiebreak="url"),
        "price_gate": A.plot_gate(priced, "category", "price_numeric"),
        "completeness": Q.completeness(offers),
    }
