"""The command line runs the whole flow on hand-made stored pages."""

import os

from pyspark.sql import functions as F

from offerframe.__main__ import main
from offerframe.operators.bands import band_of_request
from offerframe.profiles import REFERENCE_BANDS, REFERENCE_SEARCH_BASE, band_request_suffix
from offerframe.sources import snapshots as SN

OFFER = ('<html><head><title>Flat</title></head><body><div data-cy="ad_title"><h4>Flat {i}</h4></div>'
         '<div data-testid="ad-price-container"><h3>{p}</h3></div></body></html>')


def test_band_of_request_inverts_request_builder(spark):
    urls = [(REFERENCE_SEARCH_BASE + band_request_suffix(b),) for b in REFERENCE_BANDS]
    df = spark.createDataFrame(urls + [("https://x/?q=1",)], "url string")
    got = [r.c for r in df.select(band_of_request(F.col("url"))["label"].alias("c")).collect()]
    assert got == [b.label for b in REFERENCE_BANDS] + [None]


def test_cli_flow(spark, tmp_root):
    b1, b2 = REFERENCE_BANDS[1], REFERENCE_BANDS[2]
    result_pages = [
        (1, REFERENCE_SEARCH_BASE + band_request_suffix(b1),
         '<a href="/d/oferta/a.html">a</a><a href="/d/oferta/b.html">b</a>'),
        (2, REFERENCE_SEARCH_BASE + band_request_suffix(b2), '<a href="/d/oferta/b.html">b</a>'),
    ]
    offer_pages = [(10, "https://www.olx.pl/d/oferta/a.html", OFFER.format(i=1, p="100")),
                   (11, "https://www.olx.pl/d/oferta/b.html", OFFER.format(i=2, p="200 zł"))]
    schema = "page_id long, url string, html string"
    rp, op = os.path.join(tmp_root, "results"), os.path.join(tmp_root, "offers_pages")
    spark.createDataFrame(result_pages, schema).write.parquet(rp)
    spark.createDataFrame(offer_pages, schema).write.parquet(op)
    maps, table = os.path.join(tmp_root, "maps"), os.path.join(tmp_root, "table")

    d = main(["discover", "--pages", rp, "--out", maps, "--stamp", "202401010000"])
    assert d["reconcile"]["n_links"] == 2 and d["reconcile"]["links_without_key"] == 0
    assert d["pages_without_slice"] == 0
    s = main(["extract", "--maps", maps, "--pages", op, "--table", table,
              "--quarantine", os.path.join(tmp_root, "q")])
    assert s["counts"]["offers"] == 2
    rows = {r.url: r for r in SN.read_snapshot(spark, table).collect()}
    assert rows["https://www.olx.pl/d/oferta/b.html"].category == b2.label  # later slice wins
    a = main(["analyse", "--table", table, "--out", os.path.join(tmp_root, "analysis")])
    assert "price_boxplot" in a["written"]


def test_cli_load_bucketed(spark, tmp_root):
    from offerframe.sources import offermap as OM
    links = spark.createDataFrame([("https://www.olx.pl/d/x.html", "-25")], "url string, category string")
    path = OM.write_offer_map(links, os.path.join(tmp_root, "maps"), "202401010000")
    table = os.path.join(tmp_root, "table")
    r = main(["load", "--map", path, "--table", table, "--table-name", "offers_cli_test", "--buckets", "4"])
    assert r["version"] == 1
    assert SN.read_bucketed(spark, table, "offers_cli_test").count() == 1
