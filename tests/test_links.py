"""Link discovery L1-L8, L13 on hand-made result pages."""

from pyspark.sql import functions as F

from offerframe.operators import links as L
from offerframe.plans import jobs
from offerframe.profiles import REFERENCE_LINK_RULES
from offerframe.sources import linkfiles as LF
from offerframe.sources import offermap as OM

PAGE = ('<div><a href="/d/oferta/a.html">a</a>'
        '<a class="x" href="https://www.otodom.pl/pl/oferta/b.html">b</a>'
        '<a href="https://www.olx.pl/d/oferta/c.html">base host absolute</a>'
        '<a href="https://elsewhere.pl/d.html">other host</a>'
        '<a href="/d/oferta/e.html?reason=x">query tail</a>'
        '<a name="no-href">none</a>'
        '<script>var s = \'<a href="/d/in-script.html">\';</script></div>')


def test_anchor_rules(spark):
    pages = spark.createDataFrame([(1, "https://www.olx.pl/s", PAGE)], "page_id long, url string, html string")
    anchors = L.extract_anchors(pages)
    hrefs = [r.href for r in anchors.collect()]
    assert "/d/in-script.html" not in hrefs and len(hrefs) == 5
    links = sorted(r.link for r in L.absolute_links(anchors, REFERENCE_LINK_RULES).collect())
    assert links == ["https://www.olx.pl/d/oferta/a.html", "https://www.otodom.pl/pl/oferta/b.html"]


def test_union_keeps_duplicates_then_distinct_sorts(spark):
    html = '<a href="/z.html">1</a><a href="/z.html">2</a><a href="/a.html">3</a>'
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    links = L.absolute_links(L.extract_anchors(pages), REFERENCE_LINK_RULES)
    assert links.count() == 3
    assert [r.url for r in L.distinct_links(links, sort=True).collect()] == \
        ["https://www.olx.pl/a.html", "https://www.olx.pl/z.html"]


def tagged_rows(spark):
    rows = [("u1", "25-40", 1), ("u1", "40-50", 2), ("u2", "-25", 0),
            ("u1", "25-40", 1), ("u3", "150-", 9), ("u3", "-25", 0)]
    return spark.createDataFrame(rows, "url string, category string, ord int")


def test_overlay_last_slice_wins(spark):
    out = {r.url: r.category for r in L.overlay_last_wins(tagged_rows(spark)).collect()}
    assert out == {"u1": "40-50", "u2": "-25", "u3": "150-"}


def test_overlay_independent_of_partitions_and_order(spark):
    t = tagged_rows(spark)
    a = sorted(L.overlay_last_wins(t).collect())
    b = sorted(L.overlay_last_wins(t.orderBy(F.desc("ord")).repartition(5)).collect())
    assert a == b


def test_dedupe_in_slice(spark):
    assert L.dedupe_in_slice(tagged_rows(spark)).count() == 5


def test_reconcile_counts(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "url string")
    b = spark.createDataFrame([("y",), ("z",)], "url string")
    r = L.reconcile(a, b).first()
    assert (r.n_links, r.n_keys, r.links_without_key, r.keys_without_link) == (2, 2, 1, 1)


def test_discover_links_job(spark, tmp_root):
    pages = spark.createDataFrame(
        [("https://www.olx.pl/s1", PAGE, "25-40", 1),
         ("https://www.olx.pl/s2", '<a href="/d/oferta/a.html">again</a>', "40-50", 2)],
        "url string, html string, slice string, slice_ord int")
    out = jobs.discover_links(pages, REFERENCE_LINK_RULES, tmp_root, "202401010000")
    r = out["reconcile"].first()
    assert r.links_without_key == 0 and r.keys_without_link == 0 and r.n_links == 2
    _, lst = LF.read_newest_links(spark, tmp_root)
    assert [x.url for x in lst.collect()] == sorted(x.url for x in lst.collect())
    m = {x.url: x.size_category for x in OM.read_offer_map(spark, out["offers"]).collect()}
    assert m["https://www.olx.pl/d/oferta/a.html"] == "40-50"  # later slice wins


def test_null_html_and_url_yield_no_links(spark):
    pages = spark.createDataFrame([(1, None, "<a href='/x.html'>x</a>"), (2, "https://h/p", None)],
                                  "page_id long, url string, html string")
    links = L.absolute_links(L.extract_anchors(pages), REFERENCE_LINK_RULES).collect()
    assert [r.link for r in links] == ["https://www.olx.pl/x.html"]


def test_hrefs_of_every_form(spark):
    html = ("""<a data-href="/no.html" href="/o'hara.html">1</a><a href='/q"uote.html'>2</a><a href=/plain.html>3</a>"""
            """<A HREF = "/spaced.html" class=x>4</A><a href="/a?x=1&amp;y=2">5</a><abbr href="/no">6</abbr><a name="x">7</a>"""
            """<a href="">8</a>""")
    page = spark.createDataFrame([(1, "https://h/", html)], "page_id long, url string, html string")
    got = [r.href for r in L.extract_anchors(page).collect()]
    assert got == ["/o'hara.html", '/q"uote.html', "/plain.html", "/spaced.html", "/a?x=1&y=2", ""]
