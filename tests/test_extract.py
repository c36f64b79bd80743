"""Page state, routing and field extraction, including the traps T1-T5, T10."""

from pyspark.sql import functions as F

from offerframe.operators import bloom
from offerframe.operators import extract as X
from offerframe.operators import status as S
from offerframe.profiles import (REFERENCE_PAGE_RULES, SYNTHETIC_PAGE_RULES)

BASE = "https://www.olx.pl/d/oferta/"
PARTNER = "https://www.otodom.pl/pl/oferta/"


def live_base(i, price="450 000 zł", title="Flat", ident="ID: 123"):
    return (f"<html><head><title>{title} | site</title></head><body>"
            f'<div data-cy="ad_title"><h4>{title}</h4></div>'
            f'<div data-testid="ad-price-container"><h3>{price}</h3></div>'
            '<div id="mainContent"><div><div>1</div><div><div>1</div><div>2</div><div><div>1</div><div><div>1</div><div><div>'
            '<section><div><div><p>Mokotów, Warszawa</p><p>other</p></div></div></section>'
            '</div></div></div></div></div></div></div>'
            f'<div data-testid="ad-footer-bar-section"><span>{ident}</span><span>x</span></div>'
            "</body></html>")


def live_partner(title="Partner flat"):
    return (f"<html><head><title>{title}</title></head><body>"
            f'<h1 data-cy="adPageAdTitle">{title}</h1>'
            '<strong aria-label="Cena">900 000 zł</strong>'
            '<div id="map"><div>ul. Prosta, Wola</div></div>'
            "<p>ID: 555</p></body></html>")


EXPIRED = ('<html><head><title>Old flat</title></head><body>'
           '<div data-testid="ad-inactive-msg"><h4>any text at all</h4></div></body></html>')


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def parsed(spark, rows, rules=REFERENCE_PAGE_RULES):
    return {r["page_id"]: r for r in X.parse_pages(pages(spark, rows), rules).collect()}


def test_live_pages_of_both_sites(spark):
    out = parsed(spark, [(1, BASE + "a.html", live_base(1)), (2, PARTNER + "b", live_partner())])
    a, b = out[1], out[2]
    assert (a.website, a.offer_id, a.price, a.offer_title, a.location, a.active, a.status) == \
        ("olx", "123", "450 000 zł", "Flat", "Mokotów, Warszawa", "True", "live")
    assert (b.website, b.offer_id, b.price, b.offer_title, b.location) == \
        ("otodom", "555", "900 000 zł", "Partner flat", "ul. Prosta, Wola")


def test_t1_expired_after_live_gets_fresh_defaults(spark):
    out = parsed(spark, [(1, BASE + "a.html", live_base(1)), (2, BASE + "b.html", EXPIRED)])
    e = out[2]
    assert e.status == "expired"
    assert (e.offer_id, e.price, e.offer_title, e.location, e.active) == \
        ("Unknown", "Unknown", "Unknown", "Unknown", "No")


def test_dead_markers_case_sensitive(spark):
    rows = [(1, BASE + "1.html", live_base(1, title="Błąd 404")),
            (2, BASE + "2.html", live_base(2, title="Ups, mamy problem")),
            (3, BASE + "3.html", live_base(3, title="Archiwalne: mieszkanie")),
            (4, BASE + "4.html", live_base(4, title="archiwalne: lowercase"))]
    out = parsed(spark, rows)
    assert [out[i].status for i in (1, 2, 3, 4)] == ["dead", "dead", "dead", "live"]
    assert out[1].active == "No" and out[1].price == "Unknown"


def test_t3_t5_missing_id_keeps_row(spark):
    out = parsed(spark, [(1, BASE + "a.html", live_base(1, ident="no id here")),
                         (2, BASE + "b.html", live_base(2, ident="ID: 9"))])
    assert out[1].offer_id == "Not found" and out[1].reason is None
    assert out[2].offer_id == "9"


def test_t4_unknown_host_between_known_ones(spark):
    rows = [(1, BASE + "a.html", live_base(1)),
            (2, "https://www.other.pl/x.html", live_base(2)),
            (3, PARTNER + "c", live_partner())]
    out = parsed(spark, rows)
    assert out[1].reason is None and out[3].reason is None
    assert out[2].reason == "unknown site" and out[2].status == "quarantine"


def test_t10_url_without_www_is_quarantined(spark):
    out = parsed(spark, [(1, "https://olx.pl/d/a.html", live_base(1))])
    assert out[1].reason == "no www. in url" and out[1].website is None


def test_empty_and_null_html(spark):
    out = parsed(spark, [(1, BASE + "a.html", ""), (2, BASE + "b.html", None)])
    assert out[1].reason == "empty page" and out[2].reason == "empty page"


def test_dead_page_of_unknown_site_is_a_record(spark):
    out = parsed(spark, [(1, "https://www.other.pl/x.html", live_base(1, title="404"))])
    assert out[1].reason is None and out[1].status == "dead"


def test_every_page_lands_once(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = X.parse_pages(p, SYNTHETIC_PAGE_RULES)
    n = p.count()
    agg = out.agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("d"),
                  F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).alias("good")).first()
    assert agg.n == n and agg.d == n
    assert out.filter(F.col("reason").isNull() & F.col("website").isNull()).count() == 0


def test_classify_matches_parse(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    st = S.classify_pages(p, SYNTHETIC_PAGE_RULES).select("page_id", "status")
    assert st.filter(F.col("status").isNull()).count() == 0


def test_offer_pages_reports_missing_pages(spark):
    links = spark.createDataFrame([(BASE + "a.html", "25-40"), (BASE + "zzz.html", "-25")],
                                  "url string, category string")
    out = {r.url: r for r in X.offer_pages(
        links, pages(spark, [(1, BASE + "a.html", live_base(1))]), REFERENCE_PAGE_RULES).collect()}
    assert out[BASE + "a.html"].category == "25-40" and out[BASE + "a.html"].reason is None
    assert out[BASE + "zzz.html"].reason == "page missing"


def test_plan_numbers_elements_once(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = X.parse_pages(p, SYNTHETIC_PAGE_RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_offer_pages_latest_stored_version_wins(spark):
    links = spark.createDataFrame([(BASE + "a.html", "25-40")], "url string, category string")
    rows = [(i, BASE + "a.html", live_base(i, price=f"{i} zł")) for i in range(1, 30)]
    out = X.offer_pages(links, pages(spark, rows), REFERENCE_PAGE_RULES).collect()
    assert len(out) == 1 and out[0].page_id == 29 and out[0].price == "29 zł"


def test_fields_come_from_inside_their_element(spark):
    """A similar offer further down is never taken for the offer's own field."""
    rest = '<section><h3>999 zł similar offer</h3><h4>Other</h4></section></body></html>'
    page = ('<html><head><title>T</title></head><body><div data-testid="ad-price-container"><b>ask</b></div>'
            '<div data-testid="ad-inactive-msg"></div>'
            '<div data-cy="ad_title"><div><i>x</i></div><div>y</div><h4>Own title</h4></div>' + rest)
    r = parsed(spark, [(1, BASE + "a.html", page)])[1]
    assert (r.status, r.price, r.offer_title) == ("live", "Not found", "Own title")


def test_only_wanted_pages_are_parsed(spark):
    from pyspark.sql import functions as F

    rows = pages(spark, [(i, f"{BASE}{i}.html", live_base(i)) for i in range(20)] + [(50, f"{BASE}3.html", live_base(3))])
    links = spark.createDataFrame([(f"{BASE}{i}.html", "-25") for i in (3, 4, 99)], "url string, category string")
    assert {4, 50} <= {r.page_id for r in X.wanted_pages(links, rows).collect()}
    got = X.offer_pages(links, rows, REFERENCE_PAGE_RULES).select("url", F.coalesce("reason", "status").alias("r")).collect()
    assert sorted((r.url[len(BASE):], r.r) for r in got) == [("3.html", "live"), ("4.html", "live"), ("99.html", "page missing")]


def test_few_unwanted_pages_are_parsed(spark):
    """The filter lets every wanted page through, and at most 2 % of the others, however many are wanted."""
    stored = spark.range(60_000).select(F.col("id").alias("page_id"), F.concat(F.lit(BASE), F.col("id")).alias("url"), F.lit("x").alias("html"))
    for wanted in (100, 40_000):
        links = spark.range(wanted).select(F.concat(F.lit(BASE), F.col("id")).alias("url"), F.lit("-25").alias("category"))
        got = {r.page_id for r in X.wanted_pages(links, stored).select("page_id").collect()}
        assert set(range(wanted)) <= got and len(got) <= wanted + 0.02 * (60_000 - wanted)
    full = X.wanted_pages(links, stored, bloom.Params(max_blocks=8))  # a filter that is too small is still right
    assert {r.page_id for r in full.where("page_id < 40000").collect()} == set(range(40_000))


def test_copies_of_a_page_give_one_record_whatever_their_order(spark):
    links = spark.createDataFrame([(BASE + "a.html", "25-40")], "url string, category string")
    rows = [(1, BASE + "a.html", live_base(1, price=f"{i} zł")) for i in range(6)]
    got = {X.offer_pages(links, pages(spark, order).repartition(n), REFERENCE_PAGE_RULES).first().price
           for order, n in ((rows, 1), (rows[::-1], 3), (rows[3:] + rows[:3], 2))}
    assert len(got) == 1


def test_pages_made_of_narrow_rows_are_many_tasks(spark, tmp_root):
    from offerframe.plans import catalog
    from offerframe.plans import fixtures as FX

    (spark.range(12_000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("n"), "id").alias("p_name"), F.lit(3).alias("p_size"))
     .coalesce(1).write.parquet(f"{tmp_root}/part.parquet"))
    spark.range(25).select(F.col("id").alias("n_nationkey"), F.lit("PL").alias("n_name")).write.parquet(f"{tmp_root}/nation.parquet")
    pages = FX.listing_pages(spark, tmp_root)
    assert pages.select(F.spark_partition_id().alias("p")).distinct().count() >= 3
    assert pages.select("page_id").distinct().count() == pages.count() == 12_000
    offers = catalog.listing_offers(spark, tmp_root)
    assert offers.select(F.spark_partition_id().alias("p")).distinct().count() >= 3 and offers.count() == 12_000


def test_elements_are_numbered_in_bounded_chunks():
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import ArrayType

    from offerframe.operators import elements as E

    pages = ["<p>%d</p>" % k + "x" * (k % 7 * 40_000) for k in range(60)] + [None, "", "<b>" + "y" * (3 << 20) + "</b>"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pages))), pa.array(pages)], names=["page_id", "html"])
    sizes = [sum(len(h or "") for h in c.column("html").to_pylist()) for c in E.chunks(batch, "html")]
    assert len(sizes) > 5 and all(s <= E._CHUNK_BYTES for s in sizes[:-1])
    out = list(E._numbered("html", to_arrow_type(ArrayType(E.ELEMENT)))([batch, batch.slice(0, 0)]))
    assert len(out) == len(sizes)
    assert [h for b in out for h in b.column("html").to_pylist()] == pages
    names = [[e["name"] for e in els] for b in out for els in b.column(E.ELEMENTS).to_pylist()]
    assert names == [["p"]] * 60 + [[], [], ["b"]]
