"""Merges M1-M8 and the traps T6, T7, T9, T11, T12."""

from pyspark.sql import functions as F

from offerframe.functions.codecs import get_bool, is_active, put_bool
from offerframe.operators import merge as M
from offerframe.schema import OFFER_COLUMNS

REC = "url string, category string, website string, offer_id string, price string, " \
      "offer_title string, location string, active string"

U = "https://www.olx.pl/d/"


def base(spark):
    rows = [(U + "1.html", "25-40", "olx", "1", "100", "One", "Wola", "Unknown"),
            (U + "2.html", "40-50", "olx", "2", "200", "Two", "Ursus", "True"),
            (U + "3.html", "-25", "olx", "3", "300", "O'Hara's flat", "Bemowo", "No")]
    return spark.createDataFrame(rows, REC)


def rows(df):
    return {r.url: r for r in df.collect()}


def test_m1_last_update_wins_and_replaces_all(spark):
    upd = spark.createDataFrame(
        [(U + "2.html", "150-", "olx", "2", "250", "Two v2", None, "No", 1),
         (U + "2.html", "150-", "olx", "2", "260", "Two v3", "Ochota", "No", 2),
         (U + "4.html", "-25", "olx", "4", "400", "Four", "Wawer", "True", 1)],
        REC + ", seq int")
    out = rows(M.upsert_overwrite(base(spark), upd, "seq"))
    assert set(out) == {U + f"{i}.html" for i in (1, 2, 3, 4)}
    assert out[U + "2.html"].price == "260" and out[U + "2.html"].location == "Ochota"
    assert out[U + "1.html"].active == "Unknown"


def test_m1_m6_absent_is_no_data_and_idempotent(spark):
    upd = spark.createDataFrame([(U + "1.html", "x", 1)], "url string, price string, seq int")
    once = M.upsert_overwrite(base(spark), upd, "seq")
    r = rows(once)[U + "1.html"]
    assert r.price == "x" and r.offer_title == "No data" and r.active == "No data"
    twice = M.upsert_overwrite(once, upd, "seq")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.groupBy("url").count().filter("count > 1").count() == 0


def map_updates(spark):
    return spark.createDataFrame(
        [(U + "1.html", "150-", None, "111", None, None, False),   # known, Unknown active
         (U + "2.html", "150-", "2", "222", "Two!", None, None),  # known, decided
         (U + "5.html", "-25", None, None, "Five", None, None),   # new, defaults (T9)
         ("https://olx.pl/d/6.html", "-25", None, None, None, None, True)],  # T10
        "url string, size_category string, offer_id string, price string, offer_title string, "
        "location string, is_active boolean")


def test_m2_fill_unknown(spark):
    out = rows(M.merge_fill_unknown(base(spark), map_updates(spark)))
    assert out[U + "1.html"].active == "0" and out[U + "1.html"].price == "100"
    assert out[U + "2.html"].active == "True" and out[U + "2.html"].price == "200"
    new = out[U + "5.html"]
    assert (new.category, new.website, new.offer_id, new.price, new.active, new.change) == \
        ("-25", "olx", "Unknown", "Unknown", "1", "inserted")
    assert "https://olx.pl/d/6.html" not in out
    rej = M.merge_rejects(base(spark), map_updates(spark)).collect()
    assert [r.url for r in rej] == ["https://olx.pl/d/6.html"]


def test_m3_conditional(spark):
    out = rows(M.merge_conditional(base(spark), map_updates(spark)))
    one, two = out[U + "1.html"], out[U + "2.html"]
    assert (one.category, one.price, one.offer_title, one.active) == ("150-", "111", "Unknown", "0")
    assert (two.category, two.price, two.offer_title, two.active) == ("40-50", "200", "Two", "1")


def test_m4_status_update_and_report(spark):
    upd = spark.createDataFrame([(U + "1.html", "Yes"), (U + "9.html", "No")], "url string, status string")
    out = rows(M.status_update(base(spark), upd))
    assert out[U + "1.html"].active == "Yes" and out[U + "1.html"].updated
    assert out[U + "2.html"].active == "True" and not out[U + "2.html"].updated
    assert [r.url for r in M.status_unmatched(base(spark), upd).collect()] == [U + "9.html"]


def test_m5_lookup_and_t6_apostrophe(spark):
    keys = spark.createDataFrame([(U + "3.html",), (U + "3.html",), (U + "7.html",)], "url string")
    got = M.key_lookup(base(spark), keys).collect()
    assert len(got) == 1 and got[0].offer_title == "O'Hara's flat"


def test_t11_null_active_is_fine(spark):
    b = spark.createDataFrame([(U + "1.html", "a", "olx", "1", "1", "t", "l", None)], REC)
    upd = spark.createDataFrame([(U + "1.html", "No")], "url string, status string")
    assert rows(M.status_update(b, upd))[U + "1.html"].active == "No"


def test_m8_codecs(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "x int")
    got = df.select(get_bool(F.col("x")).alias("b"), put_bool(get_bool(F.col("x"))).alias("i")).collect()
    assert [r.b for r in got] == [False, True, True, True]
    assert [r.i for r in got] == [0, 1, 1, 1]
    t = spark.createDataFrame([(s,) for s in ["True", "Yes", "1", "No", "0", "Unknown", "No data"]], "a string")
    assert [r.v for r in t.select(is_active(F.col("a")).alias("v")).collect()] == \
        [True, True, True, False, False, None, None]


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, "d")],
                               "k int, ts int, id int, v string")
    out = {r.k: r.v for r in M.latest_per_key(df, "k", ["ts", "id"], ["v"]).collect()}
    assert out == {1: "b", 2: "d"}


def test_project_record_ignores_extra(spark):
    df = spark.createDataFrame([(U, "x", "junk")], "url string, price string, extra string")
    assert M.project_record(df).columns == OFFER_COLUMNS


def test_m1_size_is_union_of_keys_on_tables(spark):
    from offerframe.plans import fixtures as FX
    sf = "/root/testdata/sf0.001"
    b, u = FX.merge_base(spark, sf), FX.record_updates(spark, sf)
    out = M.upsert_overwrite(b, u, "seq")
    keys = b.select("url").union(u.select("url")).distinct().count()
    assert out.count() == keys == out.select("url").distinct().count()


def test_m5_single_key_is_pushed_down(spark, tmp_root):
    from offerframe.plans import fixtures as FX
    from offerframe.sources import snapshots as SN
    SN.write_snapshot(FX.merge_base(spark, "/root/testdata/sf0.001"), tmp_root)
    url = "https://www.sitea.pl/d/2.html"
    df = M.lookup_one(SN.read_snapshot(spark, tmp_root), url)
    assert [r.url for r in df.collect()] == [url]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(url,{url})" in plan


def test_null_keys_in_updates_are_ignored(spark):
    upd = spark.createDataFrame([(None, "1", 1), (U + "1.html", "2", 1)], "url string, price string, seq int")
    out = M.upsert_overwrite(base(spark), upd, "seq").collect()
    assert all(r.url is not None for r in out) and len(out) == 3
    mu = spark.createDataFrame([(None, "-25")], "url string, size_category string")
    assert all(r.url is not None for r in M.merge_fill_unknown(base(spark), mu).collect())
