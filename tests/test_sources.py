"""Sources and sinks S1-S10, snapshot versions, stamp L14."""

import json
import os

import pytest
from pyspark.sql import functions as F

from offerframe.functions.codecs import snapshot_stamp
from offerframe.plans import fixtures as FX
from offerframe.plans import jobs
from offerframe.profiles import REFERENCE_PAGE_RULES
from offerframe.sources import fs
from offerframe.sources import linkfiles as LF
from offerframe.sources import offermap as OM
from offerframe.sources import snapshots as SN


def test_newest_pick_and_ties(spark, tmp_root):
    for name, t in (("links_202401010000", 100), ("links_202401020000", 200), ("links_202401030000", 200)):
        d = os.path.join(tmp_root, name)
        os.makedirs(d)
        with open(os.path.join(d, "part-0.txt"), "w") as f:
            f.write(f"https://www.olx.pl/{name}.html\n")
        os.utime(d, (t, t))
    path, links = LF.read_newest_links(spark, tmp_root)
    assert path.endswith("links_202401030000")
    assert links.first().url.endswith("links_202401030000.html")


def test_empty_folder_raises(spark, tmp_root):
    with pytest.raises(FileNotFoundError):
        LF.read_newest_links(spark, tmp_root)
    with pytest.raises(FileNotFoundError):
        OM.newest_offer_map_path(spark, tmp_root)


def test_legacy_offer_map_object(spark, tmp_root):
    path = os.path.join(tmp_root, "offers_202401010000.json")
    data = {"https://www.olx.pl/a.html": {"size_category": "25-40"},
            "https://www.otodom.pl/b": {"size_category": "150-", "is_active": False, "price": "1"},
            "https://www.otodom.pl/c": {"size_category": "150-", "is_active": 0},
            "https://www.otodom.pl/d": {"size_category": "150-", "is_active": 1}}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(data, f, indent=4)
    got = {r.url: r for r in OM.read_offer_map(spark, path).collect()}  # the layout is found
    assert got["https://www.olx.pl/a.html"].size_category == "25-40"
    assert got["https://www.olx.pl/a.html"].is_active is None
    assert got["https://www.otodom.pl/b"].is_active is False
    assert got["https://www.otodom.pl/c"].is_active is False and got["https://www.otodom.pl/d"].is_active is True
    assert OM.newest_offer_map_path(spark, tmp_root).endswith(".json")


def test_offer_map_lines_roundtrip(spark, tmp_root):
    links = spark.createDataFrame([("u1", "-25"), ("u2", "150-")], "url string, category string")
    p = OM.write_offer_map(links, tmp_root, "202401010000")
    assert sorted((r.url, r.size_category) for r in OM.read_offer_map(spark, p).collect()) == \
        [("u1", "-25"), ("u2", "150-")]


def test_snapshot_versions_and_pointer(spark, tmp_root):
    v = FX.offers_view(spark, "/root/testdata/sf0.001").drop("p_size")
    assert SN.write_snapshot(v, tmp_root, check_keys=True) == 1
    assert SN.write_snapshot(v.limit(3), tmp_root) == 2
    assert SN.read_snapshot(spark, tmp_root).count() == 3
    assert SN.read_snapshot(spark, tmp_root, 1).count() == v.count()
    assert SN.finished_versions(spark, tmp_root) == [1, 2]


def test_unfinished_version_is_neither_read_nor_overwritten(spark, tmp_root):
    v = FX.offers_view(spark, "/root/testdata/sf0.001").drop("p_size")
    SN.write_snapshot(v.limit(5), tmp_root)
    v.limit(7).write.parquet(f"{tmp_root}/v00000002")  # a write that ended before it was finished
    assert SN.current_version(spark, tmp_root) == 1
    assert SN.read_snapshot(spark, tmp_root).count() == 5
    assert SN.write_snapshot(v.limit(3), tmp_root) == 3
    assert spark.read.parquet(f"{tmp_root}/v00000002").count() == 7


def test_of_two_writers_of_one_version_one_fails(spark, tmp_root, monkeypatch):
    v = FX.offers_view(spark, "/root/testdata/sf0.001").drop("p_size")
    monkeypatch.setattr(SN, "_next_version", lambda *_: 1)
    assert SN.write_snapshot(v.limit(2), tmp_root) == 1
    with pytest.raises(Exception, match="(?i)exist"):
        SN.write_snapshot(v.limit(3), tmp_root)
    with pytest.raises(Exception, match="(?i)exist"):
        fs.create_small_text(spark, f"{tmp_root}/{SN.VERSIONS}/v00000001", "")
    assert SN.read_snapshot(spark, tmp_root).count() == 2


def test_conform_defaults_and_required(spark):
    df = spark.createDataFrame([("u", None, "w", None, None, None, None, None),
                                ("v", "c", None, "1", "2", "3", "4", "5")],
                               "url string, category string, website string, offer_id string, "
                               "price string, offer_title string, location string, active string")
    rows = SN.conform(df).collect()
    assert len(rows) == 1 and rows[0].category == "Unknown" and rows[0].active == "Unknown"


def test_stamp(spark):
    df = spark.createDataFrame([("2024-03-05 07:09:59",)], "t string").select(F.to_timestamp("t").alias("t"))
    assert df.select(snapshot_stamp(F.col("t")).alias("s")).first().s == "202403050709"


def test_extract_offers_job(spark, tmp_root):
    base = "https://www.olx.pl/d/"
    html = ('<html><head><title>T</title></head><body><div data-cy="ad_title"><h4>Flat</h4></div>'
            '<div data-testid="ad-price-container"><h3>10</h3></div></body></html>')
    pages = spark.createDataFrame([(1, base + "a.html", html), (2, "https://www.other.pl/b.html", html)],
                                  "page_id long, url string, html string")
    maps = os.path.join(tmp_root, "maps")
    links = spark.createDataFrame([(base + "a.html", "25-40"), ("https://www.other.pl/b.html", "-25"),
                                   (base + "gone.html", "-25")], "url string, category string")
    OM.write_offer_map(links, maps, "202401010000")
    out = jobs.extract_offers(spark, maps, pages, REFERENCE_PAGE_RULES,
                             os.path.join(tmp_root, "table"), os.path.join(tmp_root, "q"))
    table = {r.url: r for r in SN.read_snapshot(spark, os.path.join(tmp_root, "table")).collect()}
    assert list(table) == [base + "a.html"] and table[base + "a.html"].offer_title == "Flat"
    c = out["counts"]
    assert (c["pages"], c["offers"], c["quarantined"]) == (3, 1, 2)
    reasons = sorted(r.reason for r in out["quarantine"].collect())
    assert reasons == ["page missing", "unknown site"]
    res = jobs.analyse(SN.read_snapshot(spark, os.path.join(tmp_root, "table")))
    assert res["category_counts"].first().n_offers == 1


def test_load_offer_map_bucketed(spark, tmp_root):
    links = spark.createDataFrame([("https://www.olx.pl/d/a.html", "-25"), ("https://www.olx.pl/d/b.html", "150-")],
                                  "url string, category string")
    p = OM.write_offer_map(links, os.path.join(tmp_root, "maps"), "202401010000")
    table = os.path.join(tmp_root, "table")
    assert jobs.load_offer_map(spark, p, table, bucketed=("offers_load_test", 8)) == 1
    assert jobs.load_offer_map(spark, p, table, bucketed=("offers_load_test", 8)) == 2
    rows = SN.read_bucketed(spark, table, "offers_load_test").collect()
    assert sorted(r.url for r in rows) == ["https://www.olx.pl/d/a.html", "https://www.olx.pl/d/b.html"]


def test_offer_map_rejects_keep_bad_lines(spark, tmp_root):
    path = os.path.join(tmp_root, "offers_bad")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write('{"https://www.olx.pl/a.html": {"size_category": "-25"}}\n')
        f.write('not json at all\n')
        f.write('\n')
    assert [r.url for r in OM.read_offer_map(spark, path).collect()] == ["https://www.olx.pl/a.html"]
    bad = OM.offer_map_rejects(spark, path).collect()
    assert [r.raw for r in bad] == ["not json at all"]


def test_load_keeps_rejects_and_existing_rows(spark, tmp_root):
    table = os.path.join(tmp_root, "table")
    path = os.path.join(tmp_root, "offers_1")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write('{"https://www.olx.pl/a.html": {"size_category": "-25"}}\n{"https://olx.pl/b": {"size_category": "-25"}}\n'
                '{"https://www.cheap.example.com/the/x": {"size_category": "-25"}}\nbroken\n')
    version = jobs.load_offer_map(spark, path, table)
    assert [r.url for r in SN.read_snapshot(spark, table).collect()] == ["https://www.olx.pl/a.html"]
    out = spark.read.parquet(jobs.rejects_path(table, version)).collect()
    assert sorted((r.raw or "", r.url or "", r.reason) for r in out) == [
        ("", "https://olx.pl/b", "no www. in url"), ("", "https://www.cheap.example.com/the/x", "no www. in url"),
        ("broken", "", "not an offer-map object")]


def test_offer_map_with_a_corrupt_first_line_keeps_its_entries(spark, tmp_root):
    """Part files that start with a bad line, and one indented object, under one path."""
    path = os.path.join(tmp_root, "offers_202401010000")
    os.makedirs(path)
    for part in range(3):
        with open(os.path.join(path, f"part-{part}.txt"), "w", encoding="utf-8") as f:
            f.write(f'{{"cut off {part}": {{"size_c\n' if part != 1 else "")
            f.writelines(json.dumps({f"https://www.olx.pl/u{part}-{k}": {"size_category": "-25"}}) + "\n" for k in range(4))
    wanted = {f"https://www.olx.pl/u{part}-{k}" for part in range(3) for k in range(4)}
    assert {r.url for r in OM.read_offer_map(spark, path).collect()} == wanted
    assert sorted(r.raw[:10] for r in OM.offer_map_rejects(spark, path).collect()) == ['{"cut off ', '{"cut off ']
    with open(os.path.join(path, "part-3 a.json"), "w", encoding="utf-8") as f:
        json.dump({"https://www.olx.pl/o1": {"size_category": "150-"}, "https://www.olx.pl/o2": {"size_category": "-25"}}, f, indent=4)
    assert sorted(r.url for r in OM.read_offer_map(spark, path).collect()) == sorted(wanted | {"https://www.olx.pl/o1", "https://www.olx.pl/o2"})
    assert OM.offer_map_rejects(spark, path).count() == 2
    jobs.load_offer_map(spark, path, os.path.join(tmp_root, "table"))
    assert SN.read_snapshot(spark, os.path.join(tmp_root, "table")).count() == 14
