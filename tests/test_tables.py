"""Bands and site rules given as tables: brute force, awkward rows, plans."""

import random

import pytest
from pyspark.sql import functions as F

from offerframe.operators import bands as B
from offerframe.operators import rank
from offerframe.operators import tables as TB

BAND = "ord long, label string, lo long, hi long"
RULE = "ord long, token string, site string"


def _holds(v, lo, hi, inclusive):
    return v is not None and (lo is None or v >= lo) and (hi is None or (v <= hi if inclusive else v < hi))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("small", [rank.SMALL_ROWS, 0])
def test_bands_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(rank, "SMALL_ROWS", small)  # sent to the tasks, or joined by shuffle
    rng = random.Random(4)
    bands = [(i, f"b{i}", lo, lo + rng.choice([-1, 0, 1, 7, 64, 1000])) for i in range(60) for lo in [rng.randint(-300, 300)]]
    bands += [(60, "low", None, -5), (61, "high", 250, None), (62, "gone", 9, 3), (5, "zz", 0, 10), (5, "zz", 0, 10)]
    values = [rng.randint(-400, 400) for _ in range(150)] + [None, 0, 0, 10**12, -10**12]
    values += [77] * 80
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    table = spark.createDataFrame(bands, BAND)
    for inclusive in (True, False):
        want = sorted((i, b[0], b[1]) for i, v in enumerate(values) for b in bands if _holds(v, b[2], b[3], inclusive))
        found = TB.assign_from_table(df, F.col("v"), table, inclusive)
        assert sorted((r["id"], r["ord"], r["category"]) for r in found.collect()) == want
        last = TB.last_from_table(df, F.col("v"), table, inclusive)
        for r in last.collect():
            mine = [(o, c) for i, o, c in want if i == r["id"]]
            assert (r["n_bands"], r["category"]) == (len(mine), max(mine)[1] if mine else None)
        assert last.count() == len(values)
        assert "NestedLoop" not in _plan(found) and "Cartesian" not in _plan(found)


def test_bands_as_table_equal_bands_as_list(spark):
    df = spark.range(-5, 400).select("id", F.col("id").cast("int").alias("v"))
    listed = {r["id"]: r["c"] for r in df.select("id", B.last_band(F.col("v")).alias("c")).collect()}
    tabled = {r["id"]: r["category"] for r in TB.last_from_table(df, F.col("v"), B.bands_frame(spark)).collect()}
    assert listed == tabled


def test_no_bands(spark):
    df, none = spark.range(3), spark.createDataFrame([], BAND)
    assert TB.assign_from_table(df, F.col("id"), none).count() == 0
    assert {(r["n_bands"], r["category"]) for r in TB.last_from_table(df, F.col("id"), none).collect()} == {(0, None)}
    bands = spark.createDataFrame([(1, "a", 0, 1)], BAND)
    assert TB.last_from_table(df.limit(0), F.col("id"), bands).count() == 0


@pytest.mark.parametrize("small", [rank.SMALL_ROWS, 0])
def test_first_of_many_rules(spark, monkeypatch, small):
    monkeypatch.setattr(rank, "SMALL_ROWS", small)
    rng = random.Random(8)
    rules = [(i, "www." + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))), f"site{i}") for i in range(400)]
    rules += [(400, "", "empty"), (401, None, "none"), (402, "żółć/", "umlaut"), (0, rules[0][1], "a-tie")]
    urls = ["https://www." + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 6))) + ".pl/x" for _ in range(200)]
    urls += ["", None, "www", urls[0], "http://żółć/www.abc", "http://żółć/ www. żółć/"]
    df = spark.createDataFrame(list(enumerate(urls)), "id long, url string")
    got = TB.route_from_table(df, "url", spark.createDataFrame(rules, RULE))
    assert got.columns == ["id", "url", "site"]
    rows = got.collect()
    assert len(rows) == len(urls)
    for r in rows:
        mine = [(o, s) for o, t, s in rules if t and r["url"] is not None and t in r["url"]]
        assert r["site"] == (min(mine)[1] if mine else None)
    assert "NestedLoop" not in _plan(got) and "Cartesian" not in _plan(got)


def test_plans_do_not_grow_with_the_rules(spark):
    urls = spark.createDataFrame([("http://a/b",)], "url string")
    sizes = {len(_plan(TB.route_from_table(urls, "url", spark.createDataFrame(
        [(i, f"/{i:05d}", f"s{i}") for i in range(n)], RULE))).splitlines()) for n in (3, 300)}
    assert len(sizes) == 1
    assert TB.route_from_table(urls, "url", spark.createDataFrame([], RULE)).first()["site"] is None


def test_numbers_as_tokens_are_looked_up_whole(spark):
    rules = [((k * 7919) % 3000, f"/{k}", f"site{k}") for k in range(3000)] + [(5000, "/z", "a"), (5000, "/z", "b")]
    urls = ["http://a/1", "http://a/29/x/2999", "http://a/12345?b=/7", "http://a//", "/", "", None, "/z/3000", "/z", "/3/3/3"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = TB.route_from_table(df, "url", spark.createDataFrame(rules, RULE))
    assert sorted((r["url"] or "", r["site"]) for r in got.collect()) == sorted(
        (u or "", min([(o, s) for o, t, s in rules if u is not None and t in u], default=(0, None))[1]) for u in urls)
    assert "Contains(" not in _plan(got)  # a URL meets the tokens it holds, not all that begin alike


def test_the_greatest_balance_is_the_first_rule(spark, tmp_root):
    from offerframe.plans import catalog

    customers = [(1, "c1", -5.0), (12, "c12", 80.5), (123, "c123", 80.5), (2, "c2", None), (23, "c23", -9.75), (3, "c3", None),
                 (32, "c32", None), (7, "low", 1.0), (7, "high", 2.0), (None, "nobody", 1e9), (4, None, 1e6), (45, "c45", None)]
    first = {"http://a/1234?b": "c12", "http://a/1": "c1", "http://a/23.html": "c23", "http://a/23/1": "c1", "http://a/32": "c3",
             "http://a/2/32": "c2", "http://a/7": "high", "http://a/45": "c45", "http://a/4": None, "http://a/9": None, None: None}
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_acctbal double").write.parquet(f"{tmp_root}/customer.parquet")
    spark.createDataFrame(list(enumerate(first)), "page_id long, url string").write.parquet(f"{tmp_root}/pages.parquet")
    assert {r["url"]: r["site"] for r in catalog.route_table(spark, tmp_root).collect()} == first


def test_cells_do_not_grow_with_equal_bands(spark, monkeypatch):
    sizes, send = [], TB.sent_if_small

    def counted(df, name):
        out = send(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(TB, "sent_if_small", counted)
    df = spark.range(0, 60).select(F.col("id").alias("v"))
    for n in (1, 300):
        bands = spark.createDataFrame([(k, f"b{k:03d}", 3, 52) for k in range(n)], BAND)
        rows = TB.last_from_table(df, F.col("v"), bands).collect()
        assert all((r["n_bands"], r["category"]) == ((n, f"b{n - 1:03d}") if 3 <= r["v"] <= 52 else (0, None)) for r in rows)
    assert sizes[:len(sizes) // 2] == sizes[len(sizes) // 2:]


def test_cells_of_wide_and_narrow_ranges(spark):
    ends = [(0, 0), (0, 1), (7, 8), (7, 7), (5, 3), (-9, 9), (-(1 << 61), 1 << 61), (-(1 << 61), -3), ((1 << 61) - 1, 1 << 61), (1, 1 << 61)]
    ends += [(-(1 << k), (1 << k) - 1) for k in range(1, 61, 7)] + [(1, 1 << k) for k in range(1, 61, 7)]
    df = spark.createDataFrame(ends, "l long, r long")
    for r in df.select("l", "r", TB._cells(F.col("l"), F.col("r")).alias("c")).collect():
        parts = sorted((c["cell"] << c["level"], (c["cell"] + 1) << c["level"]) for c in r["c"])
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert (parts[0][0], parts[-1][1]) == (r["l"], r["r"]) if r["l"] < r["r"] else parts == []
