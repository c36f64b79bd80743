"""Offer maps of every layout, cut into byte ranges of any size."""

import json
import os
import random

import pytest

from offerframe.sources import offermap as OM
from offerframe.sources import snapshots as SN
from offerframe.streaming import ingest


def entries(n, seed=0):
    """Entries whose texts hold braces, quotes, backslashes and line feeds."""
    rng = random.Random(seed)
    odd = ["}", "{", '"', "\\", "\n", "\\}", '"}', "{}", ",", "]", "[", "ż", '\\"', "}\n{"]
    return {f"https://www.olx.pl/d/{seed}-{i}.html": {
        "size_category": rng.choice(["-25", "25-40"]), "offer_title": "".join(rng.choice(odd) for _ in range(rng.randrange(6))),
        "is_active": rng.choice([True, False])} for i in range(n)}


def titles(df):
    return {r.url: r.offer_title for r in df.collect()}


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("split", [400, 1 << 20])
def test_every_layout_and_any_range(spark, tmp_root, split):
    maps = [entries(30, seed) for seed in range(5)]
    write(f"{tmp_root}/m/a.json", json.dumps(maps[0], indent=4))
    write(f"{tmp_root}/m/b.json", json.dumps(maps[1], ensure_ascii=False))
    write(f"{tmp_root}/m/c.txt", "".join(json.dumps({k: v}) + "\n" for k, v in maps[2].items()))
    write(f"{tmp_root}/m/d.txt", json.dumps(maps[3], indent=1).replace("\n", "\r\n") + "\r\n")
    write(f"{tmp_root}/m/e.txt", "\n" + json.dumps(maps[4], indent=0) + "\n\n")
    write(f"{tmp_root}/m/f.txt", "")
    write(f"{tmp_root}/m/g.txt", "{}")
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(split))
    try:
        found = OM.open_offer_map(spark, f"{tmp_root}/m")
        assert titles(found.rows) == {u: v["offer_title"] for m in maps for u, v in m.items()}
        assert found.rejects.count() == 0
        if split == 400:
            assert found.rows.select("seq.file", "seq.start").distinct().count() > 20
    finally:
        spark.conf.set(conf, before)


def test_damage_costs_only_what_is_damaged(spark, tmp_root):
    good = entries(6)
    items = [json.dumps({k: v}, indent=4)[1:-1].strip() for k, v in good.items()]
    items[1:1] = ['"https://x/1": 17']
    items[3:3] = ['"https://x/2": {"size_category": }', '"https://x/3": [{"a": 1}, {}]', '"https://x/4": null']
    write(f"{tmp_root}/m/a.json", "{\n    " + ",\n    ".join(items) + "\n}\n")
    found = OM.open_offer_map(spark, f"{tmp_root}/m")
    assert titles(found.rows) == {u: v["offer_title"] for u, v in good.items()}
    assert sorted(r.raw for r in found.rejects.collect()) == [
        '"https://x/1": 17', '"https://x/2": {"size_category": }', '"https://x/3": [{"a":1},{}]', '"https://x/4": null']


def test_cut_off_and_unbalanced_files(spark, tmp_root):
    good = entries(4)
    text = json.dumps(good, indent=4)
    write(f"{tmp_root}/m/a.json", text[:-1].rstrip() + ',\n    "https://x/cut": {"size_category": "a"')
    write(f"{tmp_root}/m/b.txt", "{" + "\n".join(json.dumps({f"https://y/{i}": {"price": "1"}}) for i in range(3)) + "\n}}}\n"
          + json.dumps({"https://y/9": {"price": "1"}}))
    found = OM.open_offer_map(spark, f"{tmp_root}/m")
    got = titles(found.rows)
    assert set(good) <= set(got) and "https://x/cut" not in got and {"https://y/1", "https://y/2", "https://y/9"} <= set(got)
    assert '"https://x/cut": {"size_category": "a"' in {r.raw for r in found.rejects.collect()}


def test_a_large_object_is_read_by_several_tasks(spark, tmp_root):
    many = {f"https://www.olx.pl/d/{i}.html": {"size_category": "-25", "price": str(i)} for i in range(60_000)}
    write(f"{tmp_root}/offers_1.json", json.dumps(many, indent=4))
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(1 << 20))
    try:
        rows = OM.open_offer_map(spark, f"{tmp_root}/offers_1.json").rows
        got = {r.start: r.n for r in rows.groupBy("seq.start").count().withColumnRenamed("count", "n").collect()}
    finally:
        spark.conf.set(conf, before)
    assert sum(got.values()) == len(many) and len(got) >= 4
    assert rows.selectExpr("sum(cast(price as long)) as s").first().s == sum(range(60_000))


def test_the_stream_reads_the_original_format(spark, tmp_root):
    from offerframe.plans import jobs

    maps = [entries(8, seed) for seed in (1, 2)]
    for k, m in enumerate(maps):
        write(f"{tmp_root}/in/{k}.json", json.dumps(m, indent=4))
        os.utime(f"{tmp_root}/in/{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    write(f"{tmp_root}/in/2.json", "{broken")
    ingest.ingest_offer_maps(spark, f"{tmp_root}/in", f"{tmp_root}/t", f"{tmp_root}/c", max_files=1).awaitTermination()
    jobs.load_offer_map(spark, f"{tmp_root}/in", f"{tmp_root}/t2")
    rows = sorted(SN.read_snapshot(spark, f"{tmp_root}/t").collect())
    assert len(rows) == 16 and rows == sorted(SN.read_snapshot(spark, f"{tmp_root}/t2").collect())
    assert [r.raw for r in spark.read.parquet(ingest.rejects_root(f"{tmp_root}/t")).collect()] == ["{broken"]
