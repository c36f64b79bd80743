"""M9: the stream gives the batch result; a restart adds nothing."""

import os
import shutil

from offerframe.operators import merge as M
from offerframe.sources import offermap as OM
from offerframe.sources import snapshots as SN
from offerframe.streaming import ingest


def _write_map(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "url string, category string")
    return OM.write_offer_map(df, folder, name)


def test_stream_equals_batch_and_restart(spark, tmp_root):
    src = os.path.join(tmp_root, "incoming")
    staging = os.path.join(tmp_root, "staging")
    os.makedirs(src)
    u = "https://www.olx.pl/d/"
    batches = [[(u + "1.html", "-25"), (u + "2.html", "25-40")],
               [(u + "2.html", "150-"), (u + "3.html", "40-50"), ("https://olx.pl/x.html", "-25")]]
    table = os.path.join(tmp_root, "table")
    ckpt = os.path.join(tmp_root, "ckpt")
    for i, rows in enumerate(batches):
        p = _write_map(spark, staging, f"202401010{i}00", rows)
        for f in os.listdir(p):
            if f.startswith("part-"):
                shutil.copy(os.path.join(p, f), os.path.join(src, f"{i}-{f}"))
        q = ingest.ingest_offer_maps(spark, src, table, ckpt)
        q.awaitTermination()
    streamed = sorted(SN.read_snapshot(spark, table).collect())

    allrows = [r for b in batches for r in b]
    batch_in = OM.read_offer_map(spark, _write_map(spark, staging, "all", allrows))
    # batch equivalent: merge the two files in arrival order
    first = M.merge_fill_unknown(SN.empty_table(spark), OM.read_offer_map(
        spark, _write_map(spark, staging, "b0", batches[0]))).drop("change")
    second = M.merge_fill_unknown(first, OM.read_offer_map(
        spark, _write_map(spark, staging, "b1", batches[1]))).drop("change")
    assert streamed == sorted(SN.conform(second).collect())
    assert batch_in.count() == 5

    before = SN.current_version(spark, table)
    q = ingest.ingest_offer_maps(spark, src, table, ckpt)
    q.awaitTermination()
    assert SN.current_version(spark, table) == before
    assert sorted(SN.read_snapshot(spark, table).collect()) == streamed


def test_stream_bucketed_versions(spark, tmp_root):
    src = os.path.join(tmp_root, "incoming")
    os.makedirs(src)
    u = "https://www.olx.pl/d/"
    p = _write_map(spark, os.path.join(tmp_root, "staging"), "202401010000",
                   [(u + "1.html", "-25"), (u + "2.html", "25-40")])
    for f in os.listdir(p):
        if f.startswith("part-"):
            shutil.copy(os.path.join(p, f), os.path.join(src, f))
    table = os.path.join(tmp_root, "table")
    q = ingest.ingest_offer_maps(spark, src, table, os.path.join(tmp_root, "ckpt"),
                                 bucketed=("offers_stream_test", 8))
    q.awaitTermination()
    rows = SN.read_bucketed(spark, table, "offers_stream_test").collect()
    assert sorted(r.url for r in rows) == [u + "1.html", u + "2.html"]


def test_stream_keeps_unusable_lines(spark, tmp_root):
    src = os.path.join(tmp_root, "incoming")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write('{"https://www.olx.pl/d/1.html": {"size_category": "-25"}}\n')
        f.write('{broken\n')
    table = os.path.join(tmp_root, "table")
    q = ingest.ingest_offer_maps(spark, src, table, os.path.join(tmp_root, "ckpt"))
    q.awaitTermination()
    assert [r.url for r in SN.read_snapshot(spark, table).collect()] == ["https://www.olx.pl/d/1.html"]
    bad = spark.read.parquet(ingest.rejects_root(table)).collect()
    assert [r.raw for r in bad] == ["{broken"]


def _files(src, lists, first=0):
    os.makedirs(src, exist_ok=True)
    for i, rows in enumerate(lists, first):
        path = os.path.join(src, f"{i:03d}.txt")
        with open(path, "w") as f:
            f.writelines('{"%s": {"size_category": "%s", "is_active": %s}}\n' % r for r in rows)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_ingest_on_an_existing_table_keeps_its_rows(spark, tmp_root):
    from offerframe.plans import jobs

    table, u = os.path.join(tmp_root, "table"), "https://www.olx.pl/d/"
    p = _write_map(spark, os.path.join(tmp_root, "maps"), "202401010000", [(u + "old.html", "-25")])
    jobs.load_offer_map(spark, p, table)
    jobs.load_offer_map(spark, p, table)
    src = os.path.join(tmp_root, "in")
    _files(src, [[(u + "new.html", "-25", "true")]])
    for ckpt in ("c1", "c2"):  # a second stream with a checkpoint of its own reads the same file
        ingest.ingest_offer_maps(spark, src, table, os.path.join(tmp_root, ckpt)).awaitTermination()
    assert sorted(r.url for r in SN.read_snapshot(spark, table).collect()) == [u + "new.html", u + "old.html"]
    assert SN.finished_versions(spark, table) == [1, 2, 3, 4]
    assert SN.read_snapshot(spark, table, 1).count() == 1


def test_result_does_not_depend_on_batches(spark, tmp_root):
    import random

    u = "https://www.olx.pl/d/"
    for policy in ("fill_unknown", "conditional"):
        for seed in range(2):
            rng = random.Random(seed)
            lists = [[(u + f"{rng.randrange(4)}.html", rng.choice(["-25", "25-40", "150-"]), rng.choice(["true", "false", "0", "1"]))
                      for _ in range(rng.randrange(1, 5))] for _ in range(4)]
            got = []
            for size in (1, 3, 10):
                root = os.path.join(tmp_root, f"{policy}-{seed}-{size}")
                _files(f"{root}/in", lists)
                ingest.ingest_offer_maps(spark, f"{root}/in", f"{root}/t", f"{root}/c", policy, max_files=size).awaitTermination()
                got.append(sorted(SN.read_snapshot(spark, f"{root}/t").collect()))
            assert got[0] == got[1] == got[2], (policy, seed)


def test_page_table_streams_as_file_and_as_folder(spark, tmp_root):
    from offerframe.plans import catalog

    page = "<html><head><title>t</title></head><body><h1>x</h1></body></html>"
    pages = spark.createDataFrame([(k, f"https://{'www.' if k % 2 else ''}a{k}.example.com/en/{k}", page) for k in range(6)],
                                  "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_root}/folder/pages.parquet")
    pages.coalesce(1).write.parquet(f"{tmp_root}/one")
    os.makedirs(f"{tmp_root}/file")
    part = next(f for f in os.listdir(f"{tmp_root}/one") if f.endswith(".parquet"))
    shutil.copy(f"{tmp_root}/one/{part}", f"{tmp_root}/file/pages.parquet")
    for kind in ("folder", "file"):
        counts = catalog.stream_counts(spark, f"{tmp_root}/{kind}").first()
        assert counts.pages == 6 and counts.quarantined >= 3
        refused = catalog.stream_quarantine(spark, f"{tmp_root}/{kind}").where("reason = 'no www. in url'")
        assert sorted(r.page_id for r in refused.collect()) == [0, 2, 4]


def test_a_stream_without_batches_has_counts_and_no_rejects(spark, tmp_root):
    assert tuple(ingest.stream_counts(spark, f"{tmp_root}/t").first()) == (0,) * 6
    assert ingest.page_rejects(spark, f"{tmp_root}/t").collect() == []
