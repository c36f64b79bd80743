"""Bucketed versions: what a merge touches, shares and checks; changes and counts."""

import os

import pytest
from pyspark.sql import functions as F

from offerframe.operators import changes as CH
from offerframe.operators import merge as M
from offerframe.operators import quality as Q
from offerframe.schema import OFFER_COLUMNS
from offerframe.sources import buckets as BK
from offerframe.sources import snapshots as SN

TYPES = ", ".join(f"{c} string" for c in OFFER_COLUMNS) + ", seq int"


def records(spark, urls, price="1", seq=1, category="-25"):
    rows = [(u, category, "olx", "7", price, "t", "l", "Yes", seq) for u in urls]
    return spark.createDataFrame(rows, TYPES)


def upsert(rows, new):
    return M.upsert_overwrite(rows, new, "seq")


def urls(n):
    return [f"https://www.olx.pl/d/{i}.html" for i in range(n)]


def manifest(spark, root):
    info = SN.version_info(spark, root, SN.current_version(spark, root))
    return {r.file: r for r in SN.read_manifest(spark, root, info["manifest"]).collect()}


def scanned(df):
    return {f.split("/data/")[1] for f in df.inputFiles()}


def test_a_merge_reads_and_writes_only_touched_buckets(spark, tmp_root):
    BK.merge_into(spark, tmp_root, records(spark, urls(400)), upsert, buckets=16)
    before = manifest(spark, tmp_root)
    assert sum(r.rows for r in before.values()) == 400 and len({r.bucket for r in before.values()}) == 16
    new = records(spark, urls(400)[7:9] + ["https://www.olx.pl/d/new.html"], price="2", seq=2)
    base = BK.touched_base(spark, tmp_root, new)
    assert 1 <= len(base.touched) <= 3
    assert scanned(base.df) == {f.split("data/")[1] for f, r in before.items() if r.bucket in base.touched}
    merged = BK.write_merged(upsert(base.df, new), base)
    after = manifest(spark, tmp_root)
    same = {f for f, r in before.items() if r.bucket not in base.touched}
    assert same <= set(after) and {r.bucket for f, r in after.items() if f not in same} == set(base.touched)
    assert all(f.startswith(os.path.dirname(os.path.dirname(next(iter(same))))) for f in same)
    assert merged.version == 2 and merged.after.count() == merged.before.count() + 1
    rows = {r.url: r.price for r in SN.read_snapshot(spark, tmp_root).collect()}
    assert len(rows) == 401 and sorted(u for u, p in rows.items() if p == "2") == sorted(r.url for r in new.collect())
    assert SN.read_snapshot(spark, tmp_root, 1).count() == 400  # the old version is as it was


def test_rounds_equal_one_merge_of_everything(spark, tmp_root):
    parts = [records(spark, urls(60)[k * 10:k * 10 + 30], price=str(k), seq=k) for k in range(4)]
    for part in parts:
        BK.merge_into(spark, tmp_root, part, upsert, buckets=4)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    whole = SN.conform(upsert(SN.empty_table(spark), every))
    assert sorted(SN.read_snapshot(spark, tmp_root).collect()) == sorted(whole.collect())


def test_a_table_of_snapshots_is_taken_over(spark, tmp_root):
    SN.write_snapshot(records(spark, urls(20)).drop("seq"), tmp_root, note=("s", 4))
    BK.merge_into(spark, tmp_root, records(spark, urls(22)[20:], seq=2), upsert, note=("t", 1))
    assert SN.read_snapshot(spark, tmp_root).count() == 22 and SN.finished_versions(spark, tmp_root) == [1, 2]
    assert SN.last_batch(spark, tmp_root, "s") == 4 and SN.last_batch(spark, tmp_root, "t") == 1
    SN.write_snapshot(SN.read_snapshot(spark, tmp_root), tmp_root)
    assert SN.read_snapshot(spark, tmp_root).count() == 22 and SN.last_batch(spark, tmp_root, "s") == 4


def test_nothing_to_merge_makes_a_version_without_files(spark, tmp_root):
    BK.merge_into(spark, tmp_root, records(spark, urls(5)), upsert)
    before = manifest(spark, tmp_root)
    BK.merge_into(spark, tmp_root, records(spark, []), upsert, note=("s", 0))
    assert manifest(spark, tmp_root) == before and SN.read_snapshot(spark, tmp_root).count() == 5
    other = os.path.join(tmp_root, "other")
    BK.merge_into(spark, other, records(spark, []), upsert)
    assert SN.read_snapshot(spark, other).count() == 0 and SN.current_version(spark, other) == 1


def test_of_two_merges_into_one_version_one_fails_and_can_run_again(spark, tmp_root):
    BK.merge_into(spark, tmp_root, records(spark, urls(5)), upsert)
    one, two = records(spark, urls(1), price="a", seq=2), records(spark, urls(1), price="b", seq=3)
    bases = [BK.touched_base(spark, tmp_root, r) for r in (one, two)]
    BK.write_merged(upsert(bases[0].df, one), bases[0])
    with pytest.raises(Exception, match="(?i)exist"):
        BK.write_merged(upsert(bases[1].df, two), bases[1])
    assert SN.read_snapshot(spark, tmp_root).where("price = 'a'").count() == 1
    BK.merge_into(spark, tmp_root, two, upsert)
    assert SN.read_snapshot(spark, tmp_root).where("price = 'b'").count() == 1


def test_repeated_keys_are_seen_by_the_write_and_never_become_a_version(spark, tmp_root):
    rows = records(spark, urls(30) + urls(3)).drop("seq")
    base = BK.touched_base(spark, tmp_root, rows)
    with pytest.raises(ValueError, match="3 rows of a url again"):
        BK.write_merged(rows, base)
    assert SN.current_version(spark, tmp_root) is None
    plan = BK.key_neighbours(SN.conform(rows), 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1  # the exchange that deals the rows to their buckets


def test_lookup_reads_only_files_that_may_hold_a_key(spark, tmp_root):
    BK.merge_into(spark, tmp_root, records(spark, urls(300)), upsert, buckets=16)
    files = manifest(spark, tmp_root)
    one = BK.lookup_one(spark, tmp_root, urls(300)[42])
    assert one.count() == 1 and len(one.inputFiles()) == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(url" in plan
    assert BK.lookup_one(spark, tmp_root, "https://www.olx.pl/zzz").count() == 0
    keys = spark.createDataFrame([(u,) for u in urls(300)[:3]] + [(None,), ("https://zzz",)], "url string")
    got = BK.lookup(spark, tmp_root, keys)
    assert sorted(r.url for r in got.collect()) == sorted(urls(3)) and len(got.inputFiles()) < len(files)
    assert BK.lookup(spark, tmp_root, keys.limit(0)).count() == 0
    assert BK.lookup(spark, os.path.join(tmp_root, "none"), keys).count() == 0


def test_counts_from_changes_equal_a_recount(spark, tmp_root):
    counts = spark.createDataFrame([], CH.COUNTS)
    rounds = [records(spark, urls(50)), records(spark, urls(60)[30:], category="Unknown", price="No data", seq=2),
              records(spark, urls(40)[35:], category="150-", seq=3), records(spark, [])]
    for part in rounds:
        merged = BK.merge_into(spark, tmp_root, part, upsert, buckets=8)
        feed = CH.change_feed(merged.before, merged.after)
        counts = CH.add_counts(counts, CH.count_changes(CH.signed_images(feed)))
        table = SN.read_snapshot(spark, tmp_root)
        assert sorted(counts.collect()) == sorted(CH.recount(table).collect())
    shares = lambda df: sorted(map(str, df.collect()))
    done = Q.completeness(table)
    assert shares(CH.completeness_of(counts).select(*done.columns)) == shares(done)


def test_change_feed_has_both_images_of_changed_rows_only(spark):
    a = records(spark, urls(3)).drop("seq")
    b = a.where(F.col("url") != urls(1)[0]).withColumn("price", F.when(F.col("url") == urls(3)[2], "9").otherwise(F.col("price")))
    feed = {r.url: (r.before and r.before.price, r.after and r.after.price) for r in CH.change_feed(a, b).collect()}
    assert feed == {urls(1)[0]: ("1", None), urls(3)[2]: ("1", "9")}
