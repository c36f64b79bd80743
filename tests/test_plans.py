"""Plan shape: what the scale claims in the README rest on."""

import __spark_entry__ as E
from offerframe.operators import extract as X
from offerframe.profiles import SYNTHETIC_PAGE_RULES

SF = "/root/testdata/sf0.001"


def nodes(plan):
    """All physical nodes (AQE wrappers unwrapped)."""
    out, todo = [], [plan]
    while todo:
        n = todo.pop()
        out.append(n)
        name = n.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(n.executedPlan())
            continue
        children = n.children()
        for i in range(children.size()):
            todo.append(children.apply(i))
    return out


def physical(df):
    return df._jdf.queryExecution().executedPlan()


def exchanges(df):
    return [n for n in nodes(physical(df)) if "Exchange" in n.nodeName()]


def test_html_never_shuffled(spark):
    for name in ("links_extracted", "links_absolute", "links_overlay", "links_tagged", "links_reconcile",
                 "links_distinct", "band_requests", "page_website", "page_heading", "page_status",
                 "page_offers", "parse_counts", "offers_from_map"):
        df = E.queries()[name](spark, SF)
        for ex in exchanges(df):
            names = ex.output().toString()
            assert "html#" not in names, (name, ex.nodeName(), names)


def test_page_parsing_has_no_shuffle_on_big_inputs(spark):
    # A scan with enough splits is not redistributed; parsing is projections only.
    pages = spark.read.parquet(f"{SF}/pages.parquet").repartition(64)
    out = X.parse_pages(pages, SYNTHETIC_PAGE_RULES)
    kinds = [n.nodeName() for n in nodes(physical(out))]
    assert kinds.count("ShuffleExchange") <= 1  # only the repartition above
    assert not any("Join" in k for k in kinds)


def test_band_match_is_a_projection(spark):
    for name in ("band_counts", "band_last_wins"):
        kinds = [n.nodeName() for n in nodes(physical(E.queries()[name](spark, SF)))]
        assert not any("Join" in k for k in kinds), (name, kinds)


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(E.queries()["upsert_overwrite"](spark, SF)).toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "LessThanOrEqual(p_size,30)" in ln]
    assert scans, plan
    schema = scans[0].split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"p_partkey", "p_name", "p_size", "p_retailprice"}


def test_rank_never_windows_over_raw_rows(spark):
    # The only windows in the skew-safe ranking run over the small
    # (partition, group) statistics table, never over the data rows.
    df = E.queries()["band_price_order"](spark, SF)
    for n in nodes(physical(df)):
        if n.nodeName() == "Window":
            assert "_cnt" in n.toString(), n.toString()[:300]


def test_bucketed_base_is_not_shuffled_in_a_merge(spark, tmp_root):
    from offerframe.operators import merge as M
    from offerframe.plans import fixtures as FX
    from offerframe.sources import snapshots as SN
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = FX.merge_base(spark, "/root/testdata/sf0.01")
    SN.write_bucketed(base, tmp_root, "offers_test", buckets)
    table = SN.read_bucketed(spark, tmp_root, "offers_test")
    out = M.upsert_overwrite(table, FX.record_updates(spark, "/root/testdata/sf0.01"), "seq")
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan_lines = [ln for ln in plan.splitlines() if "offers_test" in ln and "Scan" in ln]
    assert scan_lines and "SelectedBucketsCount" in scan_lines[0]
    # exchanges only on the update side: none directly above the bucketed scan
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(url" in ln]
    assert len(exchanges) == 1, plan
