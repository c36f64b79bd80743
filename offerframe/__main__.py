"""Command line: the original tool's entry points as Spark jobs.

    python -m offerframe discover --pages P --out DIR
    python -m offerframe extract  --maps DIR --pages P --table DIR --quarantine DIR
    python -m offerframe load     --map PATH --table DIR [--policy fill_unknown|conditional]
    python -m offerframe analyse  --table DIR --out DIR
    python -m offerframe ingest   --source DIR --table DIR --checkpoint DIR [--continuous]

`--pages` is a Parquet table (page_id, url, html).  For `discover` the pages
are stored search-result pages; each one's size slice is read from its own
request URL (the inverse of the request builder).  Site rules default to
the original tool's values (offerframe.profiles).  On a cluster the
session comes from the environment (e.g. `PYSPARK_SUBMIT_ARGS` or a
`spark-submit` wrapper importing `offerframe.__main__.main`).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from .operators.bands import band_of_request
from .plans import jobs
from .profiles import REFERENCE_LINK_RULES, REFERENCE_PAGE_RULES
from .session import get_session
from .sources import pages as PG
from .sources import snapshots as SN
from .streaming import ingest


def _stamp() -> str:
    return dt.datetime.now().strftime("%Y%m%d%H%M")


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="offerframe")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("discover", help="result pages -> link list + offer map")
    d.add_argument("--pages", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--stamp", default=None)
    s = sub.add_parser("extract", help="newest offer map + stored pages -> offers table")
    s.add_argument("--maps", required=True)
    s.add_argument("--pages", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--quarantine", required=True)
    ld = sub.add_parser("load", help="merge an offer map into the table")
    ld.add_argument("--map", required=True)
    ld.add_argument("--table", required=True)
    ld.add_argument("--policy", default="fill_unknown", choices=["fill_unknown", "conditional"])
    an = sub.add_parser("analyse", help="counts, price box plots, completeness")
    an.add_argument("--table", required=True)
    an.add_argument("--out", required=True)
    ing = sub.add_parser("ingest", help="stream offer-map files into the table")
    ing.add_argument("--source", required=True)
    ing.add_argument("--table", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--policy", default="fill_unknown", choices=["fill_unknown", "conditional"])
    ing.add_argument("--continuous", action="store_true")
    ip = sub.add_parser("ingest-pages", help="stream stored pages into the table, with quarantine")
    ip.add_argument("--source", required=True)
    ip.add_argument("--table", required=True)
    ip.add_argument("--checkpoint", required=True)
    ip.add_argument("--continuous", action="store_true")
    for p in (s, ld, ing):
        p.add_argument("--table-name", default=None,
                       help="keep versions as catalog tables bucketed by url")
        p.add_argument("--buckets", type=int, default=None)
    args = ap.parse_args(argv)
    spark = get_session()
    bucketed = None
    if getattr(args, "table_name", None):
        bucketed = (args.table_name,
                    args.buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    if args.cmd == "discover":
        pages = PG.read_pages(spark, args.pages)
        band = band_of_request(F.col("url"))
        sliced = pages.select("url", "html", band["label"].alias("slice"),
                              band["ord"].alias("slice_ord")).filter(F.col("slice").isNotNull())
        out = jobs.discover_links(sliced, REFERENCE_LINK_RULES, args.out, args.stamp or _stamp())
        check = out["reconcile"].first().asDict()
        # pages whose URL is not a slice request are not result pages: kept by URL
        rejects = f"{args.out.rstrip('/')}/_rejects/discover_{out['stamp']}"
        (pages.filter(band.isNull()).select("page_id", "url", F.lit("url is no slice request").alias("reason"))
         .write.mode("overwrite").parquet(rejects))
        result = {"links": out["links"], "offers": out["offers"], "reconcile": check,
                  "pages_without_slice": spark.read.parquet(rejects).count(), "rejects": rejects}
    elif args.cmd == "extract":
        pages = PG.read_pages(spark, args.pages)
        out = jobs.extract_offers(spark, args.maps, pages, REFERENCE_PAGE_RULES,
                                  args.table, args.quarantine, bucketed=bucketed)
        result = {"map": out["map"], "version": out["version"], "counts": out["counts"], "parsed": out["parsed"]}
    elif args.cmd == "load":
        version = jobs.load_offer_map(spark, args.map, args.table, args.policy, bucketed=bucketed)
        rejects = jobs.rejects_path(args.table, version)
        result = {"version": version, "rejects": rejects, "rejected": spark.read.parquet(rejects).count()}
    elif args.cmd == "analyse":
        frames = jobs.analyse(SN.read_snapshot(spark, args.table))
        for name, df in frames.items():
            df.write.mode("overwrite").json(f"{args.out.rstrip('/')}/{name}")
        result = {"written": sorted(frames)}
    elif args.cmd == "ingest-pages":
        q = ingest.ingest_pages(spark, args.source, args.table, args.checkpoint, REFERENCE_PAGE_RULES,
                                once=not args.continuous)
        q.awaitTermination()
        result = {"version": SN.current_version(spark, args.table), "rejects": ingest.rejects_root(args.table)}
    else:
        q = ingest.ingest_offer_maps(spark, args.source, args.table, args.checkpoint,
                                     policy=args.policy, once=not args.continuous,
                                     bucketed=bucketed)
        q.awaitTermination()
        result = {"version": SN.current_version(spark, args.table)}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
