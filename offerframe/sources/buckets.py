"""Versions in hash buckets: a merge rewrites the buckets it touches and no others.

A row belongs to bucket `xxhash64(url) mod buckets`.  Every version has a
manifest, one row per file: bucket, path, rows, first and last url.  A merge

1. takes the buckets its records fall into (as many numbers as there are
   buckets, at most),
2. reads only those buckets' files of the current version,
3. writes the merged buckets as new files, sorted by url, and
4. writes a manifest that names the new files of these buckets and the old files
   of all others.

So an update costs what it touches: files of other buckets are neither read nor
written, and versions share them.  A version becomes visible by one small file
that can be created only once (`snapshots.finish`), numbered after the version it
was built on: of two merges into the same version one fails, writes nothing that
is read, and can be run again.

Keys are checked on the same pass: inside a bucket the rows are sorted by url, so
a url that is there twice stands next to itself.

The number of buckets is fixed by the first version (choose it so that a bucket is
100 to 200 MB when the table is full); a table of whole snapshots is taken over by
its first merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import OFFERS
from . import snapshots as SN

BUCKETS = 32


def bucket_of(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Base:
    """The part of a version that some records touch."""

    root: str
    version: int | None
    buckets: int
    manifest: DataFrame | None   # None: no version yet, or one that is a whole snapshot
    touched: tuple[int, ...]
    df: DataFrame


@dataclass(frozen=True)
class Merged:
    """A finished merge: its version and the touched part of the table before and after."""

    version: int
    before: DataFrame
    after: DataFrame


def touched_base(spark: SparkSession, root: str, records: DataFrame, buckets: int | None = None) -> Base:
    """The current version's rows in the buckets that the urls of `records` fall into."""
    root = root.rstrip("/")
    version = SN.current_version(spark, root)
    info = SN.version_info(spark, root, version)
    own = info.get("buckets") or buckets or BUCKETS
    found = records.where(F.col("url").isNotNull()).select(bucket_of(F.col("url"), own).alias("bucket")).distinct()
    touched = tuple(sorted(r["bucket"] for r in found.collect()))
    if "manifest" not in info:  # none yet, or a whole snapshot: all its rows go into buckets now
        every = tuple(range(own)) if version is not None else touched
        return Base(root, version, own, None, every, SN.read_snapshot(spark, root, version))
    manifest = SN.read_manifest(spark, root, info["manifest"])
    files = [r["file"] for r in manifest.where(F.col("bucket").isin(*touched)).select("file").collect()] if touched else []
    return Base(root, version, own, manifest, touched, SN.read_files(spark, root, files))


def key_neighbours(rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` by bucket, sorted by url inside it, with `_twice`: the row before has the same url.

    One exchange on the bucket serves the check, the order of the files and the write by bucket."""
    placed = rows.withColumn("bucket", bucket_of(F.col("url"), buckets)).repartition("bucket")
    return placed.withColumn("_twice", F.lag("url").over(Window.partitionBy("bucket").orderBy("url")) == F.col("url"))


def key_metrics() -> list[Column]:
    twice = F.coalesce(F.col("_twice"), F.lit(False))
    return [F.count(F.lit(1)).alias("n_rows"), F.count(F.when(twice, 1)).alias("n_repeated"),
            F.min(F.when(twice, F.col("url"))).alias("first_repeated")]


def write_rows(rows: DataFrame, path: str, buckets: int) -> dict:
    """Rows of the table written by bucket; counts of rows and repeated keys from the same pass."""
    seen = Observation("keys")
    placed = key_neighbours(SN.conform(rows), buckets)
    # Footer statistics and Bloom filters of the url let a lookup skip row groups.
    (placed.observe(seen, *key_metrics()).drop("_twice").write.partitionBy("bucket")
     .option("parquet.bloom.filter.enabled#url", "true").parquet(path))
    return seen.get


def file_rows(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """Manifest rows of the files in a folder of buckets (reads their urls only)."""
    rows = spark.read.schema(f"{OFFERS.simpleString()[7:-1].replace(':', ' ')}, bucket int").parquet(f"{root}/{folder}")
    return (rows.groupBy("bucket", F.col("_metadata.file_name").alias("name"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min("url").alias("low"), F.max("url").alias("high"))
            .select("bucket", F.concat(F.lit(f"{folder}/bucket="), F.col("bucket"), F.lit("/"), F.col("name")).alias("file"),
                    "rows", "low", "high"))


def write_merged(merged: DataFrame, base: Base, note: tuple[str, int] | None = None) -> Merged:
    """The next version: `merged` replaces the base's touched buckets."""
    spark, root = merged.sparkSession, base.root
    version = (base.version or 0) + 1
    name = f"{SN.version_name(version)}-{uuid.uuid4().hex[:8]}"  # a folder of its own for every attempt
    manifest = f"_manifests/{name}"
    if base.touched:
        keys = write_rows(merged, f"{root}/data/{name}", base.buckets)
        if keys["n_repeated"]:
            raise ValueError(f"the table would hold {keys['n_repeated']} rows of a url again, {keys['first_repeated']} among them")
        new = file_rows(spark, root, f"data/{name}")
    else:
        new = spark.createDataFrame([], SN.MANIFEST)
    if base.manifest is not None:
        kept = base.manifest.where(~F.col("bucket").isin(*base.touched)) if base.touched else base.manifest
        new = kept.unionByName(new)
    new.coalesce(1).write.parquet(f"{root}/{manifest}")
    SN.finish(spark, root, version, note, manifest=manifest, buckets=base.buckets)
    after = [r["file"] for r in SN.read_manifest(spark, root, manifest).where(F.col("file").startswith(f"data/{name}/")).collect()]
    return Merged(version, base.df, SN.read_files(spark, root, after))


def merge_into(spark: SparkSession, root: str, records: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
               note: tuple[str, int] | None = None, buckets: int | None = None) -> Merged:
    """The next version of the table: `merge(touched rows, records)` in place of the touched buckets."""
    base = touched_base(spark, root, records, buckets)
    return write_merged(merge(base.df, records), base, note)


def lookup(spark: SparkSession, root: str, keys: DataFrame, version: int | None = None) -> DataFrame:
    """M5 on a bucketed version: the rows of a key set, reading only files whose bucket and key range hold a key.

    Keys are reduced to (bucket, smallest and greatest key) first, so what is
    compared with the manifest is as long as the table has buckets."""
    version = SN.current_version(spark, root) if version is None else version
    info = SN.version_info(spark, root, version)
    wanted = keys.where(F.col("url").isNotNull()).select("url").distinct()
    if "manifest" not in info:
        return SN.read_snapshot(spark, root, version).join(wanted, "url", "left_semi")
    ends = (wanted.groupBy(bucket_of(F.col("url"), info["buckets"]).alias("bucket"))
            .agg(F.min("url").alias("first"), F.max("url").alias("last")))
    files = (SN.read_manifest(spark, root, info["manifest"]).join(ends, "bucket")
             .where((F.col("high") >= F.col("first")) & (F.col("low") <= F.col("last"))).select("file").collect())
    return SN.read_files(spark, root, [r["file"] for r in files]).join(wanted, "url", "left_semi")


def lookup_one(spark: SparkSession, root: str, url: str) -> DataFrame:
    """M5 for one key: the one file of its bucket whose range holds it, the filter pushed into its Bloom filter and statistics."""
    version = SN.current_version(spark, root)
    info = SN.version_info(spark, root, version)
    if "manifest" not in info:
        return SN.read_snapshot(spark, root, version).where(F.col("url") == F.lit(url))
    key = F.lit(url)
    files = (SN.read_manifest(spark, root, info["manifest"])
             .where((F.col("bucket") == bucket_of(key, info["buckets"])) & (F.col("low") <= key) & (F.col("high") >= key))
             .select("file").collect())
    return SN.read_files(spark, root, [r["file"] for r in files]).where(F.col("url") == key)
