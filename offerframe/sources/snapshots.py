"""The offers table as versioned Parquet snapshots.

Parquet cannot be overwritten while it is read, and MERGE needs a table
format this build does not ship, so every change writes a new version
`v00000001, v00000002, ...` under the table root and, once it is complete,
creates a small file `_versions/v0000000N` for it.  Nothing is ever replaced:
a version whose folder exists is not written again, the current version is the
greatest one that has its file, and readers never see a half-written one.  Of
two writers of one version the second fails (its write of the folder, or of
the file) and can merge again into the new current version.

The file is one line of JSON.  `notes` has the last batch of every stream that
has written to the table; each version takes them over from the one before, so a
batch replayed after a failure is found to be applied by reading one file, however
old the table is.  `manifest` is there for a version kept in hash buckets (see
`sources.buckets`): the files the version consists of, older ones among them.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import OFFER_COLUMNS, OFFER_DEFAULTS, OFFERS
from . import fs

VERSIONS = "_versions"


def version_name(n: int) -> str:
    return f"v{n:08d}"


def finished_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    return sorted(int(e.name[1:]) for e in fs.list_entries(spark, f"{root.rstrip('/')}/{VERSIONS}")
                  if re.fullmatch(r"v[0-9]{8}", e.name))


def current_version(spark: SparkSession, root: str) -> int | None:
    """The greatest complete version; None for a table that was never written."""
    done = finished_versions(spark, root)
    return done[-1] if done else None


def version_info(spark: SparkSession, root: str, version: int | None) -> dict:
    """What the file of a version says; {} for no version."""
    if version is None:
        return {}
    text = fs.read_small_text(spark, f"{root.rstrip('/')}/{VERSIONS}/{version_name(version)}") or "{}"
    if text.startswith("{"):
        return json.loads(text)
    stream, _, batch = text.rpartition("/")  # a file of an earlier layout: the note alone
    return {"notes": {stream: int(batch)}}


def last_batch(spark: SparkSession, root: str, stream: str) -> int:
    """The last batch of `stream` that is in the table (-1: none)."""
    return version_info(spark, root, current_version(spark, root)).get("notes", {}).get(stream, -1)


def _next_version(spark: SparkSession, root: str) -> int:
    """The first number above every version folder, complete or left by a failed write."""
    taken = [int(e.name[1:]) for e in fs.list_entries(spark, root) if re.fullmatch(r"v[0-9]{8}", e.name)]
    return max([0, *taken, *finished_versions(spark, root)]) + 1


def finish(spark: SparkSession, root: str, version: int, note: tuple[str, int] | None = None, **more) -> int:
    """Make a version complete; `note` is (stream, batch).  Fails if it is complete already."""
    root = root.rstrip("/")
    notes = dict(version_info(spark, root, current_version(spark, root)).get("notes", {}))
    if note:
        notes[note[0]] = note[1]
    fs.create_small_text(spark, f"{root}/{VERSIONS}/{version_name(version)}", json.dumps({"notes": notes, **more}))
    return version


def nonconforming(df: DataFrame) -> DataFrame:
    """Rows the table cannot hold, with the reason: they belong in a rejects output."""
    return (df.filter(F.col("url").isNull() | F.col("website").isNull())
            .select(F.col("url").cast("string").alias("url"),
                    F.when(F.col("url").isNull(), F.lit("no url")).otherwise(F.lit("no www. in url")).alias("reason")))


def conform(df: DataFrame) -> DataFrame:
    """The declared table shape -- column order, defaults where a value
    is missing, `url` and `website` required (rows without them belong in
    a quarantine, not in the table)."""
    cols = []
    for c in OFFER_COLUMNS:
        if c in OFFER_DEFAULTS:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit(OFFER_DEFAULTS[c])).alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols).filter(F.col("url").isNotNull() & F.col("website").isNotNull())


def duplicate_keys(df: DataFrame, key: str = "url") -> DataFrame:
    """Keys that occur more than once (empty for a valid table)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def write_snapshot(df: DataFrame, root: str, check_keys: bool = False,
                   note: tuple[str, int] | None = None) -> int:
    """Write `df` as the next version; returns its number."""
    spark = df.sparkSession
    root = root.rstrip("/")
    version = _next_version(spark, root)
    out = conform(df)
    if check_keys and duplicate_keys(out).limit(1).count() > 0:
        raise ValueError("offers snapshot would hold a url twice")
    # Sorted by url inside each file (a local sort, no extra shuffle): row
    # group min/max statistics then let a key lookup skip most of a file.
    out.sortWithinPartitions("url").write.mode("errorifexists").parquet(f"{root}/{version_name(version)}")
    return finish(spark, root, version, note)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Scan one version (the current one by default) with the declared
    schema; Catalyst prunes columns and pushes filters into the scan."""
    root = root.rstrip("/")
    if version is None:
        version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], OFFERS)
    manifest = version_info(spark, root, version).get("manifest")
    if manifest:
        return read_files(spark, root, [r["file"] for r in read_manifest(spark, root, manifest).select("file").collect()])
    return spark.read.schema(OFFERS).parquet(f"{root}/{version_name(version)}")


# One row per file of a version: its bucket, its path below the table root, its rows and its first and last url.
MANIFEST = "bucket int, file string, rows long, low string, high string"


def read_manifest(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/{manifest}")


def read_files(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """The offers in some files of a table (their names are what Spark's own scan keeps on the driver)."""
    if not files:
        return spark.createDataFrame([], OFFERS)
    return spark.read.schema(OFFERS).parquet(*[f"{root.rstrip('/')}/{f}" for f in sorted(files)])


def empty_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OFFERS)


# --- bucketed versions: co-located merges ------------------------------------
# With a catalog (a metastore on a cluster, the session catalog in tests) a
# version can be saved bucketed and sorted by `url`.  A later merge then
# reads the base already hash-partitioned by `url`: only the (much smaller)
# update side is shuffled, the base is joined where it lies.


def bucketed_name(name: str, version: int) -> str:
    return f"{name}_{version_name(version)}"


def write_bucketed(df: DataFrame, root: str, name: str, buckets: int,
                   note: tuple[str, int] | None = None) -> int:
    """Write `df` as the next version of catalog table `name`, bucketed by
    url into `buckets` (match `spark.sql.shuffle.partitions`), data under
    `root`; finished like `write_snapshot`."""
    spark = df.sparkSession
    root = root.rstrip("/")
    version = _next_version(spark, root)
    (conform(df).write.mode("errorifexists").bucketBy(buckets, "url").sortBy("url")
     .option("path", f"{root}/{version_name(version)}")
     .saveAsTable(bucketed_name(name, version)))
    return finish(spark, root, version, note)


def read_bucketed(spark: SparkSession, root: str, name: str,
                  version: int | None = None) -> DataFrame:
    version = version if version is not None else current_version(spark, root.rstrip("/"))
    if version is None:
        return empty_table(spark)
    return spark.table(bucketed_name(name, version))
