"""Continuous ingest (M9) with Structured Streaming.

The original hands records from scrapers to one writer through queues.
Here a file stream replaces the queues and `foreachBatch` runs the merge:

    new files -> micro-batch -> merge with the current version -> next version

A batch builds on the table as it is, whoever wrote it last, and rewrites only
the hash buckets its records fall into.  The newest version notes the last batch
of every stream (its checkpoint); a batch replayed after a failure is found there
and not applied twice, and the checkpoint records what was consumed, so a
restart adds nothing.

Records are applied in one order -- modification time and path of the file,
then place in the file -- inside a batch as across batches, so the result does
not depend on how files fall into batches.  `trigger(availableNow=True)`
drains what is there and stops -- the batch equivalent -- while a
processing-time trigger keeps it running.

Nothing is dropped: what the table cannot take is written, with its reason,
below `_rejects/` next to the table, per stream and batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_TLD_TOKEN
from ..operators import extract as X
from ..operators import merge as M
from ..profiles import PageRules
from ..schema import PAGES
from ..sources import buckets as BK
from ..sources import fs
from ..sources import jsonsplit as JS
from ..sources import offermap as OM
from ..sources import snapshots as SN


def stream_name(checkpoint: str) -> str:
    """Short name of a stream: its checkpoint folder, hashed."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def rejects_root(table_root: str) -> str:
    return f"{table_root.rstrip('/')}/_rejects/stream"


@dataclass(frozen=True)
class Turn:
    """A micro-batch ready to be merged: its records, what is rejected whatever the table holds, how the
    records change the touched rows, and which of them those rows keep out."""

    records: DataFrame
    rejects: DataFrame
    merge: Callable[[DataFrame], DataFrame]
    kept_out: Callable[[DataFrame], DataFrame] | None = None


def _batch_writer(table_root: str, checkpoint: str, prepare: Callable[[DataFrame, str, str], Turn],
                  bucketed: tuple[str, int] | None = None):
    """`prepare(batch, work folder, place)` -> Turn; applied once per batch.

    A batch reads and rewrites only the buckets its records fall into.  With
    `bucketed=(name, n)` versions are catalog tables bucketed by url instead, so a
    merge shuffles only the micro-batch."""
    stream = stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if SN.last_batch(spark, table_root, stream) >= batch_id:
            return
        place = f"stream={stream}/batch_id={batch_id}"
        turn = prepare(batch, f"{table_root.rstrip('/')}/_work/{place}", place)
        base = None if bucketed else BK.touched_base(spark, table_root, turn.records)
        rows = SN.read_bucketed(spark, table_root, bucketed[0]) if bucketed else base.df
        rejects = turn.rejects if turn.kept_out is None else turn.rejects.unionByName(turn.kept_out(rows))
        # Rejects first: a batch that has its version has them too.
        rejects.write.mode("overwrite").parquet(f"{rejects_root(table_root)}/{place}")
        if bucketed:
            SN.write_bucketed(turn.merge(rows), table_root, bucketed[0], bucketed[1], note=(stream, batch_id))
        else:
            BK.write_merged(turn.merge(rows), base, note=(stream, batch_id))
    return write


# Place of a page in the stream: file time, file, part of the file, place in the part.
_ORDER = ("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")


def offer_map_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """Offer-map files, of any layout, as a stream of pieces with their
    place (`sources.jsonsplit`); `max_files` bounds each micro-batch."""
    reader = spark.readStream.format("text").option("lineSep", "}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return JS.with_place(reader.load(source_dir))


def _map_merge(policy: str, tld_token: str):
    merge = {"fill_unknown": M.merge_fill_unknown, "conditional": M.merge_conditional}[policy]
    none = F.lit(None).cast("string")

    def prepare(batch: DataFrame, work: str, place: str) -> Turn:
        found = OM.offer_map_of(batch, work)
        return Turn(found.rows, found.rejects.select("raw", none.alias("url"), "reason"),
                    lambda rows: merge(rows, found.rows, "seq", tld_token).drop("change"),
                    lambda rows: M.merge_rejects(rows, found.rows, "seq", tld_token).select(none.alias("raw"), "url", "reason"))

    return prepare


def _start(stream: DataFrame, write, checkpoint: str, once: bool):
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()


def ingest_offer_maps(spark: SparkSession, source_dir: str, table_root: str,
                      checkpoint: str, policy: str = "fill_unknown", once: bool = True,
                      bucketed: tuple[str, int] | None = None, tld_token: str = DEFAULT_TLD_TOKEN,
                      max_files: int | None = None):
    """Merge every offer-map file arriving in `source_dir` into the table."""
    write = _batch_writer(table_root, checkpoint, _map_merge(policy, tld_token), bucketed)
    return _start(offer_map_stream(spark, source_dir, max_files), write, checkpoint, once)


def page_stream(spark: SparkSession, folder: str, file_glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """Stored pages as a file stream, each with its place; `max_files` bounds each micro-batch."""
    reader = spark.readStream.schema(PAGES)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).select("*", F.struct(F.struct(*_ORDER).alias("file"), "_metadata.row_index").alias("seq"))


COUNTS = "pages long, offers long, live long, dead long, expired long, quarantined long"


def counts_root(table_root: str) -> str:
    return f"{table_root.rstrip('/')}/_counts/stream"


def _page_merge(rules: PageRules, category: Callable[[Column], Column] | None, table_root: str):
    def prepare(batch: DataFrame, work: str, place: str) -> Turn:
        spark = batch.sparkSession
        tag = F.lit(None).cast("string") if category is None else category(F.col("html"))
        # Write the parsed batch before splitting it: a filter on extracted
        # fields would otherwise be pushed below the extraction and repeat
        # the HTML cleaning.  P13: the counts come from the same pass.
        counts = Observation("parse_counts")
        parsed = X.parse_pages(batch, rules, category=tag, keep=("page_id", "seq"))
        parsed.observe(counts, *X.parse_metrics()).write.mode("overwrite").parquet(work)
        # Stored under the batch's own place: a batch that is run again replaces its counts.
        (spark.createDataFrame([tuple(counts.get[c.split()[0]] for c in COUNTS.split(", "))], COUNTS)
         .write.mode("overwrite").parquet(f"{counts_root(table_root)}/{place}"))
        parsed = spark.read.parquet(work)
        good = parsed.filter(F.col("reason").isNull())
        return Turn(good, parsed.filter(F.col("reason").isNotNull()).select("page_id", "url", "reason"),
                    lambda rows: M.upsert_overwrite(rows, good, "seq"))

    return prepare


def _stored(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """What the batches have written below `root`; no rows where no batch has been."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


REJECTS = "page_id long, url string, reason string"


def page_rejects(spark: SparkSession, table_root: str) -> DataFrame:
    """The pages that gave no offer, over all batches of all streams of pages."""
    return _stored(spark, rejects_root(table_root), REJECTS).select("page_id", "url", "reason")


def stream_counts(spark: SparkSession, table_root: str) -> DataFrame:
    """P13 on M9: result counts over all batches of all streams, one row."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    stored = _stored(spark, counts_root(table_root), COUNTS)
    return stored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def ingest_pages(spark: SparkSession, folder: str, table_root: str, checkpoint: str, rules: PageRules,
                 category: Callable[[Column], Column] | None = None, once: bool = True,
                 file_glob: str | None = None, max_files: int | None = None):
    """Pages arriving in `folder` are parsed and upserted; pages that give no offer go to the rejects."""
    write = _batch_writer(table_root, checkpoint, _page_merge(rules, category, table_root))
    return _start(page_stream(spark, folder, file_glob, max_files), write, checkpoint, once)
