"""Skew check: largest task input of skew-safe ranking vs a plain window.

    python tools/skew_check.py [rows] [partitions]

Builds rows with Spark (`range`), one group holding a third of them, ranks
inside groups both ways, and reads per-task shuffle records from the event
log (written to a fresh scratch folder).  Prints one JSON line.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from offerframe.operators.rank import rank_within  # noqa: E402


def max_task_records(log_dir: str) -> dict[int, int]:
    """job group id -> largest shuffle-records-read of any task."""
    out: dict[int, int] = {}
    stage_job: dict[int, int] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                tag = (ev.get("Properties") or {}).get("spark.job.description", "")
                if tag.startswith("skew:"):
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = int(tag.split(":")[1])
            elif kind == "SparkListenerTaskEnd":
                sid = ev["Stage ID"]
                if sid not in stage_job:
                    continue
                m = ev.get("Task Metrics") or {}
                rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                out[stage_job[sid]] = max(out.get(stage_job[sid], 0), rd)
    return out


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", str(parts))
             .config("spark.sql.adaptive.enabled", "true")
             # measure the partitioning itself, not AQE's merging of small
             # partitions up to its byte target
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-ckpt-"))
    df = spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 1000).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 100003).cast("double").alias("x"))

    spark.sparkContext.setJobDescription("skew:1")
    safe = rank_within(df, ["g"], ["x", "id"], num_partitions=parts)
    safe.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("skew:2")
    w = Window.partitionBy("g").orderBy("x", "id")
    df.withColumn("rank", F.row_number().over(w)).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    got = max_task_records(log_dir)
    print(json.dumps({"rows": rows, "hot_group_rows": rows // 3 + (rows % 3 > 0), "partitions": parts,
                      "max_task_shuffle_records_rank_within": got.get(1),
                      "max_task_shuffle_records_window": got.get(2)}))


if __name__ == "__main__":
    main()
