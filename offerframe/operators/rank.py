"""Row numbers inside groups without putting a group into one task.

`Window.partitionBy(group)` sends each whole group to one task; when one
group holds a third of the rows that task holds a third of the data.  Here
the rows are range-partitioned on (group, order keys), so a hot group is
spread over many partitions, and numbered in three steps:

1. position of each row inside its sorted partition
   (`monotonically_increasing_id` after `sortWithinPartitions`);
2. a small table of (partition, group) -> first position and row count,
   at most partitions x groups rows, turned into per-group offsets with a
   window that sees at most `partitions` rows per group;
3. join the offsets back and add them up.  The offsets are written first
   and their rows counted: up to `SMALL_ROWS` they are sent to every task, so
   the placed rows are not shuffled again; more are joined by shuffle.

The order keys must be total (end with a unique column) so ties cannot
make the numbering depend on fetch order.

The placed rows (with partition id and position) are written once to the
shared checkpoint folder and both steps read that copy.  This is required,
not an optimisation: the range partitioner draws its sample with a seed
taken from the RDD id, so two executions of the same plan can cut the key
range differently, and statistics from one run would not fit rows placed
by another.  The copy also cuts the lineage (executor loss re-reads files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


SMALL_ROWS = 500_000  # rows of a few numbers that are sent to every task


def sent_if_small(df: DataFrame, name: str) -> DataFrame:
    """A small table written, counted, and marked for broadcast up to `SMALL_ROWS` rows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    return F.broadcast(out) if out.count() <= SMALL_ROWS else out


TASK_ROWS = 5_000  # narrow rows of which each makes much work, in one task


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Narrow rows dealt out evenly, about `task_rows` to a task.

    Spark cuts a scan by bytes, so a table of millions of narrow rows is one task or a few, and
    what is made of these rows stays there.  For rows that are short as yet; counted first."""
    return df.repartition(max(1, -(-df.count() // task_rows)))


def place(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
          num_partitions: int | None = None) -> DataFrame:
    """Range-partition on (group, order), note each row's partition and its
    position inside the sorted partition, write once, read back."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(g) for g in group_cols] + order
    placed = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    placed = placed.withColumn(
        "_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_mid")
    path = shared_dir(spark, "rank")
    placed.write.parquet(path)
    return spark.read.parquet(path)


def number_placed(placed: DataFrame, group_cols: list[str], rank_col: str = "rank",
                  size_col: str | None = None) -> DataFrame:
    """Row numbers for rows written by `place` (offsets from a small table)."""
    stats = placed.groupBy("_pid", *group_cols).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if size_col:
        stats = stats.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    stats = stats.drop("_cnt")
    renamed = {g: f"_g_{i}" for i, g in enumerate(group_cols)}
    stats = stats.withColumnRenamed("_pid", "_spid")
    for g, r in renamed.items():
        stats = stats.withColumnRenamed(g, r)

    stats = sent_if_small(stats, "rank-offsets")
    cond = F.col("_pid") == F.col("_spid")
    for g, r in renamed.items():
        cond = cond & F.col(g).eqNullSafe(F.col(r))
    out = (placed.join(stats, on=cond, how="inner")
           .withColumn(rank_col, F.col("_offset") + F.col("_pos") - F.col("_first") + 1))
    return out.drop("_pid", "_spid", "_pos", "_first", "_offset", *renamed.values())


def rank_within(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                num_partitions: int | None = None, rank_col: str = "rank",
                size_col: str | None = None) -> DataFrame:
    """Add `rank_col` = 1-based row number inside each group by `order_cols`.

    `size_col`, when given, also gets the group's row count.
    """
    placed = place(df, group_cols, order_cols, num_partitions)
    return number_placed(placed, group_cols, rank_col, size_col)
