"""Analysis over the offers table.

Counts are partial aggregates.  Quartiles are exact (linear interpolation,
the `percentile` / `quantile_cont` definition) but computed without giving
a whole group to one task: rows are numbered inside their group with the
range-partitioned `rank_within`, then only the (at most two) rows around
each quartile position are kept.  Quartiles from sketches that are kept up to
date instead of rescanned are in `operators.sketches`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import strict_number
from .rank import number_placed, place, sent_if_small

QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
WHISKER = 1.5


def value_counts(df: DataFrame, col: str, count_col: str = "n_offers") -> DataFrame:
    """A1/A2: rows per value, most first; NULL values are not counted."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc(col)))


def with_price_numeric(df: DataFrame, price_col: str = "price",
                       out_col: str = "price_numeric") -> DataFrame:
    """A3: text -> double by the strict rule; unparseable -> NULL."""
    return df.withColumn(out_col, strict_number(F.col(price_col)))


def numeric_only(df: DataFrame, col: str = "price_numeric") -> DataFrame:
    """A5: rows with a usable number."""
    return df.filter(F.col(col).isNotNull())


def exact_quantiles(df: DataFrame, group_col: str, value_col: str, tiebreak: str,
                    probs=QUARTILES, num_partitions: int | None = None) -> DataFrame:
    """Exact, interpolated quantiles per group: (group, n, <name>...)."""
    return _quantiles_and_values(df, group_col, value_col, tiebreak, probs, num_partitions)[0]


def _quantiles_and_values(df, group_col, value_col, tiebreak, probs, num_partitions):
    """Quantile table plus the written (group, value) rows it came from, so
    a second pass reads that narrow copy instead of the source again."""
    base = df.select(group_col, value_col, tiebreak).filter(F.col(value_col).isNotNull())
    placed = place(base, [group_col], [F.col(value_col), F.col(tiebreak)], num_partitions)
    ranked = number_placed(placed, [group_col], rank_col="_r", size_col="_n")
    # position p*(n-1) (0-based) -> 1-based ranks lo = floor+1, hi = ceil+1
    pos = {name: F.lit(p) * (F.col("_n") - 1) for name, p in probs}
    lo = {name: F.floor(e) + 1 for name, e in pos.items()}
    hi = {name: F.ceil(e) + 1 for name, e in pos.items()}
    wanted = None
    for name in pos:
        cond = (F.col("_r") == lo[name]) | (F.col("_r") == hi[name])
        wanted = cond if wanted is None else wanted | cond
    picked = ranked.filter(wanted)
    aggs = [F.first("_n").alias("n")]
    for name, e in pos.items():
        aggs += [F.max(F.when(F.col("_r") == lo[name], F.col(value_col))).alias(f"_{name}_lo"),
                 F.max(F.when(F.col("_r") == hi[name], F.col(value_col))).alias(f"_{name}_hi"),
                 F.first(e - F.floor(e)).alias(f"_{name}_frac")]
    g = picked.groupBy(group_col).agg(*aggs)
    out = [group_col, "n"]
    for name, _ in probs:
        a, b, d = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_frac")
        out.append((a + d * (b - a)).alias(name))
    return g.select(*out), placed.select(group_col, value_col)


def boxplot(df: DataFrame, group_col: str, value_col: str, tiebreak: str,
            digits: int | None = 4, num_partitions: int | None = None) -> DataFrame:
    """A4: box-plot data per group.

    n, q1, median, q3, iqr, whiskers (extreme values inside the 1.5 IQR
    fences), outlier counts below/above.  The quartile table (one row per
    group) is joined to the values once -- AQE broadcasts it when small --
    and a single partial aggregate yields everything else.
    """
    v = F.col(value_col)
    q, data = _quantiles_and_values(df, group_col, value_col, tiebreak, QUARTILES, num_partitions)
    data = data.filter(F.col(group_col).isNotNull())
    iqr = F.col("q3") - F.col("q1")
    lo_fence, hi_fence = F.col("q1") - WHISKER * iqr, F.col("q3") + WHISKER * iqr
    # Null-safe equality: no `isnotnull` constraint is inferred and pushed
    # through the quantile plan (that inference tripped AQE re-planning).
    q = sent_if_small(q.withColumnRenamed(group_col, "_qg"), "fences")
    joined = data.join(q, data[group_col].eqNullSafe(q["_qg"]), "inner").drop("_qg")
    out = joined.groupBy(group_col).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(v >= lo_fence, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi_fence, v)).alias("upper_whisker"),
        F.count(F.when(v < lo_fence, 1)).alias("n_outliers_low"),
        F.count(F.when(v > hi_fence, 1)).alias("n_outliers_high"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    cols = [group_col, "n"]
    for c in ("q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker"):
        cols.append(F.round(F.col(c), digits).alias(c) if digits is not None else F.col(c))
    cols += ["n_outliers_low", "n_outliers_high"]
    return out.select(*cols)


def plot_gate(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """One row -- groups, the smallest group size, and whether every
    group has more than one value (empty input -> false)."""
    sizes = (df.filter(F.col(value_col).isNotNull()).groupBy(group_col)
             .agg(F.count(F.lit(1)).alias("_n")))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("_n").alias("min_group_size"),
        F.coalesce(F.min("_n") > 1, F.lit(False)).alias("enough_data"),
    )


def outlier_rows(df: DataFrame, group_col: str, value_col: str, tiebreak: str,
                 keep: tuple[str, ...] = (), num_partitions: int | None = None) -> DataFrame:
    """A4, the points of the box plot: every row outside its group's 1.5 IQR
    fences, with `side` (low/high).  A DataFrame, not a per-group list, so a
    group with many outliers is never gathered in one place; the fence table
    (one row per group) is joined to the rows."""
    q = exact_quantiles(df, group_col, value_col, tiebreak, num_partitions=num_partitions)
    q = sent_if_small(q, "fences")
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(F.col(group_col).alias("_fg"),
                      (F.col("q1") - WHISKER * iqr).alias("_lo"),
                      (F.col("q3") + WHISKER * iqr).alias("_hi"))
    v = F.col(value_col)
    rows = df.select(group_col, value_col, tiebreak, *keep).filter(v.isNotNull())
    joined = rows.join(fences, rows[group_col].eqNullSafe(fences["_fg"]), "inner")
    side = F.when(v < F.col("_lo"), F.lit("low")).when(v > F.col("_hi"), F.lit("high"))
    return (joined.withColumn("side", side).filter(F.col("side").isNotNull())
            .select(group_col, tiebreak, *keep, value_col, "side"))
