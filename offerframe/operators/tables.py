"""Bands (L9, L11, L8) and the site router (P5) with the rules as tables.

`operators.bands` and `extract.route` compile a short list into expressions; here
the list is a DataFrame of any length, the plan does not grow with it, and every
step is an equi-join: no cross join, no nested loop.

Bands: a range of integers is the union of few aligned cells (level k: 2^k numbers,
at most two cells a level), so a band becomes about 2 log2(width) rows and a value
lies in one cell of each level.  Both sides join on (level, cell).  Levels no band
has are left out (there are 63 at most).  Where only the number of bands and the last
one are asked for, each cell is reduced to these first: a value then meets one row
a level, however many bands hold it.

Router: tokens are looked up whole.  The first letters of each, as many as the
shortest token has, say how long the tokens are that begin so; wherever they stand in a
URL, the substrings of these lengths are joined to the tokens, one row each.  So a URL
meets the tokens it holds and no others.

A table up to `rank.SMALL_ROWS` rows, counted, is sent to the tasks; a larger one is
joined by shuffle, where AQE splits a hot key.  Values and URLs are reduced to
distinct ones before they are multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import sent_if_small, spread

EDGE = 1 << 61  # open ends reach this far on either side; values beyond it match nothing

_CELLS = "array<struct<level:int,cell:bigint>>"


def _cells(first: Column, after: Column) -> Column:
    """The aligned cells whose union is [first, after): from fine to coarse, what sticks out on either side."""
    width = after - first  # halved from level to level: what is left is empty after log2(width) of them
    top = F.when(width > 0, F.least(F.floor(F.log2(width)).cast("int") + 1, F.lit(62))).otherwise(0)
    start = F.struct(first.alias("l"), after.alias("r"), F.array().cast(_CELLS).alias("out"))

    def step(s, level):
        left = (s["l"] < s["r"]) & (s["l"].bitwiseAND(F.lit(1)) == 1)
        right = (s["l"] < s["r"]) & (s["r"].bitwiseAND(F.lit(1)) == 1)
        more = F.array_compact(F.array(
            F.when(left, F.struct(level.alias("level"), s["l"].alias("cell"))),
            F.when(right, F.struct(level.alias("level"), (s["r"] - 1).alias("cell")))))
        return F.struct(F.shiftright(s["l"] + left.cast("long"), 1).alias("l"),
                        F.shiftright(s["r"] - right.cast("long"), 1).alias("r"),
                        F.concat(s["out"], more).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), top), start, step, lambda s: s["out"])


def _band_cells(bands: DataFrame, inclusive: bool) -> DataFrame:
    """(ord, label, level, cell): the cells of every band."""
    first = F.greatest(F.coalesce(F.col("lo").cast("long"), F.lit(-EDGE)), F.lit(-EDGE))
    after = F.least(F.coalesce(F.col("hi").cast("long") + int(inclusive), F.lit(EDGE)), F.lit(EDGE))
    return (bands.select("ord", "label", F.explode(_cells(first, after)).alias("_at"))
            .select("ord", "label", "_at.level", "_at.cell"))


def _in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Every distinct `_value` of `rows` joined to the rows of `cells` for a cell that it lies in."""
    cells = sent_if_small(cells, "band-cells")
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # 63 at most
    v = F.col("_value")
    at = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(v, k).alias("cell")) for k in levels]).cast(_CELLS)
    values = rows.select("_value").where(v.between(-EDGE, EDGE - 1)).distinct()
    return (values.select("_value", F.explode(at).alias("_at")).select("_value", "_at.level", "_at.cell")
            .join(cells, ["level", "cell"]).drop("level", "cell"))


def assign_from_table(df: DataFrame, value: Column, bands: DataFrame, inclusive: bool = True) -> DataFrame:
    """A row per (row of `df`, band of `bands` that holds its value), with `ord` and `category`.

    `bands` is (ord, label, lo, hi) of integers, NULL an open end, any number of rows, overlapping or not; both ends
    belong to a band unless not `inclusive` (then `hi` does not).  A NULL value matches nothing, as does a band with
    lo > hi; a value that is no integer loses its fraction.  Repeated rows and repeated bands each give rows of their
    own."""
    rows = df.withColumn("_value", value.cast("long"))
    found = _in_cells(rows, _band_cells(bands, inclusive))
    return rows.join(found.select("_value", "ord", F.col("label").alias("category")), "_value").drop("_value")


def last_from_table(df: DataFrame, value: Column, bands: DataFrame, inclusive: bool = True) -> DataFrame:
    """L11 + L8: every row of `df` with `n_bands` that hold its value and `category`, the last of them (NULL: none).

    The last is the one of greatest `ord`, of equal ones of greatest label."""
    rows = df.withColumn("_value", value.cast("long"))
    cells = (_band_cells(spread(bands), inclusive).groupBy("level", "cell")
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("ord", "label")).alias("top")))
    last = sent_if_small(_in_cells(rows, cells).groupBy("_value").agg(
        F.sum("n").alias("n_bands"), F.max("top")["label"].alias("category")), "last-bands")
    return (rows.join(last, "_value", "left").drop("_value")
            .withColumn("n_bands", F.coalesce("n_bands", F.lit(0).cast("long"))))


def route_from_table(df: DataFrame, url_col: str, rules: DataFrame) -> DataFrame:
    """P5: every row of `df` with `site`, that of the first rule (least `ord`) whose `token` is in its URL.

    `rules` is (ord, token, site), any number of rows; no rule, or a NULL URL: NULL.  Rules with a NULL or empty token
    are left out.  Of equal `ord` the least site counts."""
    rules = (rules.select("ord", "token", "site").where(F.length("token") > 0)
             .groupBy("token").agg(F.min(F.struct("ord", "site")).alias("rule")))
    rules = sent_if_small(rules, "route-rules")
    width = rules.agg(F.min(F.length("token"))).first()[0] or 1
    heads = rules.groupBy(F.substring("token", 1, width).alias("_head")).agg(F.collect_set(F.length("token")).alias("_lengths"))
    heads = sent_if_small(heads, "route-heads")
    url = F.col("_url")
    at = F.transform(F.sequence(F.lit(1), F.length(url) - width + 1),
                     lambda i: F.struct(i.alias("at"), F.substr(url, i, F.lit(width)).alias("head")))
    known = (df.select(F.col(url_col).alias("_url")).distinct().where(F.length(url) >= width)
             .select("_url", F.explode(at).alias("_p")).select("_url", F.col("_p.at").alias("_at"), F.col("_p.head").alias("_head"))
             .join(heads, "_head").select("_url", "_at", F.explode("_lengths").alias("_n"))
             .where(F.col("_at") + F.col("_n") - 1 <= F.length(url)))
    found = (known.select("_url", F.substr(url, F.col("_at"), F.col("_n")).alias("token")).join(rules, "token")
             .groupBy("_url").agg(F.min("rule")["site"].alias("site")))
    return df.withColumn("_url", F.col(url_col)).join(found, "_url", "left").drop("_url")
