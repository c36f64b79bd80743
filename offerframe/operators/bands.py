"""Size bands (slices): dimension, range match, last-wins, order inside a band.

The band list is a parameter of fixed, small size, so the range match is
a projection: every row carries the array of bands as a literal and keeps
the ones whose bounds contain its value.  No join, no shuffle, and the big
side is never moved.  Adjacent bands share an end point, so a boundary
value matches two bands; the overlay rule (last band wins) settles it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..profiles import REFERENCE_BANDS, Band, band_request_suffix
from .rank import rank_within

BAND_TYPE = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("lo", T.IntegerType()),
    T.StructField("hi", T.IntegerType()),
])


def bands_frame(spark: SparkSession, bands=REFERENCE_BANDS) -> DataFrame:
    """The band dimension as a DataFrame (ord, label, lo, hi)."""
    return spark.createDataFrame([(b.ord, b.label, b.lo, b.hi) for b in bands], BAND_TYPE)


def _check(bands) -> list[Band]:
    return sorted(bands, key=lambda b: b.ord)


def _sql_int(v: int | None) -> str:
    return "CAST(NULL AS INT)" if v is None else f"CAST({int(v)} AS INT)"


def _struct(b: Band) -> Column:
    """The band as a struct literal (one expression, built in one call)."""
    label = b.label.replace("'", "''")
    return F.expr(f"named_struct('ord', {_sql_int(b.ord)}, 'label', '{label}', "
                  f"'lo', {_sql_int(b.lo)}, 'hi', {_sql_int(b.hi)})")


def holds(value: Column, b: Band, inclusive: bool = True) -> Column:
    """Whether band `b` contains `value` (open ends when a bound is NULL)."""
    cond = F.lit(True)
    if b.lo is not None:
        cond = cond & (value >= F.lit(b.lo))
    if b.hi is not None:
        cond = cond & ((value <= F.lit(b.hi)) if inclusive else (value < F.lit(b.hi)))
    return value.isNotNull() & cond


def matching_bands(value: Column, bands=REFERENCE_BANDS, inclusive: bool = True) -> Column:
    """Array of the bands whose range holds `value`, in band order."""
    arms = F.array(*[F.when(holds(value, b, inclusive), _struct(b)) for b in _check(bands)])
    return F.array_compact(arms)


def assign_bands(df: DataFrame, value: Column, bands=REFERENCE_BANDS,
                 inclusive: bool = True) -> DataFrame:
    """L11 as rows: one row per (input row, matching band); adds ord/category.

    A generator over one `when` arm per band, then a null filter: plain
    expressions, so the whole step stays in whole-stage codegen.
    """
    arms = F.array(*[F.when(holds(value, b, inclusive), _struct(b)) for b in _check(bands)])
    return (df.withColumn("_band", F.explode(arms))
            .filter(F.col("_band").isNotNull())
            .withColumn("ord", F.col("_band.ord"))
            .withColumn("category", F.col("_band.label"))
            .drop("_band"))


def last_band(value: Column, bands=REFERENCE_BANDS, inclusive: bool = True) -> Column:
    """L11 + L8 for one value: label of the last band holding it (or NULL).

    The same answer as `overlay_last_wins(assign_bands(...))`, as a pure
    projection (a CASE chain, last band first) for inputs that already have
    one row per key.
    """
    return last_band_struct(value, bands, inclusive)["label"]


def last_band_struct(value: Column, bands=REFERENCE_BANDS, inclusive: bool = True) -> Column:
    """The whole last matching band (ord, label, lo, hi); NULL when none."""
    out = None
    for b in reversed(_check(bands)):
        cond = holds(value, b, inclusive)
        out = F.when(cond, _struct(b)) if out is None else out.when(cond, _struct(b))
    return out


def band_requests(bases: DataFrame, base_col: str = "base", bands=REFERENCE_BANDS) -> DataFrame:
    """One search request per (base URL, band): base + the band's query."""
    reqs = F.array(*[
        F.struct(F.lit(b.ord).cast("int").alias("ord"), F.lit(b.label).alias("label"),
                 F.lit(band_request_suffix(b)).alias("suffix"))
        for b in bands
    ])
    return (bases.select(F.col(base_col).alias("base"), F.explode(reqs).alias("_r"))
            .select("base", F.col("_r.ord").alias("ord"), F.col("_r.label").alias("category"),
                    F.concat(F.col("base"), F.col("_r.suffix")).alias("request_url")))


def band_of_request(url: Column, bands=REFERENCE_BANDS) -> Column:
    """Inverse of L10: the band (struct) whose area bounds a search request
    URL carries (`...from%5D=<lo>` / `...to%5D=<hi>`); NULL when none fits.
    Lets stored result pages carry their slice in their own URL."""
    lo = F.regexp_extract(url, r"filter_float_m:from%5D=([0-9]+)", 1)
    hi = F.regexp_extract(url, r"filter_float_m:to%5D=([0-9]+)", 1)
    out = None
    for b in _check(bands):
        cond = (lo == F.lit("" if b.lo is None else str(b.lo))) & \
               (hi == F.lit("" if b.hi is None else str(b.hi)))
        out = F.when(cond, _struct(b)) if out is None else out.when(cond, _struct(b))
    return out


def order_in_band(df: DataFrame, category_col: str, price: Column, key_col: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Position of each row inside its band, price ascending (NULL
    prices last), the key breaking ties.  Skew-safe (see `rank_within`)."""
    ranked = df.withColumn("_price", price)
    return rank_within(ranked, [category_col],
                       [F.col("_price").asc_nulls_last(), F.col(key_col).asc()],
                       num_partitions=num_partitions, rank_col="rank_in_band").drop("_price")


def band_for(bands, label: str) -> Band:
    for b in bands:
        if b.label == label:
            return b
    raise KeyError(label)
