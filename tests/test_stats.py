"""Analysis A1-A7: number parsing parity with pandas, exact quartiles."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from offerframe.functions.numbers import lenient_number, strict_number
from offerframe.operators import quality as Q
from offerframe.operators import stats as A

TEXTS = ["1", "1.5", "-2", "+3", ".5", "5.", " 7 ", "1e3", "1E-2", "1d", "1_000", "nan", "NaN", "",
         " ", "inf", "-inf", "Infinity", " inf ", "1e400", "-1e400", "Unknown", "Not found", "abc",
         "1,5", "1 000", "450 000 zł", "0x10", "--1", "1e", "e3", "+.5e1", "\t8\n", "١٢", "1.2.3",
         "No data", "00012", "-0", "+inf", "INF", "1f", "2L", "3.0e+2"]


def test_strict_number_matches_pandas(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r.v for r in df.select(strict_number(F.col("t")).alias("v")).collect()]
    want = pd.to_numeric(pd.Series(TEXTS, dtype=object), errors="coerce").astype(float).tolist()
    for t, g, w in zip(TEXTS, got, want):
        if w is None or (isinstance(w, float) and np.isnan(w)):
            assert g is None, t
        else:
            assert g == w, t


def test_lenient_number(spark):
    df = spark.createDataFrame([("450 000 zł",), ("1.250.000,50 PLN",), ("€ 1.5",), ("abc",)], "t string")
    got = [r.v for r in df.select(lenient_number(F.col("t")).alias("v")).collect()]
    assert got == [450000.0, 1250000.5, 1.5, None]


def test_value_counts_skip_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    assert [(r.c, r.n_offers) for r in A.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 else rnd.choice("abc"), round(rnd.gauss(100, 30), 2)) for i in range(5000)]
    rows += [(5000, "single", 4.0)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    got = {r.g: r for r in A.exact_quantiles(df, "g", "x", "id", num_partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "x"])
    for g, s in pdf.groupby("g")["x"]:
        for name, p in A.QUARTILES:
            assert abs(getattr(got[g], name) - np.percentile(s, p * 100)) < 1e-9, (g, name)
        assert got[g].n == len(s)


def test_boxplot_whiskers_and_outliers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100, -50]
    df = spark.createDataFrame([(i, "g", float(v)) for i, v in enumerate(vals)], "id long, g string, x double")
    r = A.boxplot(df, "g", "x", "id").first()
    s = pd.Series(vals, dtype=float)
    q1, q3 = s.quantile(.25), s.quantile(.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r.lower_whisker == s[s >= lo].min() and r.upper_whisker == s[s <= hi].max()
    assert (r.n_outliers_low, r.n_outliers_high) == (1, 1)


def test_gate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", None)], "g string, x double")
    r = A.plot_gate(df, "g", "x").first()
    assert (r.n_groups, r.min_group_size, r.enough_data) == (2, 1, False)
    empty = df.filter("false")
    assert A.plot_gate(empty, "g", "x").first().enough_data is False


def test_completeness(spark):
    df = spark.createDataFrame([("s", "a", "1", "10", "t", "l", "Yes"),
                                ("s", "Unknown", "Not found", " ", "t", "Unknown exception at //x", "No data")],
                               "website string, category string, offer_id string, price string, "
                               "offer_title string, location string, active string")
    rows = {r.website: r for r in Q.completeness(df).collect()}
    assert rows["s"].category_complete == 0.5 and rows["s"].offer_title_complete == 1.0
    assert rows[None].n_offers == 2 and rows[None].location_complete == 0.5


def test_sketches_of_untouched_buckets_are_kept_and_merged(spark):
    from offerframe.operators import sketches as SK

    rows = [(f"u{i}", "g" if i % 3 else "h", str(float(i % 997))) for i in range(6000)]
    df = spark.createDataFrame(rows, "url string, category string, price string")
    kept = SK.sketch_prices(df, 8).cache()
    errors = {r.category: (r.n, r.q1, r.median, r.q3) for r in SK.rank_errors(SK.quartiles(kept), df).collect()}
    assert errors["g"][0] == 4000 and errors["h"][0] == 2000
    assert all(e <= 0.01 for c in errors for e in errors[c][1:])
    # Prices of two buckets change: only these are sketched again.
    old = {(r.bucket, r.category): bytes(r.sketch) for r in kept.collect()}
    moved = df.where(SK.bucket_of(F.col("url"), 8).isin(1, 5)).withColumn("price", F.lit("5000"))
    new = SK.replace_touched(kept, (1, 5), moved, 8)
    got = {(r.bucket, r.category): bytes(r.sketch) for r in new.collect()}
    assert all(got[k] == old[k] for k in old if k[0] not in (1, 5)) and set(got) == set(old)
    assert SK.quartiles(new).where("q3 > 700").count() == 2


def test_outlier_rows_match_fences(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100, -50]
    df = spark.createDataFrame([(i, "g", float(v)) for i, v in enumerate(vals)], "id long, g string, x double")
    got = sorted((r.x, r.side) for r in A.outlier_rows(df, "g", "x", "id").collect())
    assert got == [(-50.0, "low"), (100.0, "high")]
