"""Property tests (hypothesis): parsing parity and skew-safe ranking."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from offerframe.functions.numbers import strict_number
from offerframe.operators.rank import rank_within

NUMBERISH = st.text(alphabet="0123456789.+-eE _dnaifINFtyx,\t", max_size=8)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NUMBERISH, min_size=1, max_size=30))
def test_strict_number_parity_with_pandas(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(strict_number(F.col("t")).alias("v")).collect()]
    for t, g in zip(texts, got):
        w = pd.to_numeric(pd.Series([t], dtype=object), errors="coerce").astype(float).iloc[0]
        if math.isnan(w):
            assert g is None, repr(t)
        else:
            assert g == w, repr(t)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=120),
       st.integers(1, 9))
def test_rank_within_equals_row_number(spark, rows, parts):
    df = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)], "id long, g string, x int")
    w = Window.partitionBy("g").orderBy(F.col("x").asc_nulls_last(), "id")
    want = sorted(tuple(r) for r in df.withColumn("rank", F.row_number().over(w)).collect())
    got = sorted(tuple(r) for r in rank_within(
        df, ["g"], [F.col("x").asc_nulls_last(), F.col("id")], num_partitions=parts)
        .select("id", "g", "x", "rank").collect())
    assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), max_size=25, unique=True),
       st.lists(st.tuples(st.integers(0, 40), st.integers(0, 1000)), max_size=60, unique_by=lambda t: t[1]))
def test_upsert_is_last_write_per_key(spark, base_keys, updates):
    from offerframe.operators import merge as M
    url = "https://www.olx.pl/d/{}.html".format
    base = spark.createDataFrame(
        [(url(k), "-25", "olx", str(k), "base", "t", "l", "Unknown") for k in base_keys],
        "url string, category string, website string, offer_id string, price string, "
        "offer_title string, location string, active string")
    upd = spark.createDataFrame([(url(k), f"p{seq}", seq) for k, seq in updates],
                                "url string, price string, seq int")
    out = {r.url: r for r in M.upsert_overwrite(base, upd, "seq").collect()}
    want_keys = {url(k) for k in base_keys} | {url(k) for k, _ in updates}
    assert set(out) == want_keys
    last = {}
    for k, seq in updates:
        if url(k) not in last or seq > last[url(k)]:
            last[url(k)] = seq
    for u, r in out.items():
        if u in last:
            assert r.price == f"p{last[u]}" and r.offer_title == "No data"
        else:
            assert r.price == "base" and r.offer_title == "t"
