"""Mixing: budgets by hand, epochs and prefixes, awkward rows, agreement with SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from offerframe.llm import mixing

from . import data


def _quotas(spark, leaves, **kw):
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    out = mixing.budgets(df, mixing.Params(**kw)).collect()
    return {(r["domain"], r["lang"], r["source"]): r["quota"] for r in out}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    weights = {"domain": {"a": 1, "b": 1}, "lang": {}, "source": {"s2": 3}}
    leaves = [("a", "en", "s1", 1000), ("a", "en", "s2", 100), ("b", "en", "s3", 1000)]
    # 600 tokens: 300 for a, of which s2 should take 225 but has 100; its sibling s1 takes the rest.
    got = _quotas(spark, leaves, weights=weights, budget=600 / 2100, max_epochs=1)
    assert got == {("a", "en", "s1"): 200, ("a", "en", "s2"): 100, ("b", "en", "s3"): 300}


def test_shortage_of_a_domain_goes_to_the_other(spark):
    leaves = [("a", "en", "s1", 50), ("a", "de", "s1", 50), ("b", "en", "s3", 1000)]
    got = _quotas(spark, leaves, weights={"domain": {}, "lang": {}, "source": {}}, budget=600 / 1100, max_epochs=1)
    assert got == {("a", "en", "s1"): 50, ("a", "de", "s1"): 50, ("b", "en", "s3"): 500}


def test_epochs_and_zero_weight(spark):
    leaves = [("a", "en", "s1", 100), ("a", "en", "s2", 1000)]
    got = _quotas(spark, leaves, weights={"domain": {}, "lang": {}, "source": {"s2": 0}}, budget=1.0, max_epochs=2)
    assert got == {("a", "en", "s1"): 200, ("a", "en", "s2"): 0}


def _sql(rows, p):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(mixing.oracle_sql(p)).fetchall(), key=str)


@pytest.mark.parametrize("budget, epochs, digits", [(0.9, 2, 4), (0.37, 1, 1), (1.7, 3, 2)])
def test_selection_equals_sql(spark, budget, epochs, digits):
    p = mixing.Params(budget=budget, max_epochs=epochs, bucket_digits=digits)
    rows = data.AWKWARD + [(1000 + i, "word " * (i % 17 + 1), ["en", "de", "fr"][i % 3], f"src{0 if i % 3 else i % 20}")
                           for i in range(400)]
    got = mixing.mix(data.documents(spark, rows), p)
    names = ["doc_id", "domain", "lang", "source", "n_tokens", "epoch"]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == _sql(rows, p)


def test_native_plan_and_filter(spark):
    docs = data.documents(spark)
    p = mixing.Params(max_epochs=1)
    plan = mixing.mix(docs, p)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    out = mixing.mixed(docs, p)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in mixing.mix(docs, p).collect()}
    assert mixing.mix(data.empty(spark), p).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs, mixing.Params(max_epochs=2))


def test_tokens_meet_the_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h").alias("text"),
                                    F.lit("en").alias("lang"), F.concat(F.lit("src"), F.col("id") % 2).alias("source"))
    p = mixing.Params(weights={"domain": {"web": 3, "books": 1}, "lang": {}, "source": {}}, budget=0.4, max_epochs=1)
    got = {r["domain"]: r["t"] for r in mixing.mix(docs, p).groupBy("domain").agg(F.sum("n_tokens").alias("t")).collect()}
    assert abs(got["web"] - 9600) <= 8 and abs(got["books"] - 3200) <= 8


def test_filter_shuffles_only_texts_that_may_go(spark, monkeypatch):
    seen, split = [], mixing.bloom.split

    def counted(*args):
        asked, rest = split(*args)
        seen.append((asked.count(), rest.count()))
        return asked, rest

    monkeypatch.setattr(mixing.bloom, "split", counted)
    p = mixing.Params(max_epochs=1)
    rows = [(k if k % 10 else None, f"word {k} " * (1 + k % 4), [None, "en", "de"][k % 3], f"src{k % 4}", k) for k in range(400)]
    rows += [(k, rows[k][1], "de", rows[k][3], -k) for k in range(1, 30)] + [(900, " ", "en", "src1", 0), (901, None, "en", "src1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _other int")
    key = lambda r: (r["doc_id"], r["lang"] or "", r["source"])
    want = {key(r) for r in mixing.mix(docs, p).collect()}
    out = mixing.mixed(docs, p)
    assert out.schema == docs.schema
    stay = [r for r in docs.collect() if (r["text"] or "").strip() and key(r) in want]
    assert sorted(map(str, out.collect())) == sorted(map(str, stay)) and 0 < len(stay) < len(rows) - 2
    asked, rest = seen.pop()
    assert asked + rest == len(rows) - 2 and len(rows) - 2 - len(stay) <= asked <= len(rows) // 2
