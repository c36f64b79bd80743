"""Driver contract: entry() runs; every query has a name-matched oracle."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from offerframe.plans import catalog
from tools import check_oracle


def test_entry_has_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["page_id", "url", "category", "website", "offer_id", "price",
                          "offer_title", "location", "active", "status", "reason"]


def test_every_query_has_oracle():
    learned = re.compile(r"op[0-9]+_|pipeline$")  # the training-data queries are tested on their own
    assert {q for q in E.queries() if not learned.match(q)} == {q for q in E.oracle_sql() if not learned.match(q)}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_runs_and_matches_its_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = E.queries()[name](spark, sf)
    want = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert check_oracle.digest(df.columns, [tuple(r) for r in df.collect()])[1] == \
        check_oracle.digest(columns, want.fetchall())[1]
