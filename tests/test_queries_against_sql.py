"""Every registered query against its SQL in DuckDB."""

import datetime
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return str(value)
    return value


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, data, name):
    df = queries()[name](spark, data)
    names = sorted(df.columns)
    answer = duck.execute(oracle_sql()[name])
    found = [d[0] for d in answer.description]
    assert sorted(found) == names
    places = [found.index(n) for n in names]
    expected = sorted((tuple(plain(r[i]) for i in places) for r in answer.fetchall()), key=repr)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, data, name):
    assert queries()[name](spark, data).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["col_name", "diff_count"]
