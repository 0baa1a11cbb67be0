"""Every registered query against its SQL, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(x is not None, x or "") for x in r])


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    got = table(df.columns, df.collect())
    if name not in SQL:
        assert got[1]
        return
    cursor = duck.execute(SQL[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    cards = entry.entry(spark)
    assert cards.columns[:2] == ["seq", "price_label"] and cards.count() > 0
