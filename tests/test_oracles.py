"""Every query with SQL gives the rows that DuckDB gives for it."""

import math
import os

import duckdb
import pytest

import tideline.oracles as oracles
import tideline.queries as own

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def same(rows):
    norm = lambda x: None if x is None else round(float(x), 6) if isinstance(x, float) and math.isfinite(x) else x
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, db, name):
    df = own.QUERIES[name](spark, SF)
    cursor = db.execute(oracles.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(x[0] for x in cursor.description)
    order = [[x[0] for x in cursor.description].index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert same(got) == same(expected)
    assert got
