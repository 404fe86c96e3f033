"""Every registered query against its SQL on the smallest tables, as the driver compares them."""

import math
from decimal import Decimal

import duckdb
import pytest
from conftest import SF

from larkspur.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return f"D{v}"
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    cols = sorted(df.columns)
    assert len(set(cols)) == len(cols)
    if name not in ORACLES:
        return
    sql = db.sql(ORACLES[name])
    assert sorted(sql.columns) == cols
    want = [[norm(r[sql.columns.index(c)]) for c in cols] for r in sql.fetchall()]
    got = [[norm(r[c]) for c in cols] for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
