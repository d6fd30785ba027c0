"""Every query with a SQL twin, against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import playlog.catalog as catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    ours = sorted(repr([_plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    rel = duck.sql(catalog.ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in sorted(rel.columns)]
    theirs = sorted(repr([_plain(r[i]) for i in at]) for r in rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert ours == theirs


def test_every_query_has_a_twin():
    assert catalog.QUERIES.keys() == catalog.ORACLE_SQL.keys()
