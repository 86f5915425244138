"""Every registered query of the core against DuckDB on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from chronopanel.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    r = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf, name):
    """Executed whole; what they compute is held against brute force in the other files."""
    df = registry.queries()[name](spark, sf)
    assert {len(r) for r in df.collect()} <= {len(df.columns)}
