"""Queries over prices of zero and series that do not vary, against their SQL and brute force."""

import datetime as dt
import os
import shutil

import duckdb
import numpy as np
import pytest

from chronopanel.operators import reconcile
from chronopanel.plans import registry


@pytest.fixture(scope="module")
def zeros(spark, sf, tmp_path_factory):
    """The smallest tables, with events of zero (one day, some days, always), of one value, and shared by two labels."""
    to = tmp_path_factory.mktemp("zeros")
    for f in os.listdir(sf):
        if not f.startswith("events"):
            os.symlink(f"{sf}/{f}", to / f)
    users = [str(k) for k in range(3, 9)] + ["101", "102", "103", "104", "105", "106"]
    rows = []
    for k, u in enumerate(users):
        for day in range(1, 31):
            v = 1.0 + (day * (7 + k // 2) + 3 * k // 2) % 11
            v = 0.0 if (k in (1, 6) and day == 15) or (k in (2, 3, 7, 8) and day in (12, 13, 20)) or k == 4 else 5.0 if k == 9 else v
            rows.append((1000 * k + day, dt.datetime(2024, 1, day, 12), int(u), "view", v, "{}"))
    spark.createDataFrame(rows, spark.read.parquet(f"{sf}/events.parquet").schema).coalesce(1).write.parquet(str(to / "out"))
    shutil.copy(next((to / "out").glob("part-*")), to / "events.parquet")
    return str(to)


def same(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    df = registry.queries()[name](spark, folder)
    plain = lambda rows: sorted((tuple(repr(float(f"{v:.9g}")) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    names = [c[0] for c in con.execute(registry.oracle_sql()[name]).description]
    want = con.execute(registry.oracle_sql()[name]).fetchall()
    got = df.select(*names).collect()
    assert plain(got) == plain(want)
    return [v for r in got for v in r if isinstance(v, float)]


def test_a07_of_zero(spark, zeros):
    assert any(np.isinf(v) for v in same(spark, "a07_product", zeros))


def test_j17_of_zero(spark, zeros):
    assert any(np.isnan(v) for v in same(spark, "j17_correlation_match", zeros))


def test_j18_of_zero(spark, zeros):
    same(spark, "j18_value_fingerprint", zeros)


def test_w32_of_zero(spark, zeros):
    assert any(np.isinf(v) for v in same(spark, "w32_growth", zeros))


def test_w38_of_zero(spark, zeros):
    assert any(np.isnan(v) for v in same(spark, "w38_last_window_correlation", zeros))


def test_pairs_in_blocks(spark):
    """Blocks and strips of a few labels, missing dates, very large, infinite and constant values, against a loop over all pairs."""
    rng = np.random.default_rng(3)
    rows = {}
    for k in range(41):
        x = rng.normal(1e6 * (k % 3 == 0), 1.0, 12)
        if k % 10 == 4:
            x[:] = 0.1 * k
        if k % 10 == 5:
            x[k % 12] = 1e9
        if k % 10 == 6:
            x[k % 12] = np.inf
        for d in range(12):
            if rng.random() < 0.8:
                rows[f"t{k}", dt.date(2024, 1, 1 + d)] = float(x[d])
    by = {}
    for (t, d), x in rows.items():
        by.setdefault(t, {})[d] = x
    want = {}
    for a in by:
        for b in by:
            common = sorted(by[a].keys() & by[b].keys())
            if a < b and len(common) >= 7:
                x, y = (np.array([s[d] - s[common[0]] for d in common]) for s in (by[a], by[b]))
                with np.errstate(all="ignore"):
                    x, y = x - x.mean(), y - y.mean()
                    want[a, b] = (x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum())
    df = spark.createDataFrame([(t, d, x) for (t, d), x in rows.items()], "ticker string, date date, x double")
    got = reconcile.correlated_pairs(df, "x", least=7, digits=4, labels=6, strip=3).collect()
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want.keys()
    for r in got:
        w = want[r["a"], r["b"]]
        assert np.isnan(w) == np.isnan(r["c"]) and (np.isnan(w) or abs(r["c"] - w) < 6e-5), (r, w)
    assert reconcile.correlated_pairs(df.where("false"), "x", least=7, digits=4).count() == 0
