"""Pairs of labels that share values, block by block: against brute force, and without a shuffle of pairs."""

import datetime as dt
import re
from itertools import combinations

import duckdb
import numpy as np

from chronopanel.operators import reconcile
from chronopanel.plans import registry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_j18_moves_no_pairs(spark, sf):
    plan = plan_of(registry.queries()["j18_value_fingerprint"](spark, sf))
    assert "keys=[a#" not in plan and "hashpartitioning(a#" not in plan


def test_shared_values_in_blocks(spark):
    """Blocks, strips and meetings of a few rows; zeros of both signs, NaN, infinities, missing dates, a label without a date and one without a value."""
    rng = np.random.default_rng(8)
    some = [0.0, -0.0, 1.0, 1.1, float("nan"), float("inf")]
    rows = [(f"t{k}", dt.date(2024, 1, 1 + d), float(some[rng.integers(6)]) if rng.random() < 0.8 else None) for k in range(37) for d in range(8) if rng.random() < 0.9]
    rows += [("none", dt.date(2024, 1, d), None) for d in (1, 2, 3)] + [("t1", None, 1.0), ("t2", None, 1.0), (None, dt.date(2024, 1, 1), 1.0)]
    by = {}
    for t, d, x in rows:
        if t and d and x is not None:
            by.setdefault(t, set()).add((d, "nan" if np.isnan(x) else x + 0.0))
    want = {(a, b): len(by[a] & by[b]) for a, b in combinations(sorted(by), 2) if len(by[a] & by[b]) >= 2}
    df = spark.createDataFrame(rows, "ticker string, date date, x double")
    got = reconcile.shared_values(df, "x", least=2, labels=6, strip=3, meetings=5)
    assert got.columns == ["a", "b", "n"] and dict(got.dtypes)["n"] == "bigint"
    rows = got.collect()
    assert len(rows) == len(want) and {(r["a"], r["b"]): r["n"] for r in rows} == want
    assert reconcile.shared_values(df.where("false"), "x", least=2).count() == 0


def test_j17_moves_no_pairs(spark, sf):
    plan = plan_of(registry.queries()["j17_correlation_match"](spark, sf))
    assert re.search(r"keys?=\[a#\d+\]", plan) and not re.search(r"keys?=\[a#\d+L?, b#|hashpartitioning\(a#\d+, b#", plan)


def test_best_correlated_in_blocks(spark):
    """Blocks of a few labels, ties, missing dates and values, constants and infinities, against a loop over all pairs."""
    rng = np.random.default_rng(4)
    rows = {}
    for k in range(40):
        x = rng.normal(0.0, 1.0, 12) if k % 4 else np.arange(12.0) * (k + 1)
        if k % 13 == 5:
            x[:] = 0.1 * k
        if k % 13 == 6:
            x[k % 12] = np.inf
        for d in range(12):
            if rng.random() < 0.9:
                rows[f"t{k}", dt.date(2024, 1, 1 + d)] = float(x[d]) if rng.random() < 0.9 else None
    by = {}
    for (t, d), x in rows.items():
        by.setdefault(t, {})[d] = x

    def want(mine, theirs, but_itself, nan):
        best = {}
        for a in mine:
            for b in theirs:
                common = sorted(by[a].keys() & by[b].keys())
                pair = [(by[a][d], by[b][d]) for d in common if by[a][d] is not None and by[b][d] is not None]
                if len(common) < 9 or not pair or (but_itself and a == b):
                    continue
                with np.errstate(all="ignore"):
                    x, y = (np.array(s) - s[0] for s in zip(*pair, strict=True))
                    x, y = x - x.mean(), y - y.mean()
                    c = float(np.floor((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()) * 1e4 + 0.5001) / 1e4)
                if np.isnan(c) and not nan:
                    continue
                best[a] = min(best.get(a, (9, 9, 9)), (not np.isnan(c), 0.0 if np.isnan(c) else -c, b))
        return {(a, b, "nan" if not real else -c) for a, (real, c, b) in best.items()}

    df = spark.createDataFrame([(t, d, x) for (t, d), x in rows.items()], "ticker string, date date, x double")
    some = sorted(by)[:15]
    for mine, theirs, itself, nan in ((some, sorted(by)[15:], False, True), (sorted(by), sorted(by), True, False)):
        a, b = (df.where(df.ticker.isin(x)) for x in (mine, theirs))
        got = reconcile.best_correlated(a, b, "x", 9, digits=4, but_itself=itself, nan=nan, labels=6, strip=3)
        assert got.columns == ["a", "b", "c"]
        got = [(r["a"], r["b"], "nan" if np.isnan(r["c"]) else r["c"]) for r in got.collect()]
        assert len(got) == len(set(got)) and set(got) == want(mine, theirs, itself, nan)
    assert reconcile.best_correlated(df.where("false"), df, "x", 9).count() == 0


def test_w38_reads_every_label(spark, sf):
    """No label is left out, in the code or in its SQL."""
    name = "w38_last_window_correlation"
    got = {(r["a"], r["b"]) for r in registry.queries()[name](spark, sf).collect()}
    assert any(b >= "11" for _, b in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    want = {(a, b) for a, b, _ in con.execute(f"SELECT a, b, c FROM ({registry.oracle_sql()[name]})").fetchall()}
    assert got == want
