"""Queries over whole tables, without SQL, against brute force."""

import math
from itertools import combinations

import numpy as np
import pytest

from chronopanel.plans import registry, shared


@pytest.fixture(scope="module")
def rows(spark, sf):
    return lambda table, *exprs: [tuple(r) for r in spark.read.parquet(f"{sf}/{table}.parquet").selectExpr(*exprs).collect()]


def test_j14_every_order(spark, sf, rows):
    nation, at = dict(rows("customer", "c_custkey", "c_nationkey")), dict(rows("supplier", "s_suppkey", "s_nationkey"))
    events = {}
    for supp, d, i in rows("lineitem", "l_suppkey", "CAST(l_shipdate AS DATE)", "l_orderkey * 10 + l_linenumber"):
        events.setdefault(at[supp], []).append((d, i))
    want = []
    for i, cust, d in rows("orders", "o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE)"):
        near = min(((abs((e - d).days), e, k) for e, k in events.get(nation[cust], []) if abs((e - d).days) <= 5), default=None)
        want.append((i, near and near[2], near and (near[1] - d).days))
    got = registry.queries()["j14_nearest_event_all"](spark, sf).select("id", "other", "gap").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_u06_every_change(spark, sf, rows):
    held, after = set(), {}
    for d, _, cust in sorted(rows("orders", "CAST(o_orderdate AS DATE)", "o_orderkey", "o_custkey")):
        held.discard(f"c{(cust * 7 + 3) % 40}")
        held.add(f"c{cust % 40}")
        after[d] = sorted(held)
    got = registry.queries()["u06_replay_all"](spark, sf).select("date", "ticker").collect()
    assert sorted(map(tuple, got)) == sorted((d, x) for d, members in after.items() for x in members)


def test_w38_every_pair(spark, sf):
    closes = {}
    for r in shared.upanel(spark, sf).select("ticker", "date", "day", "close").collect():
        closes.setdefault(r["ticker"], []).append((r["day"], r["date"], r["close"]))
    rets = {}
    for k, days in closes.items():
        days.sort()
        rets[k] = {d: c / p - 1 for (_, _, p), (n, d, c) in zip(days, days[1:], strict=False) if n >= 10 and p is not None and c is not None}
    want = {}
    for a, b in combinations(sorted(rets), 2):
        common = sorted(rets[a].keys() & rets[b].keys())
        if len(common) >= 8:
            want[a, b] = np.corrcoef([rets[a][d] for d in common], [rets[b][d] for d in common])[0, 1]
    got = {(r["a"], r["b"]): r["c"] for r in registry.queries()["w38_last_window_correlation_all"](spark, sf).collect()}
    assert got.keys() == want.keys() and any(b >= "11" for _, b in got)
    assert all(math.isclose(got[k], want[k], abs_tol=1e-4) for k in want)
