"""One-to-one matches against the greedy matching over all pairs."""

import datetime as dt

from chronopanel.operators import pit, reconcile
from chronopanel.plans import q_more, shared


def greedy(pairs):
    """pairs: (cost, left, right)."""
    lefts, rights, out = set(), set(), set()
    for c, a, b in sorted(pairs):
        if a not in lefts and b not in rights:
            lefts.add(a), rights.add(b), out.add((c, a, b))
    return out


def test_long_chains_and_ties(spark):
    chain = [(k, k // 2, (k + 1) // 2) for k in range(17)]  # each better than the next: one pair a round
    ties = [(0, 100 + a, 100 + b) for a in range(6) for b in range(6)]
    rows = chain + ties + ties[:3]
    got = reconcile.mutual_best(spark.createDataFrame(rows, "c int, l int, r int"), "l", "r", ["c"])
    assert {tuple(x) for x in got.select("c", "l", "r").collect()} == greedy(rows)
    assert reconcile.mutual_best(spark.createDataFrame(rows, "c int, l int, r int").limit(0), "l", "r", ["c"]).count() == 0


def test_audit_of_a_long_chain(spark):
    """Amounts on neighbouring days: no true match becomes missing or extra."""
    day = lambda k: dt.date(2001, 1, 1) + dt.timedelta(days=k)
    mine = [("t", day(4 * k), 1.0) for k in range(12)]
    theirs = [("t", day(4 * k + 1 + k % 2), 1.0) for k in range(12)]
    s = "ticker string, date date, amount double"
    got = reconcile.audit(spark.createDataFrame(mine, s), spark.createDataFrame(theirs, s), 3, 0.01).collect()
    want = greedy([(abs((b[1] - a[1]).days), a[1], b[1]) for a in mine for b in theirs if abs((b[1] - a[1]).days) <= 3])
    assert {(r["date"], r["other"]) for r in got if r["status"] in ("match", "date", "amount")} == {(a, b) for _, a, b in want}


def test_j15_against_all_pairs(spark, sf):
    ch = [tuple(r) for r in pit.member_changes(shared.snapshots(spark, sf)).select("change", "ticker", "date").collect()]
    joins, leaves = [(t, d) for c, t, d in ch if c == 1], [(t, d) for c, t, d in ch if c == -1]
    pairs = [(abs((y[1] - x[1]).days), x, y) for x in joins for y in leaves if abs((y[1] - x[1]).days) <= 40]
    got = q_more.QUERIES["j15_one_to_one"](spark, sf)
    want = sorted((x[0], x[1], y[0], g) for g, x, y in greedy(pairs))
    assert sorted(map(tuple, got.select("ticker", "date", "other", "gap").collect())) == want
