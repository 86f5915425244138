"""Round trips and what keeps membership, against plain loops."""

import datetime as dt
import random

import pytest

from chronopanel.operators import stats

KIND = "run string, ticker string, date date, side string, shares double, price double, cost double, seq long"


def trades(seed):
    rng = random.Random(seed)
    return [
        (rng.choice("xy"), rng.choice("ABC"), dt.date(2020, 1, 1) + dt.timedelta(days=k // 3), rng.choice(["BUY", "SELL", "SELL", "DELIST"]), float(rng.randint(1, 5)), rng.uniform(5, 20), rng.uniform(0, 1), k)
        for k in range(400)
    ]


def slow(rows):
    """A pool of shares and cost for each run and label, trade after trade."""
    pool, out = {}, []
    for run, t, day, side, n, price, fee, _ in rows:
        held, paid, since = pool.get((run, t), (0.0, 0.0, None))
        if side == "BUY":
            pool[run, t] = held + n, paid + n * price + fee, since if held else day
        elif held:
            sold = min(n, held)
            part = paid * sold / held
            got = sold * price - fee * sold / n
            out.append((run, t, since, day, sold, part, got, got - part, got / part - 1, (day - since).days))
            pool[run, t] = held - sold, paid - part if sold < held else 0.0, since
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_round_trips(spark, seed):
    rows = trades(seed)
    got = stats.round_trips(spark.createDataFrame(rows, KIND)).drop("trip").collect()
    want = slow(rows)
    assert len(got) == len(want) > 100
    order = lambda x: (*x[:4], round(x[4], 6), round(x[6], 6))
    for g, x in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:4] == x[:4] and g[9] == x[9] and g[4:9] == pytest.approx(x[4:9], rel=1e-9, abs=1e-9)


def test_trip_stats(spark):
    rows = trades(5)
    got = {r["run"]: r for r in stats.trip_stats(stats.round_trips(spark.createDataFrame(rows, KIND))).collect()}
    for run in "xy":
        mine = [x for x in slow(rows) if x[0] == run]
        wins = [x[8] for x in mine if x[7] > 0]
        assert got[run]["trips"] == len(mine) and got[run]["win_rate"] == pytest.approx(len(wins) / len(mine)) and got[run]["avg_win"] == pytest.approx(sum(wins) / len(wins))
        assert got[run]["best"] == pytest.approx(max(x[8] for x in mine)) and got[run]["avg_days"] == pytest.approx(sum(x[9] for x in mine) / len(mine))
