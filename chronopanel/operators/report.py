"""A simulation's result as figures and as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ledger, stats


def figures(events: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """One row a run: statistics of the equity, of turnover and of round trips, and against a benchmark (date, bench) where one is given."""
    e = ledger.equity(events)
    years, months = stats.period_returns(e, "year"), stats.period_returns(e, "month")
    out = stats.series_stats(e)
    out = out.join(years.groupBy("run").agg(F.max("ret").alias("best_year"), F.min("ret").alias("worst_year")), "run", "left")
    out = out.join(months.groupBy("run").agg(F.avg((F.col("ret") > 0).cast("double")).alias("positive_months")), "run", "left")
    out = out.join(ledger.turnover(events), "run", "left")
    out = out.join(stats.trip_stats(stats.round_trips(ledger.trades(events))), "run", "left")
    if benchmark is not None:
        out = out.join(stats.relative_stats(e.select("run", "date", "value"), benchmark), "run", "left")
    return out


def percent(x: float | None, digits: int = 2) -> str:
    return "n/a" if x is None or x != x else f"{100 * x:.{digits}f}%"


def number(x: float | None, digits: int = 2) -> str:
    return "n/a" if x is None or x != x else f"{x:.{digits}f}"


#: What a summary shows: column, heading, how it is written.
LINES: list[tuple[str, str, Callable[[float | None], str]]] = [
    ("cagr", "CAGR", percent), ("total", "total return", percent), ("vol", "volatility", percent), ("sharpe", "Sharpe", number), ("sortino", "Sortino", number),
    ("max_dd", "largest fall", percent), ("calmar", "Calmar", number), ("best_year", "best year", percent), ("worst_year", "worst year", percent),
    ("positive_months", "months with a gain", percent), ("turnover", "turnover a year", percent), ("cost_share", "costs of the mean value", percent), ("positions", "mean positions", number),
    ("invested", "mean share invested", percent), ("beta", "beta", number), ("alpha", "alpha", percent), ("corr", "correlation", number), ("tracking_error", "tracking error", percent),
]


def summary(table: DataFrame) -> str:
    """`figures` as text, a column for each run: as many rows come to the driver as there are runs."""
    rows = [r.asDict() for r in table.orderBy("run").collect()]
    wide = max([12, *(len(r["run"]) for r in rows)]) + 2
    head = " " * 24 + "".join(f"{r['run']:>{wide}}" for r in rows)
    body = [f"{title:<24}" + "".join(f"{write(r[name]):>{wide}}" for r in rows) for name, title, write in LINES if rows and name in rows[0]]
    falls = [f"{r['run']}: {r['start']} to {r['end']}; largest fall from {r['peak']} to {r['trough']}, regained {r['recovered'] or 'not yet'}" for r in rows]
    return "\n".join([head, *body, "", *falls])


def html(table: DataFrame, equity: DataFrame, width: int = 900, height: int = 260, points: int = 400) -> str:
    """A page with the summary and each run's equity as a line; at most so many points a line, always with its lowest and highest."""
    import html as escape

    n = equity.groupBy("run").agg(F.count("*").alias("n"))
    place = F.floor((F.row_number().over(_by_run()) - 1) * points / 2 / F.col("n"))
    cell = equity.join(F.broadcast(n), "run").withColumn("cell", place).groupBy("run", "cell")  # one row a run
    few = cell.agg(F.min(F.struct("value", "date")).alias("low"), F.max(F.struct("value", "date")).alias("high"))
    few = few.select("run", F.explode(F.array_distinct(F.array("low", "high"))).alias("p")).select("run", "p.date", "p.value").orderBy("run", "date").collect()
    lines: dict[str, list] = {}
    for r in few:
        lines.setdefault(r["run"], []).append((r["date"].toordinal(), r["value"]))
    every = [p for ps in lines.values() for p in ps] or [(0, 0.0)]
    (x0, x1), (y0, y1) = ((min(v), max(v)) for v in zip(*every, strict=True))
    at = lambda x, y: f"{(x - x0) / max(1, x1 - x0) * width:.1f},{height - (y - y0) / max(1e-9, y1 - y0) * height:.1f}"
    drawn = [f'<polyline fill="none" stroke="hsl({137 * k % 360},60%,40%)" points="{" ".join(at(*p) for p in ps)}"><title>{escape.escape(run)}</title></polyline>' for k, (run, ps) in enumerate(sorted(lines.items()))]
    svg = f'<svg viewBox="0 0 {width} {height}" width="{width}">{"".join(drawn)}</svg>'
    return f"<!doctype html><meta charset=utf-8><title>runs</title><pre>{escape.escape(summary(table))}</pre>{svg}"


def _by_run():
    from pyspark.sql import Window as W

    return W.partitionBy("run").orderBy("date")
