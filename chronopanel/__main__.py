"""Simulates a strategy from a file: python -m chronopanel strategy.py --bars DIR [--set name=value ...] [--sweep name=a,b,c] [--html FILE]."""

from __future__ import annotations

import argparse
import ast

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import ship
from .operators import grid, ledger, pit, report


def value(text: str):
    """A literal, or the text itself."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronopanel", description=__doc__)
    p.add_argument("strategy", help="a Python file that defines a Strategy")
    p.add_argument("--bars", required=True, help="parquet: ticker, date, close, and what the strategy names")
    p.add_argument("--spans", help="parquet of memberships: ticker, start, end; without it every label is a member")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a setting")
    p.add_argument("--sweep", metavar="NAME=A,B,C", help="one run for each value of a setting")
    p.add_argument("--events", help="parquet folder for all events")
    p.add_argument("--html", help="file for a page with summary and lines")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("chronopanel").getOrCreate()
    ship(spark)
    settings = {k: value(v) for k, v in (x.split("=", 1) for x in a.set)}
    runs = {"run": ledger.load(a.strategy, **settings)}
    if a.sweep:
        name, values = a.sweep.split("=", 1)
        runs = ledger.sweep(lambda: ledger.load(a.strategy, **settings), name, [value(v) for v in values.split(",")])
    bars = spark.read.parquet(a.bars)
    panel = grid.dense(bars, [c for c in bars.columns if c not in ("ticker", "date")])
    if a.spans:
        members = pit.members_on(panel.select("ticker", "date"), spark.read.parquet(a.spans)).distinct().withColumn("member", F.lit(True))
        panel = panel.join(members, ["ticker", "date"], "left").withColumn("member", F.coalesce("member", F.lit(False)))
    events = ledger.simulate(panel, runs)
    if a.events:
        events.write.mode("overwrite").parquet(a.events)
        events = spark.read.parquet(a.events)
    else:
        events = events.persist()
    named = next((s.benchmark for s in runs.values() if s.benchmark), None)
    bench = ledger.benchmark(panel, named, 1.0) if named else None
    table = report.figures(events, bench)
    if a.html:
        with open(a.html, "w", encoding="utf-8") as f:
            f.write(report.html(table, ledger.equity(events)))
    return report.summary(table)


if __name__ == "__main__":
    print(main())
