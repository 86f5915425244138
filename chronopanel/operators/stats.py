"""Performance statistics of value series (key, date, value) and of trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio

DAYS = 252.0
#: Fewer shares than this are none.
NOTHING = 1e-9


def slope_no_intercept(df: DataFrame, key: str, x: str, e: str) -> DataFrame:
    """Least squares through the origin: slope, t and R2 for each key, from three sums."""
    s = df.groupBy(key).agg(F.sum(F.col(x) * F.col(e)).alias("xe"), F.sum(F.col(x) * F.col(x)).alias("xx"), F.sum(F.col(e) * F.col(e)).alias("ee"), F.count("*").alias("n"))
    slope, r2 = ratio("xe", "xx"), ratio(F.col("xe") * F.col("xe"), F.col("xx") * F.col("ee"))
    t = slope / F.sqrt(ratio(F.col("ee") - slope * F.col("xe"), (F.col("n") - 1) * F.col("xx")))
    return s.select(key, slope.alias("slope"), t.alias("t"), r2.alias("r2"), "n")


def series_stats(equity: DataFrame, key: str = "run") -> DataFrame:
    """Total return, CAGR, volatility, Sharpe, Sortino and drawdown figures of each series; all windows share one partitioning,
    and the series is read once. A fall is recovered on the next day that sets or meets the high."""
    w = W.partitionBy(key).orderBy("date")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    e = equity.withColumn("ret", ratio("value", F.lag("value").over(w)) - 1.0).withColumn("high", F.max("value").over(upto))
    e = e.withColumn("dd", F.col("value") / F.col("high") - 1.0).withColumn("peak", F.max(F.when(F.col("value") == F.col("high"), F.col("date"))).over(upto))
    e = e.withColumn("regained", F.min(F.when(F.col("dd") == 0, F.col("date"))).over(w.rowsBetween(1, W.unboundedFollowing)))
    s = e.groupBy(key).agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.min_by("value", "date").alias("first"), F.max_by("value", "date").alias("last"),
        F.stddev_samp("ret").alias("dev"), F.avg("ret").alias("mean"), F.stddev_samp(F.when(F.col("ret") < 0, F.col("ret"))).alias("down"),
        F.min("dd").alias("max_dd"), F.min_by(F.struct("date", "peak", "regained"), F.struct("dd", "date")).alias("low"), F.count("*").alias("days"),
    )
    years = F.datediff("end", "start") / 365.25
    cagr = F.when(years > 0, F.pow(ratio("last", "first"), 1.0 / years) - 1.0)
    vol = F.col("dev") * F.sqrt(F.lit(DAYS))
    return s.select(
        key, "start", "end", "days", (ratio("last", "first") - 1.0).alias("total"), cagr.alias("cagr"), vol.alias("vol"), ratio(F.col("mean") * DAYS, vol).alias("sharpe"),
        ratio(F.col("mean") * DAYS, F.col("down") * F.sqrt(F.lit(DAYS))).alias("sortino"), "max_dd", F.col("low.peak").alias("peak"), F.col("low.date").alias("trough"), F.col("low.regained").alias("recovered"),
        ratio(cagr, F.abs("max_dd")).alias("calmar"),
    )


def period_returns(equity: DataFrame, period: str = "year", key: str = "run") -> DataFrame:
    """Return of each year or month; the first runs from the first value."""
    p = F.trunc("date", period)
    g = equity.groupBy(key, p.alias("period")).agg(F.min_by("value", "date").alias("first"), F.max_by("value", "date").alias("last"))
    before = F.lag("last").over(W.partitionBy(key).orderBy("period"))
    return g.select(key, "period", (ratio("last", F.coalesce(before, F.col("first"))) - 1.0).alias("ret"))


def relative_stats(equity: DataFrame, benchmark: DataFrame, key: str = "run", least: int = 10) -> DataFrame:
    """Beta, alpha, correlation, tracking error and information ratio against a benchmark (date, bench)."""
    w = W.partitionBy(key).orderBy("date")
    j = equity.join(benchmark, "date")
    j = j.withColumn("r", ratio("value", F.lag("value").over(w)) - 1.0).withColumn("b", ratio("bench", F.lag("bench").over(w)) - 1.0).where("r IS NOT NULL AND b IS NOT NULL")
    d = F.col("r") - F.col("b")
    s = j.groupBy(key).agg(F.count("*").alias("n"), ratio(F.covar_samp("r", "b"), F.var_samp("b")).alias("beta"), F.avg("r").alias("mr"), F.avg("b").alias("mb"), F.corr("r", "b").alias("corr"), F.stddev_samp(d).alias("te"), F.avg(d).alias("md"))
    s = s.where(F.col("n") > least)
    te = F.col("te") * F.sqrt(F.lit(DAYS))
    return s.select(key, "n", "beta", ((F.col("mr") - F.col("beta") * F.col("mb")) * DAYS).alias("alpha"), "corr", te.alias("tracking_error"), ratio(F.col("md") * DAYS, te).alias("information_ratio"))


def round_trips(trades: DataFrame, key: str = "run") -> DataFrame:
    """Sales against the average cost of what a label's open trip holds: trades (run, ticker, date, side, shares, price, cost, seq?).

    One row for each sale of something held: trip, opened, closed, shares, cost, proceeds, pnl, ret, days. A trip opens with a purchase when nothing
    is held. Shares held are a running sum that cannot fall below zero: the sum less its lowest point so far. A sale leaves the share 1 - f of the
    pooled cost, so the cost before a sale is the product of what was left times the sum of the purchases, each divided by the
    product when it was made. All of it is windows in one order."""
    order = ["date", "seq"] if "seq" in trades.columns else ["date"]
    w = W.partitionBy(key, "ticker").orderBy(*order)
    upto, buy, size = w.rowsBetween(W.unboundedPreceding, 0), F.col("side") == "BUY", F.abs("shares")
    x = trades.withColumn("__sum", F.sum(F.when(buy, size).otherwise(-size)).over(upto))
    x = x.withColumn("__held", F.col("__sum") - F.least(F.lit(0.0), F.min("__sum").over(upto)))
    x = x.withColumn("__before", F.coalesce(F.lag("__held").over(w), F.lit(0.0)))
    x = x.withColumn("trip", F.sum((buy & (F.col("__before") <= NOTHING)).cast("int")).over(upto)).where(buy | (F.col("__before") > NOTHING))
    own = W.partitionBy(key, "ticker", "trip").orderBy(*order)
    past = own.rowsBetween(W.unboundedPreceding, -1)
    x = x.withColumn("__sold", F.when(~buy, F.least(size, F.col("__before")))).withColumn("__f", F.col("__sold") / F.col("__before"))
    x = x.withColumn("__log", F.when(F.col("__f") < 1, F.log1p(-F.col("__f"))).otherwise(0.0))
    x = x.withColumn("__left", F.exp(F.coalesce(F.sum("__log").over(past), F.lit(0.0))))
    x = x.withColumn("__paid", F.when(buy, (size * F.col("price") + F.col("cost")) / F.col("__left")).otherwise(0.0))
    x = x.withColumn("__cost", F.col("__f") * F.col("__left") * F.sum("__paid").over(past))
    x = x.withColumn("opened", F.min("date").over(W.partitionBy(key, "ticker", "trip"))).where(~buy)
    got = F.col("__sold") * F.col("price") - F.col("cost") * ratio("__sold", size)
    return x.select(
        key, "ticker", "trip", "opened", F.col("date").alias("closed"), F.col("__sold").alias("shares"), F.col("__cost").alias("cost"), got.alias("proceeds"),
        (got - F.col("__cost")).alias("pnl"), (ratio(got, "__cost") - 1.0).alias("ret"), F.datediff("date", "opened").alias("days"),
    )


def trip_stats(trips: DataFrame, key: str = "run") -> DataFrame:
    win = F.col("pnl") > 0
    return trips.groupBy(key).agg(
        F.count("*").alias("trips"), F.avg(win.cast("double")).alias("win_rate"), F.avg(F.when(win, F.col("ret"))).alias("avg_win"), F.avg(F.when(~win, F.col("ret"))).alias("avg_loss"),
        F.avg("days").alias("avg_days"), F.max("ret").alias("best"), F.min("ret").alias("worst"),
    )
