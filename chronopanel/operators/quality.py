"""Checks of a dataset, each one row: check, failures, status (PASS, FAIL or UNVERIFIED)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .grid import by_label
from .pit import join_intervals, members_on
from .reconcile import within_days


def status(failures: Column, known: Column | None = None) -> Column:
    """An unknown outcome is never a pass."""
    out = F.when(failures > 0, "FAIL").otherwise("PASS")
    return out if known is None else F.when(known, out).otherwise("UNVERIFIED")


def structure(bars: DataFrame) -> DataFrame:
    """Duplicates, weekends, prices that are not positive, and bars whose low and high do not hold the rest: one pass and one count of keys."""
    tests = {
        "weekend": F.weekday("date") >= 5,
        "not_positive": F.least("open", "high", "low", "close") <= 0,
        "ohlc": (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high")),
        "no_close": F.col("close").isNull(),
    }
    counts = bars.agg(*[F.count_if(c).alias(n) for n, c in tests.items()], F.count("*").alias("__n"))
    dup = bars.groupBy("ticker", "date").count().where("count > 1").agg(F.count("*").alias("duplicates"))
    names = ["duplicates", *tests]
    long = counts.crossJoin(dup).select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in names])).alias("x"), "__n")
    return long.select("x.check", "x.failures", status(F.col("x.failures"), F.col("__n") > 0).alias("status"))


def freshness(bars: DataFrame, days: int = 10) -> DataFrame:
    """Labels whose last row is older than some days before the last date of all."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("last"))
    return last.crossJoin(F.broadcast(last.agg(F.max("last").alias("__end")))).where(F.datediff("__end", "last") > days).select("ticker", "last", F.datediff("__end", "last").alias("age"))


def member_counts(spans: DataFrame, dates: DataFrame, low: int, high: int) -> DataFrame:
    """Members on each date and whether their number is in bounds."""
    d = dates.select(F.col("date").alias("date")).distinct()
    j = d.join(spans, (F.col("date") >= F.col("start")) & (F.col("end").isNull() | (F.col("date") < F.col("end"))), "left")
    return j.groupBy("date").agg(F.countDistinct("ticker").alias("n")).withColumn("ok", F.col("n").between(low, high))


def recycled(bars: DataFrame, spans: DataFrame) -> DataFrame:
    """Labels whose prices begin after their last closed membership ended: another company."""
    left = spans.groupBy("ticker").agg(F.max("end").alias("left"), F.max(F.col("end").isNull()).alias("open"))
    first = bars.groupBy("ticker").agg(F.min("date").alias("px_start"))
    return left.where("left IS NOT NULL AND NOT open").join(first, "ticker").where("px_start > left").select("ticker", "left", "px_start")


def coverage(bars: DataFrame, spans: DataFrame, by: str = "month") -> DataFrame:
    """Share of member-days with a price, by period; member-days run over the dates of the bars."""
    days = bars.select("date").distinct()
    due = days.crossJoin(spans.select("ticker").distinct())
    due = members_on(due, spans)
    have = due.join(bars.select("ticker", "date", F.lit(1).alias("__p")), ["ticker", "date"], "left")
    return have.groupBy(F.trunc("date", by).alias("period")).agg(F.count("*").alias("due"), F.count("__p").alias("have")).withColumn("share", ratio("have", "due"))


def reconcile_adjustment(rows: DataFrame, within: float = 0.0005) -> DataFrame:
    """Adjusted returns against (close x split + dividend) / close before - 1: largest daily difference, and that of wealth."""
    w = by_label()
    holder = ratio(F.col("close") * F.coalesce("stock_splits", F.lit(1.0)) + F.coalesce("dividends", F.lit(0.0)), F.lag("close").over(w))
    adjusted = ratio("adj_close", F.lag("adj_close").over(w))
    x = rows.withColumn("__h", holder).withColumn("__a", adjusted).where("__h IS NOT NULL AND __a IS NOT NULL")
    s = x.groupBy("ticker").agg(F.max(F.abs(F.col("__h") - F.col("__a"))).alias("worst_day"), F.abs(F.product("__a") / F.product("__h") - 1.0).alias("wealth"), F.count("*").alias("days"))
    return s.withColumn("status", status((F.col("worst_day") > within).cast("int")))


def dividend_basis(rows: DataFrame, digits: int = 4, tolerance: float = 1e-6, least: int = 4) -> DataFrame:
    """Share of dividends that are round as paid and after undoing later splits: which basis a source uses."""
    later = F.coalesce(F.product(F.coalesce("stock_splits", F.lit(1.0))).over(by_label().rowsBetween(1, W.unboundedFollowing)), F.lit(1.0))
    k = float(10**digits)
    is_round = lambda c: (F.abs(c * k - F.floor(c * k + 0.5)) < tolerance * k).cast("double")
    x = rows.withColumn("__later", later).where("dividends > 0")
    return x.groupBy("ticker").agg(F.count("*").alias("n"), F.avg(is_round(F.col("dividends"))).alias("as_is"), F.avg(is_round(F.col("dividends") * F.col("__later"))).alias("unsplit")).where(F.col("n") >= least)


def big_moves(bars: DataFrame, spans: DataFrame, size: float) -> DataFrame:
    """Member-days whose close moves by more than some share."""
    x = bars.withColumn("move", ratio("close", F.lag("close").over(by_label())) - 1.0).where(F.abs("move") > size)
    return members_on(x, spans).select("ticker", "date", "move")


def volume_spikes(bars: DataFrame, events: DataFrame, before: int = 60, gap: int = 14, after: int = 6, lead: int = 12) -> DataFrame:
    """For each event (ticker, event): median volume `gap` to `before` days earlier, and the peak from `lead` days before to `after` days after."""
    j = within_days(events, bars.select("ticker", "date", "volume"), "ticker", "event", "date", max(before, after)).withColumn("__d", F.datediff("date", "event")).where(F.col("__d").between(-before, after))
    calm, near = F.col("__d").between(-before, -gap), F.col("__d").between(-lead, after)
    g = j.groupBy("ticker", "event").agg(
        F.median(F.when(calm, F.col("volume"))).alias("usual"), F.max(F.when(near, F.struct("volume", F.col("date").alias("at")))).alias("p"),
    )
    return g.select("ticker", "event", "usual", F.col("p.volume").alias("peak"), F.col("p.at").alias("at"), ratio("p.volume", "usual").alias("times"))


def payment_gaps(payments: DataFrame, window: int = 5, late: float = 1.6) -> DataFrame:
    """Payments (ticker, date): days since the last one, the median gap of the last few, and whether one was skipped."""
    w = by_label()
    x = payments.withColumn("gap", F.datediff("date", F.lag("date").over(w)).cast("double"))
    x = x.withColumn("usual", F.percentile(F.col("gap"), F.lit(0.5)).over(w.rowsBetween(-window, -1)))
    return x.select("ticker", "date", "gap", "usual", (F.col("gap") > late * F.col("usual")).alias("skipped"))


def index_rebuild(bars: DataFrame, spans: DataFrame, published: DataFrame) -> DataFrame:
    """Equal-weight mean return of members each date against a published level (date, level)."""
    x = bars.withColumn("ret", ratio("close", F.lag("close").over(by_label())) - 1.0).where("ret IS NOT NULL")
    mean = members_on(x, spans).groupBy("date").agg(F.avg("ret").alias("rebuilt"), F.count("*").alias("n"))
    p = published.withColumn("published", ratio("level", F.lag("level").over(W.orderBy("date"))) - 1.0)
    return mean.join(p.select("date", "published"), "date")


def single_swap(days: DataFrame, tolerance: float) -> DataFrame:
    """For each day (index return, ours, theirs, weight-free means with either): whose value explains the index better."""
    a, b = F.abs(F.col("index") - F.col("with_ours")), F.abs(F.col("index") - F.col("with_theirs"))
    return days.withColumn("verdict", F.when(F.abs(a - b) <= tolerance, "undecided").when(a < b, "ours").otherwise("theirs"))


def spinoff_returns(rows: DataFrame, spins: DataFrame, within: float = 1e-6) -> DataFrame:
    """The return on each spin-off date (ticker, date, ret) against the holder's: parent's shares, the spun shares and cash, by the parent's
    last close. Without a row or a price before it is UNVERIFIED. spins as in `adjust.spinoff_factors`."""
    for name, value in (("parent_shares", 1.0), ("cash", 0.0)):
        if name not in spins.columns:
            spins = spins.withColumn(name, F.lit(value))
    s = spins.groupBy("ticker", "ex_date").agg(
        F.max("parent_prev_close").alias("__p0"), F.max(F.col("parent_close") * F.coalesce("parent_shares", F.lit(1.0)) + F.coalesce("cash", F.lit(0.0))).alias("__own"),
        F.sum(F.col("ratio") * F.col("spinco_close")).alias("__spun"),
    )
    got = s.join(rows.select("ticker", F.col("date").alias("ex_date"), "ret"), ["ticker", "ex_date"], "left")
    want = ratio(F.col("__own") + F.col("__spun"), "__p0") - 1.0
    off = F.abs(F.col("ret") - want)
    return got.select("ticker", "ex_date", want.alias("want"), "ret", status((off > within).cast("int"), off.isNotNull()).alias("status"))


def all_checks(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def member_rows(bars: DataFrame, spans: DataFrame) -> DataFrame:
    return join_intervals(bars, spans)
