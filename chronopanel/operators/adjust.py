"""Series construction: factors of corporate actions, patches, splices, carves, cuts and repairs.

Every operator works on all labels at once; the small tables of actions and rules are joined, and the engine broadcasts them when they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .grid import by_label
from .reconcile import _kept


def later_product(x: str) -> Column:
    """Product of all later rows of the label; 1 on the last."""
    return F.coalesce(F.product(x).over(by_label().rowsBetween(1, W.unboundedFollowing)), F.lit(1.0))


def basis(rows: DataFrame, raw_sources: list[str]) -> DataFrame:
    """Adds `raw`: whether a label's closes are not split-adjusted, by its most frequent source (-patch and -splice rows do not
    count; ties go to the first name)."""
    n = rows.where(~F.col("source").rlike("-(patch|splice)$")).groupBy("ticker", "source").agg(F.count("*").alias("n"))
    main = n.groupBy("ticker").agg(F.min_by("source", F.struct(-F.col("n"), F.col("source"))).alias("main"))
    return rows.join(main, "ticker", "left").withColumn("raw", F.coalesce(F.col("main").isin(raw_sources), F.lit(False))).drop("main")


def back_adjust(rows: DataFrame, reject_share: float = 0.2, reject_drop: float = 0.25) -> DataFrame:
    """adj_close = close x product of the later days' factors, factor = (P / (P + D) if D > 0 else 1) / split.

    rows: ticker, date, close, dividends, stock_splits, raw. A split of 0 or NULL is 1 and counts only on a raw basis. P is the close
    of the day. A distribution above `reject_share` of the last close is rejected if the price fell by less than
    `reject_drop` of it. History up to the last factor that is not positive is cut.
    """
    w = by_label()
    split = F.when(F.coalesce("stock_splits", F.lit(0.0)) == 0, 1.0).otherwise(F.col("stock_splits"))
    d = rows.withColumn("__split", F.when(F.col("raw"), split).otherwise(1.0)).withColumn("__before", F.lag("close").over(w)).withColumn("__div", F.coalesce("dividends", F.lit(0.0)))
    paid = F.col("__div") * F.col("__split")
    fall = F.col("__before") - F.col("close") * F.col("__split")
    bad = (F.col("__div") > 0) & (paid > reject_share * F.col("__before")) & (fall < reject_drop * paid)
    d = d.withColumn("rejected", F.coalesce(bad, F.lit(False)))
    d = d.withColumn("factor", F.when((F.col("__div") > 0) & ~F.col("rejected"), ratio("close", F.col("close") + F.col("__div"))).otherwise(1.0) / F.col("__split"))
    cut = F.max(F.when(F.col("factor") <= 0, F.col("date"))).over(W.partitionBy("ticker"))
    d = d.withColumn("__cut", cut).where(F.col("__cut").isNull() | (F.col("date") > F.col("__cut")))
    return d.withColumn("adj_close", F.col("close") * later_product("factor")).drop("__split", "__before", "__div", "__cut")


def spinoff_factors(rows: DataFrame, spins: DataFrame) -> DataFrame:
    """Replaces the factor on spin-off dates: the holder's return (p1 shares + sum of ratio x spun price + cash) / p0.

    spins: ticker, ex_date, parent_prev_close, parent_close, ratio, spinco_close, parent_shares?, cash?. Refused without positive prices."""
    s = spins.groupBy("ticker", F.col("ex_date").alias("date")).agg(
        F.first("parent_prev_close").alias("__p0"), F.first("parent_close").alias("__p1"), F.sum(F.col("ratio") * F.col("spinco_close")).alias("__spun"),
        F.max(F.coalesce("parent_shares", F.lit(1.0))).alias("__ps"), F.max(F.coalesce("cash", F.lit(0.0))).alias("__cash"),
    )
    target = ratio(F.col("__p1") * F.col("__ps") + F.col("__spun") + F.col("__cash"), "__p0")
    before = F.lag("close").over(by_label())
    out = rows.withColumn("__before", before).join(s, ["ticker", "date"], "left").withColumn("__new", ratio("close", F.col("__before") * target))
    ok = (F.col("__p0") > 0) & (F.col("__p1") > 0) & (target > 0)
    return out.withColumn("factor", F.when(ok & F.col("__new").isNotNull(), F.col("__new")).otherwise(F.col("factor"))).drop("__before", "__p0", "__p1", "__spun", "__ps", "__cash", "__new")


def rescale_dividends(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Dividends before a date are divided: rules (ticker, before, divide_by)."""
    out = rows.join(rules.select("ticker", "before", "divide_by"), "ticker", "left")
    hit = F.col("date") < F.col("before")
    return out.withColumn("dividends", F.when(hit, ratio("dividends", "divide_by")).otherwise(F.col("dividends"))).drop("before", "divide_by")


def override_actions(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Splits and dividends of single days replaced where a rule has a value: (ticker, date, split_factor?, dividend?)."""
    out = rows.join(rules.select("ticker", "date", "split_factor", "dividend"), ["ticker", "date"], "left")
    return out.withColumn("stock_splits", F.coalesce("split_factor", "stock_splits")).withColumn("dividends", F.coalesce("dividend", "dividends")).drop("split_factor", "dividend")


def patch_prices(rows: DataFrame, patches: DataFrame, limit: float = 0.05) -> DataFrame:
    """fill adds missing days; replace and replace_close change a close that moves by less than the limit (or the patch's max_move).

    patches: ticker, date, close, action, max_move?, source?. Rows keep their columns; the source of a changed or added row is that of the patch,
    or of the row or else of the label's rows, and ends in -patch."""
    if "source" not in patches.columns:
        patches = patches.withColumn("source", F.lit(None).cast("string"))
    usual = rows.groupBy("ticker").agg(F.mode("source").alias("__usual"))
    fill = patches.where("action = 'fill'").join(rows.select("ticker", "date"), ["ticker", "date"], "left_anti").join(usual, "ticker", "left")
    fill = fill.select("ticker", "date", "close", F.concat(F.coalesce("source", "__usual", F.lit("")), F.lit("-patch")).alias("source"))
    p = patches.where("action <> 'fill'").select("ticker", "date", F.col("close").alias("__new"), F.coalesce("max_move", F.lit(limit)).alias("__most"), F.col("source").alias("__from"))
    out = rows.join(p, ["ticker", "date"], "left")
    ok = F.abs(ratio("__new", "close") - 1.0) <= F.col("__most")
    out = out.withColumn("source", F.when(ok, F.concat(F.coalesce("__from", "source"), F.lit("-patch"))).otherwise(F.col("source"))).withColumn("close", F.when(ok, F.col("__new")).otherwise(F.col("close")))
    return out.drop("__new", "__most", "__from").unionByName(fill, allowMissingColumns=True)


def placeholders(rows: DataFrame, removals: DataFrame, days: int = 7) -> DataFrame:
    """Rows that only repeat the last close: no volume, flat, not the last row, not within some days of a removal (ticker, removed)."""
    w = by_label()
    x = rows.withColumn("__before", F.lag("close").over(w)).withColumn("__last", F.lead("date").over(w).isNull())
    flat = (F.coalesce("volume", F.lit(0.0)) == 0) & (F.col("open") == F.col("close")) & (F.col("high") == F.col("close")) & (F.col("low") == F.col("close")) & (F.col("close") == F.col("__before"))
    x = x.where(flat & ~F.col("__last"))
    r = removals.select(F.col("ticker").alias("__t"), "removed")
    near = (x["ticker"] == r["__t"]) & (F.abs(F.datediff(x["date"], r["removed"])) <= days)
    return x.join(r, near, "left_anti").drop("__before", "__last")


def trim_filler(rows: DataFrame, days: int = 30) -> DataFrame:
    """Drops the flat bars at a label's end if its last real bar is older than some days before the last date."""
    w = W.partitionBy("ticker")
    real = (F.coalesce("volume", F.lit(0.0)) > 0) | (F.col("high") != F.col("low")) | (F.col("open") != F.col("close"))
    x = rows.withColumn("__real", F.max(F.when(real, F.col("date"))).over(w)).withColumn("__end", F.max("date").over(w))
    keep = F.col("__real").isNull() | (F.datediff("__end", "__real") <= days) | (F.col("date") <= F.col("__real"))
    return x.where(keep).drop("__real", "__end")


PRICES = ["open", "high", "low", "close", "dividends"]


def splice_check(own: DataFrame, other: DataFrame, least: int = 60, tolerance: float = 0.005) -> DataFrame:
    """Overlap of two series per label: days, median ratio, spread (q95 - q05) / median, accepted."""
    j = own.select("ticker", "date", F.col("close").alias("a")).join(other.select("ticker", "date", F.col("close").alias("b")), ["ticker", "date"])
    q = lambda p: F.percentile(ratio("a", "b"), F.lit(p))
    s = j.groupBy("ticker").agg(F.count(ratio("a", "b")).alias("days"), q(0.5).alias("ratio"), q(0.05).alias("q05"), q(0.95).alias("q95"))
    s = s.withColumn("spread", ratio(F.col("q95") - F.col("q05"), "ratio"))
    return s.select("ticker", "days", "ratio", "spread", F.coalesce((F.col("days") >= least) & (F.col("spread") <= tolerance), F.lit(False)).alias("accepted"))


def splice(own: DataFrame, other: DataFrame, least: int = 60, tolerance: float = 0.005) -> DataFrame:
    """Accepted labels get the other series' rows before their own first date, scaled by the median ratio."""
    first = own.groupBy("ticker").agg(F.min("date").alias("before"))
    rules = first.select("ticker", F.col("ticker").alias("prefix"), "before")
    return splice_prefixes(own, other, rules, least, tolerance)[0]


def splice_prefixes(own: DataFrame, prefixes: DataFrame, rules: DataFrame, least: int = 60, tolerance: float = 0.005) -> tuple[DataFrame, DataFrame]:
    """Puts earlier histories in front of series, and reports each: (label, prefix, before, turn, days, ratio, spread, accepted).

    rules: ticker, prefix, before, and optionally tol (spread allowed instead of the default), ratio (declared instead of measured), drop_own
    (the label's own rows before the date give way). `prefixes` has the rows of all prefixes, labelled by them. A prefix is scaled by the
    median ratio of closes on common days, refused with fewer than `least` of them or a larger spread; its prices and dividends are all
    scaled, days that the label has are left out, and its rows' source ends in -splice. Of several prefixes of a label the newest comes first, each in
    front of what the newer ones made."""
    for name, kind in (("tol", "double"), ("ratio", "double"), ("drop_own", "boolean")):
        if name not in rules.columns:
            rules = rules.withColumn(name, F.lit(None).cast(kind))
    rules = rules.withColumn("turn", F.row_number().over(W.partitionBy("ticker").orderBy(F.desc("before"), "prefix")))
    turns = rules.agg(F.max("turn")).first()[0] or 0  # prefixes of one label: a handful
    report = None
    for turn in range(1, turns + 1):
        now = rules.where(F.col("turn") == turn).drop("turn")
        mine = own.join(now.select("ticker", F.col("before").alias("__d"), F.coalesce("drop_own", F.lit(False)).alias("__drop")), "ticker", "left")
        stay = mine.where(~F.coalesce(F.col("__drop") & (F.col("date") < F.col("__d")), F.lit(False))).select(*own.columns)
        old = prefixes.withColumnRenamed("ticker", "prefix").join(now.select("ticker", "prefix", "before"), "prefix")
        seen = splice_check(stay, old, least, tolerance).select("ticker", "days", F.col("ratio").alias("__measured"), "spread")
        said = now.join(seen, "ticker", "left").withColumn("days", F.coalesce("days", F.lit(0)))
        good = F.col("ratio").isNotNull() | ((F.col("days") >= least) & (F.col("spread") <= F.coalesce("tol", F.lit(tolerance))))
        said = _kept(said.select("ticker", "prefix", "before", F.lit(turn).alias("turn"), "days", F.coalesce("ratio", "__measured").alias("ratio"), "spread", F.coalesce(good, F.lit(False)).alias("accepted"), "drop_own"))
        taken = said.where("accepted").select("ticker", "prefix", F.col("ratio").alias("__k"), F.coalesce("drop_own", F.lit(False)).alias("__drop"), F.col("before").alias("__d"))
        # a refused prefix leaves the label as it was
        cut = own.join(taken.where("__drop").select("ticker", "__d"), "ticker", "left").where(F.col("__d").isNull() | (F.col("date") >= F.col("__d"))).select(*own.columns)
        add = old.drop("before").join(taken.select("ticker", "prefix", "__k", "__d"), ["ticker", "prefix"]).where(F.col("date") < F.col("__d")).join(cut.select("ticker", "date"), ["ticker", "date"], "left_anti")
        add = add.select("ticker", "date", *[(F.col(c) * F.col("__k")).alias(c) if c in PRICES else F.concat(c, F.lit("-splice")).alias(c) if c == "source" else F.col(c) for c in own.columns if c in prefixes.columns and c not in ("ticker", "date")])
        own = cut.unionByName(add, allowMissingColumns=True).select(*own.columns)
        own = _kept(own) if turn < turns else own
        report = said.drop("drop_own") if report is None else report.unionByName(said.drop("drop_own"))
    return own, report


def carve(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of a span moved to a new label, times the product of the source's later splits: (label, source_label, first, last)."""
    x = rows.withColumn("__later", later_product("stock_splits"))
    r = rules.select("label", "source_label", F.col("first").alias("__a"), F.col("last").alias("__b"))
    out = x.join(r, (F.col("ticker") == F.col("source_label")) & F.col("date").between(F.col("__a"), F.col("__b")))
    return out.withColumn("close", F.col("close") * F.col("__later")).withColumn("ticker", F.col("label")).select(*rows.columns)


def cut_series(rows: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """First and last allowed days of labels: (ticker, first_day), (ticker, last_day)."""
    x = rows.join(starts, "ticker", "left").join(ends, "ticker", "left")
    return x.where((F.col("first_day").isNull() | (F.col("date") >= F.col("first_day"))) & (F.col("last_day").isNull() | (F.col("date") <= F.col("last_day")))).drop("first_day", "last_day")


def exit_gaps(rows: DataFrame, ends: DataFrame, days: int = 5, change: float = 0.25) -> DataFrame:
    """Removals (ticker, removed) around which trade stops: last row before and first at or after, apart by days and price."""
    j = ends.join(rows.select("ticker", "date", "close"), "ticker")
    g = j.groupBy("ticker", "removed").agg(
        F.max(F.when(F.col("date") < F.col("removed"), F.struct("date", "close"))).alias("a"), F.min(F.when(F.col("date") >= F.col("removed"), F.struct("date", "close"))).alias("b")
    )
    gap, move = F.datediff("b.date", "a.date"), ratio("b.close", "a.close") - 1.0
    return g.where((gap >= days) & (F.abs(move) > change)).select("ticker", "removed", F.col("a.date").alias("last_trade"), F.col("b.date").alias("next_trade"), gap.alias("gap_days"), move.alias("change"))


def actions_from_ratio(rows: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Dividends implied by steps of adj/close: D = close before x (1 - step), where the step is a fall of the ratio backwards."""
    w = by_label()
    x = rows.withColumn("__f", ratio("adj_close", "close"))
    step = ratio(F.lag("__f").over(w), "__f")
    return x.withColumn("dividends", F.when(step < 1.0 - tolerance, F.lag("close").over(w) * (1.0 - step)).otherwise(0.0)).drop("__f")


def implied_distribution(rows: DataFrame) -> DataFrame:
    """prev x (1 + total return) - close: what a total return says was paid."""
    return rows.withColumn("implied", F.lag("close").over(by_label()) * (1.0 + F.col("ret")) - F.col("close"))


def truncation_guard(old: DataFrame, new: DataFrame, days: int = 30) -> DataFrame:
    """Labels whose new history starts much later than the old one keep their older rows."""
    starts = old.groupBy("ticker").agg(F.min("date").alias("__o")).join(new.groupBy("ticker").agg(F.min("date").alias("__n")), "ticker")
    cut = starts.where(F.datediff("__n", "__o") > days).select("ticker", "__n")
    kept = old.join(cut, "ticker").where(F.col("date") < F.col("__n")).select(*new.columns)
    return new.unionByName(kept)
