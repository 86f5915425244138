"""Maintenance of membership intervals: renames, relabels, merges, edits of ends and starts, bridges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .grid import MAX_CALENDAR
from .reconcile import _kept


def _reach(edges: DataFrame) -> DataFrame:
    """(old, new, open): followed to its end, or as many times as there are labels; open if it could be followed further. Each round
    doubles the hops."""
    out = _kept(edges.select("old", "new", F.lit(True).alias("open")))
    for _ in range(out.count().bit_length() + 1):
        if not out.where("open").take(1):
            break
        ahead = out.select(F.col("old").alias("new"), F.col("new").alias("__n"))
        out = _kept(out.join(ahead, "new", "left").select("old", F.coalesce("__n", "new").alias("new"), F.col("__n").isNotNull().alias("open")))
    return out


def rename_closure(renames: DataFrame) -> DataFrame:
    """(old, new) followed to its end, however long; a label that runs into a cycle ends where the cycle would repeat itself."""
    first = _kept(renames.select("old", "new").where("old <> new").groupBy("old").agg(F.min("new").alias("new")))
    far = _reach(first)
    ring = far.where("open").select(F.col("new").alias("old")).distinct()
    if not ring.take(1):
        return far.select("old", "new")
    last = first.join(ring, "old", "left_semi").select(F.col("new").alias("old"), F.col("old").alias("__before"))
    tails = _reach(first.join(ring, "old", "left_anti")).select("old", "new")
    entered = tails.join(last.withColumnRenamed("old", "new"), "new", "left").select("old", F.coalesce("__before", "new").alias("new"))
    return entered.unionByName(last.withColumnRenamed("__before", "new"))


def apply_renames(df: DataFrame, renames: DataFrame) -> DataFrame:
    r = rename_closure(renames).select(F.col("old").alias("ticker"), "new")
    return df.join(r, "ticker", "left").withColumn("ticker", F.coalesce("new", "ticker")).drop("new")


def relabel(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of a bare label in [start, cutoff) get the rule's label: (bare, label, start, cutoff)."""
    r = rules.select("bare", "label", F.col("start").alias("__s"), F.col("cutoff").alias("__c"))
    cond = (F.col("ticker") == F.col("bare")) & (F.col("date") >= F.col("__s")) & (F.col("__c").isNull() | (F.col("date") < F.col("__c")))
    out = rows.join(r, cond, "left").withColumn("ticker", F.coalesce("label", "ticker"))
    return out.select(*rows.columns)


def edit_spans(spans: DataFrame, hold_until: DataFrame | None = None, end_early: DataFrame | None = None, start_late: DataFrame | None = None, start_early: DataFrame | None = None, add: DataFrame | None = None) -> DataFrame:
    """Edits by (ticker, day): the last span's end moves to a later or earlier day, the first span's start likewise; spans are added."""
    first, last = W.partitionBy("ticker").orderBy("start"), W.partitionBy("ticker").orderBy(F.desc("start"))
    out = spans.select("ticker", "start", "end").withColumn("__f", F.row_number().over(first) == 1).withColumn("__l", F.row_number().over(last) == 1)

    def joined(df: DataFrame, rule: DataFrame) -> DataFrame:
        return df.join(rule.select("ticker", F.col("day").alias("__d")), "ticker", "left")

    day = F.col("__d")
    for rule, column, cond in (
        (hold_until, "end", F.col("__l") & F.col("end").isNotNull() & (day > F.col("end"))),
        (end_early, "end", F.col("__l") & (day > F.col("start")) & (F.col("end").isNull() | (day < F.col("end")))),
        (start_late, "start", F.col("__f") & (day > F.col("start")) & (F.col("end").isNull() | (day < F.col("end")))),
        (start_early, "start", F.col("__f") & (day < F.col("start"))),
    ):
        if rule is not None:
            out = joined(out, rule).withColumn(column, F.when(F.coalesce(cond, F.lit(False)), day).otherwise(F.col(column))).drop("__d")
    out = out.select("ticker", "start", "end")
    return merge_spans(out if add is None else out.unionByName(add.select("ticker", "start", "end")))


def merge_spans(spans: DataFrame, gap: int = 0) -> DataFrame:
    """Overlapping or touching spans of a label become one; with `gap`, also those at most so many days apart."""
    far = F.lit("9999-12-31").cast("date")
    w = W.partitionBy("ticker").orderBy("start", "__e")
    x = spans.select("ticker", "start", F.coalesce("end", far).alias("__e"))
    x = x.withColumn("__upto", F.max("__e").over(w.rowsBetween(W.unboundedPreceding, -1)))
    new = F.col("__upto").isNull() | (F.datediff("start", "__upto") > gap)
    x = x.withColumn("__g", F.sum(new.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    g = x.groupBy("ticker", "__g").agg(F.min("start").alias("start"), F.max("__e").alias("__e"))
    return g.select("ticker", "start", F.when(F.col("__e") < far, F.col("__e")).alias("end"))


def bridge_gaps(spans: DataFrame, explained: DataFrame) -> DataFrame:
    """Gaps of labels that are members today are closed unless an explained removal (ticker, date) lies at their start."""
    w = W.partitionBy("ticker").orderBy("start")
    current = spans.where("end IS NULL").select("ticker").distinct()
    gaps = spans.withColumn("__next", F.lead("start").over(w)).where("end IS NOT NULL AND __next IS NOT NULL").join(current, "ticker", "left_semi")
    gaps = gaps.join(explained.select("ticker", F.col("date").alias("end")), ["ticker", "end"], "left_anti")
    return merge_spans(spans.select("ticker", "start", "end").unionByName(gaps.select("ticker", F.col("end").alias("start"), F.col("__next").alias("end"))))


def merge_labels(spans: DataFrame, pairs: DataFrame) -> DataFrame:
    """Spans of a bare label go to its suffixed label where that one exists: (bare, label)."""
    p = pairs.join(spans.select(F.col("ticker").alias("label")).distinct(), "label", "left_semi")
    out = spans.join(p.select(F.col("bare").alias("ticker"), "label"), "ticker", "left").withColumn("ticker", F.coalesce("label", "ticker")).drop("label")
    return merge_spans(out)


def prepend(spans: DataFrame, earlier: DataFrame, cutover) -> DataFrame:
    """Spans of an earlier era up to a date, before the later ones; what touches becomes one span."""
    cut = F.lit(cutover).cast("date")
    old = earlier.where(F.col("start") < cut).withColumn("end", F.when(F.col("end").isNull() | (F.col("end") > cut), cut).otherwise(F.col("end")))
    return merge_spans(spans.select("ticker", "start", "end").unionByName(old.select("ticker", "start", "end")))


def from_spells(spells: DataFrame, calendar: DataFrame, first: dt.date, until: dt.date) -> DataFrame:
    """Membership intervals from a list's spells (ticker, start, end: its last day) within [first, until): a start moves to the next trading day, an
    end to the trading day after the last one in the spell; a spell that reaches the window's last day ends with the window."""
    days = calendar.select(F.col("date").alias("__d")).where((F.col("__d") >= F.lit(first)) & (F.col("__d") < F.lit(until))).distinct()
    days = days.withColumn("__next", F.lead("__d").over(W.orderBy("__d")))  # a calendar: one small task
    s = spells.where((F.col("start") < F.lit(until)) & (F.col("end") >= F.lit(first))).withColumn("__s", F.greatest("start", F.lit(first))).withColumn("__e", F.least("end", F.date_sub(F.lit(until), 1)))
    listed = F.broadcast(days.agg(F.sort_array(F.collect_list(F.struct("__d", "__next"))).alias("__days")))  # bounded by MAX_CALENDAR days
    if days.count() > MAX_CALENDAR:
        raise ValueError("the calendar is too long")
    at = s.crossJoin(listed)
    begin = F.array_min(F.transform(F.filter("__days", lambda d: d["__d"] >= F.col("__s")), lambda d: d["__d"]))
    after = F.array_max(F.filter("__days", lambda d: d["__d"] <= F.col("__e")))["__next"]
    end = F.when(F.col("end") >= F.date_sub(F.lit(until), 1), F.lit(until)).otherwise(F.coalesce(after, F.lit(until)))
    return at.select("ticker", begin.alias("start"), end.alias("end"))


def coverage_counts(members: DataFrame, calendar: DataFrame) -> DataFrame:
    """Members on each trading day of intervals [start, end): by arrivals and leavings, without days x members."""
    moves = members.select(F.col("start").alias("date"), F.lit(1).alias("n")).unionByName(members.where("end IS NOT NULL").select(F.col("end").alias("date"), F.lit(-1).alias("n")))
    both = moves.unionByName(calendar.select("date").distinct().withColumn("n", F.lit(0))).groupBy("date").agg(F.sum("n").alias("n"))
    both = both.withColumn("members", F.sum("n").over(W.orderBy("date").rowsBetween(W.unboundedPreceding, 0)))
    return both.join(calendar.select("date").distinct(), "date", "left_semi").select("date", "members")
