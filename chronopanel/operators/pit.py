"""Point-in-time joins against half-open validity intervals [start, end); a NULL end is open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def valid(date: Column, start: Column, end: Column) -> Column:
    return (date >= start) & (end.isNull() | (date < end))


def overlaps(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return (end_b.isNull() | (start_a < end_b)) & (end_a.isNull() | (start_b < end_a))


def join_intervals(rows: DataFrame, spans: DataFrame, key: str = "ticker", date: str = "date", how: str = "inner") -> DataFrame:
    """Rows with the intervals that hold on their date: a hash or merge join on the key with the range as residual. The engine
    broadcasts the spans only if they are as small as its threshold."""
    s = spans.select(F.col(key).alias("__k"), F.col("start").alias("__s"), F.col("end").alias("__e"), *[c for c in spans.columns if c not in (key, "start", "end")])
    cond = (rows[key] == s["__k"]) & valid(rows[date], s["__s"], s["__e"])
    out = rows.join(s, cond, how)
    return out if how in ("left_semi", "left_anti") else out.withColumn("start", F.col("__s")).withColumn("end", F.col("__e")).drop("__k", "__s", "__e")


def members_on(rows: DataFrame, spans: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Rows whose label is a member on their date, each once however many spans hold."""
    return join_intervals(rows, spans, key, date, "left_semi")


def snapshots_to_intervals(snaps: DataFrame) -> DataFrame:
    """(date, ticker) on change dates to (ticker, start, end): runs of neighbouring snapshot dates are islands."""
    dates = snaps.select("date").distinct()
    w = W.orderBy("date")  # one row for each snapshot date
    numbered = dates.select("date", F.row_number().over(w).alias("__n"), F.lead("date").over(w).alias("__next"))
    rows = snaps.select("date", "ticker").distinct().join(numbered, "date")
    run = F.col("__n") - F.row_number().over(W.partitionBy("ticker").orderBy("date"))
    return (
        rows.withColumn("__run", run)
        .groupBy("ticker", "__run")
        .agg(F.min("date").alias("start"), F.max_by("__next", "date").alias("end"))
        .drop("__run")
    )


def intervals_to_snapshots(spans: DataFrame, dates: DataFrame) -> DataFrame:
    """Members on each of the given dates."""
    d = dates.select(F.col("date").alias("__d")).distinct()
    return d.join(spans, valid(F.col("__d"), F.col("start"), F.col("end"))).select(F.col("__d").alias("date"), "ticker").distinct()


def member_changes(snaps: DataFrame) -> DataFrame:
    """(date, ticker, change) between neighbouring snapshots: +1 joins, -1 leaves. The first snapshot has no changes."""
    spans = snapshots_to_intervals(snaps)
    first = snaps.agg(F.min("date").alias("__first"))
    joined = spans.select(F.col("start").alias("date"), "ticker", F.lit(1).alias("change"))
    left = spans.where("end IS NOT NULL").select(F.col("end").alias("date"), "ticker", F.lit(-1).alias("change"))
    return joined.unionByName(left).join(F.broadcast(first), F.col("date") > F.col("__first")).drop("__first")


def replay(changes: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Members after each date of a change log (date, seq, added, removed): a label is held if its last event is an addition.
    Within a row the removal comes first."""
    out = changes.where("removed IS NOT NULL").select("date", "seq", F.lit(0).alias("step"), F.col("removed").alias("ticker"), F.lit(False).alias("held"))
    in_ = changes.where("added IS NOT NULL").select("date", "seq", F.lit(1).alias("step"), F.col("added").alias("ticker"), F.lit(True).alias("held"))
    ends = out.unionByName(in_).groupBy("ticker", "date").agg(F.max_by("held", F.struct("seq", "step")).alias("held"))
    w = W.partitionBy("ticker").orderBy("date")
    spans = ends.withColumn("end", F.lead("date").over(w)).where("held").select("ticker", F.col("date").alias("start"), "end")
    return intervals_to_snapshots(spans, dates if dates is not None else changes.select("date"))
