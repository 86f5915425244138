"""Ranking, choosing and weighting labels within a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import col, ratio


def top(df: DataFrame, score: str, n: int, ascending: bool = False, by: str | list[str] = "date") -> DataFrame:
    """The n best labels of each date; NULL scores drop out, ties go to the smaller label. Planned with a limit before the shuffle."""
    keys = [by] if isinstance(by, str) else by
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = W.partitionBy(*keys).orderBy(order, "ticker")
    return df.where(F.col(score).isNotNull()).withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).withColumnRenamed("__k", "place")


def average_rank(score: str, ascending: bool = False, by: str = "date") -> Column:
    """Rank with ties sharing their mean; NULL for NULL."""
    order = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    ties = F.count(F.lit(1)).over(W.partitionBy(by, score))
    return F.when(F.col(score).isNotNull(), F.rank().over(W.partitionBy(by).orderBy(order)) + (ties - 1) / 2.0)


def where_true(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(F.coalesce(condition, F.lit(False)))


def equal_weight(total: float = 1.0, by: str = "date") -> Column:
    return F.lit(total) / F.count(F.lit(1)).over(W.partitionBy(by))


def inverse_vol_weight(vol: str, total: float = 1.0, by: str = "date") -> Column:
    """Weights by 1/volatility; zero counts as missing, missing ones get the median of the rest."""
    w = W.partitionBy(by)
    inv = ratio(F.lit(1.0), F.when(F.col(vol) != 0, F.col(vol)))
    filled = F.coalesce(inv, F.percentile(inv, F.lit(0.5)).over(w))
    return F.lit(total) * ratio(filled, F.sum(filled).over(w))


def eligible(panel: DataFrame, min_history: int = 0, min_dollar_volume: float = 0.0, history: str = "history", dollars: str = "dollars") -> DataFrame:
    """Tradable rows with enough history and turnover."""
    out = panel.where(F.col("close").isNotNull())
    if min_history:
        out = out.where(F.col(history) >= min_history)
    if min_dollar_volume:
        out = out.where(F.col(dollars) >= min_dollar_volume)
    return out


PERIODS = {
    "daily": lambda d: d, "weekly": lambda d: F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.extract(F.lit("WEEK"), d), "monthly": lambda d: F.trunc(d, "month"),
    "quarterly": lambda d: F.trunc(d, "quarter"), "annual": lambda d: F.trunc(d, "year"),
}


def rebalance_days(days: DataFrame, schedule: str = "monthly", when: str = "end") -> DataFrame:
    """First or last calendar date of each period; a partial last period has one too."""
    pick = F.max("date") if when == "end" else F.min("date")
    return days.select("date", PERIODS[schedule](col("date")).alias("__p")).groupBy("__p").agg(pick.alias("date")).select("date")


def month_end(df: DataFrame, value: str, by: str = "ticker") -> DataFrame:
    """Last value of each calendar month, labelled with the month's end; months without a row between others are NULL rows."""
    got = df.where(F.col(value).isNotNull()).groupBy(by, F.last_day("date").alias("month")).agg(F.max_by(value, "date").alias(value))
    ends = got.groupBy(by).agg(F.min("month").alias("a"), F.max("month").alias("b"))
    every = ends.select(by, F.explode(F.expr("sequence(trunc(a, 'month'), trunc(b, 'month'), interval 1 month)")).alias("m")).select(by, F.last_day("m").alias("month"))
    return every.join(got, [by, "month"], "left")
