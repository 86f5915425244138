"""The dense panel: one row for each label and calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A calendar is broadcast up to this many entries (a million days are 2,700 years).
MAX_CALENDAR = 1_000_000
FIELDS = ["open", "high", "low", "close", "volume"]


def calendar(bars: DataFrame) -> DataFrame:
    """All dates on which any label has a row, numbered from 0. One number a date: the window is as small as the calendar."""
    days = bars.select("date").distinct()
    return days.withColumn("day", F.row_number().over(W.orderBy("date")) - 1)


def dense(bars: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Labels x calendar with NULL where a label has no row. The calendar is broadcast behind a check of its size; labels
    are dealt once, by label, which the windows of the indicators use again."""
    fields = [f for f in (fields or FIELDS) if f in bars.columns]
    days = calendar(bars)
    n = days.count()
    if n > MAX_CALENDAR:
        raise ValueError(f"a calendar of {n} entries")
    frame = bars.select("ticker").distinct().crossJoin(F.broadcast(days))
    return frame.join(bars.select("ticker", "date", *fields), ["ticker", "date"], "left")


def by_label() -> W:
    """A label's rows by date; rows without one come last, as in the SQL of queries."""
    return W.partitionBy("ticker").orderBy(F.asc_nulls_last("date"))


def as_of(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each left row with the values of the last right row at or before its time (strictly before with `strict`).

    Both sides are one stream ordered by (keys, time); the last right value is carried on. No range join, one shuffle.
    """
    side = F.lit(1 if strict else 0)
    r = right.select(*on, F.col(right_time).alias("__t"), side.alias("__s"), F.lit(False).alias("__left"), F.struct(F.col(right_time).alias("__rt"), *values).alias("__v"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType).alias("__l"))
    l_ = left.select(*on, F.col(left_time).alias("__t"), F.lit(0 if strict else 1).alias("__s"), F.lit(True).alias("__left"), F.lit(None).cast(r.schema["__v"].dataType).alias("__v"), F.struct(*left.columns).alias("__l"))
    w = W.partitionBy(*on).orderBy("__t", "__s").rowsBetween(W.unboundedPreceding, 0)
    out = r.unionByName(l_).withColumn("__m", F.last("__v", ignorenulls=True).over(w)).where("__left")
    return out.select("__l.*", F.col("__m.__rt").alias(f"{right_time}_matched" if right_time in left.columns else right_time), *[F.col(f"__m.{v}").alias(v) for v in values])


def next_on_or_after(left: DataFrame, days: DataFrame, time: str, out: str, strict: bool = False) -> DataFrame:
    """The first calendar date at (or strictly after) a date; NULL after the last. Every date that a calendar date is the next one of is a row of
    a table as long as the calendar's span, which is joined by equality."""
    is_date = days.schema["date"].dataType.typeName() == "date"
    plus = lambda c, n: F.date_add(c, n) if is_date else F.col(c) + n
    steps = days.select("date").distinct().withColumn("__p", F.lag("date").over(W.orderBy("date"))).where("__p IS NOT NULL")  # a calendar: one small task
    of = F.sequence(F.col("__p"), plus("date", -1)) if strict else F.sequence(plus("__p", 1), F.col("date"))
    table = steps.select(F.explode(of).alias("__at"), F.col("date").alias("__next"))
    first = days.agg(F.min("date").alias("__first"))  # one row
    got = left.join(table, F.col(time) == F.col("__at"), "left").crossJoin(F.broadcast(first))
    early = F.col(time) < F.col("__first") if strict else F.col(time) <= F.col("__first")
    return got.select(*left.columns, F.when(early, F.col("__first")).otherwise(F.col("__next")).alias(out))
