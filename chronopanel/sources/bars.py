"""Bar adapters: any event table as (ticker, date, open, high, low, close, volume)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from .tables import parquet


def ohlc(df: DataFrame, ticker: Column, date: Column, price: Column, order: list[str], amount: Column | None = None, close: Column | None = None) -> DataFrame:
    """Bars of events. Opens and closes are told apart by `order`, so ties have one result; `close` is money in cents, summed and divided by `amount`. One partial aggregation, one shuffle."""
    # sums of whole cents are exact in any order; a row without a price is no open or close
    key = F.when(price.isNotNull(), F.struct(*order))
    rows = df.select(ticker.alias("ticker"), date.alias("date"), price.alias("__p"), key.alias("__o"), (amount if amount is not None else F.lit(1.0)).alias("__a"), (close if close is not None else F.lit(None).cast("double")).alias("__c"))
    last = rounded(F.sum("__c") / 100.0 / F.sum("__a"), 4) if close is not None else F.max_by("__p", "__o")
    return rows.groupBy("ticker", "date").agg(
        F.min_by("__p", "__o").alias("open"), F.max("__p").alias("high"), F.min("__p").alias("low"), last.alias("close"), F.sum("__a").alias("volume")
    )


def brand_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of part brands from line items: unit prices, volume-weighted close."""
    part = parquet(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    line = parquet(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    rows = line.join(part, line.l_partkey == part.p_partkey)
    unit = rounded(F.col("l_extendedprice") / F.col("l_quantity"), 4)
    return ohlc(rows, F.col("p_brand"), F.col("l_shipdate").cast("date"), unit, ["l_orderkey", "l_linenumber"], F.col("l_quantity"), F.floor(F.col("l_extendedprice") * 100.0 + 0.5).cast("double"))


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parquet(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    return ohlc(e, F.col("user_id").cast("string"), F.col("ts").cast("date"), F.col("value"), ["ts", "event_id"])


def type_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of event types; `date` is the number of the hour since 2024-01-01."""
    e = parquet(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    hour = (F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) * 24 + F.hour("ts")).cast("int")
    return ohlc(e, F.col("event_type"), hour, F.col("value"), ["ts", "event_id"])


_UNIT = "floor(l_extendedprice / l_quantity * CAST(10000 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) / CAST(10000 AS DOUBLE)"
#: The same adapters for the SQL of tests: CTEs named bars, ubars and hbars.
SQL_BRAND = f"""bars AS (
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date,
    min_by({_UNIT}, CAST(l_orderkey AS HUGEINT) * 100 + l_linenumber) AS open, max({_UNIT}) AS high, min({_UNIT}) AS low,
    floor(sum(floor(l_extendedprice * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE))) / CAST(100 AS DOUBLE) / sum(l_quantity) * CAST(10000 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) / CAST(10000 AS DOUBLE) AS close, sum(l_quantity) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
SQL_USER = """ubars AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""
SQL_HOUR = """hbars AS (
  SELECT event_type AS ticker, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS INTEGER) AS date,
    arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""
