"""What several registered queries use: the panels, members, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import HALF, rounded
from ..operators import grid, pit
from ..sources import bars as B
from ..sources.bars import SQL_BRAND, SQL_HOUR, SQL_USER

TOP = 10

SQL_GRID = """days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS day FROM (SELECT DISTINCT date FROM bars)),
grid AS (SELECT t.ticker, d.date, d.day, b.open, b.high, b.low, b.close, b.volume FROM (SELECT DISTINCT ticker FROM bars) t CROSS JOIN days d LEFT JOIN bars b ON b.ticker = t.ticker AND b.date = d.date)"""
SQL_UGRID = SQL_GRID.replace("FROM bars", "FROM ubars").replace("JOIN bars", "JOIN ubars")
SQL_HGRID = SQL_GRID.replace("FROM bars", "FROM hbars").replace("JOIN bars", "JOIN hbars")
SQL_SNAPS = f"""rev AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, ticker, floor(sum(volume * close) * CAST(100 AS DOUBLE) + CAST(0.5001 AS DOUBLE)) AS rev FROM bars GROUP BY 1, 2),
snaps AS (SELECT date, ticker FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY rev DESC, ticker) AS rn FROM rev) WHERE rn <= {TOP})"""
SQL_SPANS = """sd AS (SELECT date, row_number() OVER (ORDER BY date) AS n, lead(date) OVER (ORDER BY date) AS nxt FROM (SELECT DISTINCT date FROM snaps)),
isl AS (SELECT ticker, s.date, nxt, n - row_number() OVER (PARTITION BY ticker ORDER BY s.date) AS run FROM snaps s JOIN sd ON s.date = sd.date),
spans AS (SELECT ticker, min(date) AS start, arg_max_null(nxt, date) AS "end" FROM isl GROUP BY ticker, run)"""


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def r(x: str, digits: int = 6) -> str:
    k = 10**digits
    return f"floor(({x}) * CAST({k} AS DOUBLE) + CAST(0.5001 AS DOUBLE)) / CAST({k} AS DOUBLE)"


BRAND, GRID = (SQL_BRAND,), (SQL_BRAND, SQL_GRID)
UGRID, HGRID = (SQL_USER, SQL_UGRID), (SQL_HOUR, SQL_HGRID)
MEMBERS = (SQL_BRAND, SQL_SNAPS, SQL_SPANS)


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return B.brand_day(spark, sf)


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return grid.dense(B.brand_day(spark, sf))


def upanel(spark: SparkSession, sf: str) -> DataFrame:
    return grid.dense(B.user_day(spark, sf))


def hpanel(spark: SparkSession, sf: str) -> DataFrame:
    return grid.dense(B.type_hour(spark, sf))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Members on the first day of each month: the labels with the largest turnover in that month."""
    rev = B.brand_day(spark, sf).groupBy(F.trunc("date", "month").alias("date"), "ticker").agg(F.floor(F.sum(F.col("volume") * F.col("close")) * 100.0 + HALF).alias("rev"))
    w = W.partitionBy("date").orderBy(F.desc("rev"), "ticker")
    return rev.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= TOP).select("date", "ticker")


def spans(spark: SparkSession, sf: str) -> DataFrame:
    return pit.snapshots_to_intervals(snapshots(spark, sf))


def rounded_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded the same way on every engine."""
    return df.select(*[rounded(F.col(c), digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])
