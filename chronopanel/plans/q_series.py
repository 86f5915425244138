"""Registered queries for series construction, membership, audits, statistics and backtests (D, F, B, R, V)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..functions.numeric import rounded
from ..operators import adjust as A
from ..operators import cross_section as C
from ..operators import indicators, ledger, membership, pit, quality, reconcile, stats
from ..operators.grid import by_label, calendar
from ..sources import tables as S
from .. import strategies as ST
from .q_market import _MONTHS
from .shared import BRAND, GRID, MEMBERS, bars, panel, r, rounded_all, snapshots, spans, sql, upanel

QUERIES, SQL = {}, {}
L = "OVER (PARTITION BY ticker ORDER BY date)"


def query(name: str, text: str | None = None):
    def put(f):
        QUERIES[name] = f
        if text:
            SQL[name] = text
        return f

    return put


# Bars with corporate actions: distributions and splits by the volume of a day, a raw basis for some labels.
ACTS = """acts AS (SELECT *, CASE WHEN volume % 9 = 0 THEN volume * 10 ELSE 0 END AS dividends, CAST(CASE WHEN volume = 37 THEN 2 ELSE 0 END AS DOUBLE) AS stock_splits,
  CASE WHEN ticker < 'Brand#2' THEN 'tiingo' WHEN volume % 5 = 0 THEN 'yahoo-patch' ELSE 'yahoo' END AS source, ticker < 'Brand#2' AS raw FROM bars)"""
ADJ = f"""a1 AS (SELECT *, CASE WHEN raw AND stock_splits <> 0 THEN stock_splits ELSE 1 END AS split, lag(close) {L} AS before FROM acts),
a2 AS (SELECT *, coalesce(dividends > 0 AND dividends * split > CAST(0.2 AS DOUBLE) * before AND before - close * split < CAST(0.25 AS DOUBLE) * dividends * split, false) AS rejected FROM a1),
a3 AS (SELECT *, CASE WHEN dividends > 0 AND NOT rejected THEN close / (close + dividends) ELSE 1 END / CAST(split AS DOUBLE) AS factor FROM a2),
adj AS (SELECT *, close * coalesce(product(factor) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS adj_close FROM a3)"""


def acts(spark, sf):
    v = F.col("volume")
    return (
        bars(spark, sf).withColumn("dividends", F.when(v % 9 == 0, v * 10).otherwise(0.0)).withColumn("stock_splits", F.when(v == 37, 2.0).otherwise(0.0))
        .withColumn("source", F.when(F.col("ticker") < "Brand#2", "tiingo").when(v % 5 == 0, "yahoo-patch").otherwise("yahoo"))
    )


def adjusted(spark, sf):
    return A.back_adjust(A.basis(acts(spark, sf), ["tiingo", "wiki", "crsp"]))


@query("d01_back_adjust", sql(f"SELECT ticker, date, {r('factor')} AS factor, {r('adj_close / close * 1000', 4)} AS adj FROM adj", *BRAND, ACTS, ADJ))
def d01(spark, sf):
    return adjusted(spark, sf).select("ticker", "date", rounded("factor").alias("factor"), rounded(F.col("adj_close") / F.col("close") * 1000, 4).alias("adj"))


@query("d02_rejected_distributions", sql("SELECT ticker, date, dividends, before AS prev_close FROM adj WHERE rejected", *BRAND, ACTS, ADJ))
def d02(spark, sf):
    x = A.basis(acts(spark, sf), ["tiingo"])
    return A.back_adjust(x).withColumn("prev_close", F.lag("close").over(by_label())).where("rejected").select("ticker", "date", "dividends", "prev_close")


@query("d04_spinoff_factor", sql(f"SELECT x.ticker, x.date, {r('CASE WHEN s.spun IS NOT NULL AND x.before IS NOT NULL THEN x.close / (x.before * ((s.p1 + s.spun) / s.p0)) ELSE x.factor END')} AS factor FROM adj x LEFT JOIN s ON x.ticker = s.ticker AND x.date = s.date",
    *BRAND, ACTS, ADJ, "s AS (SELECT ticker, date, 100 AS p0, 80 AS p1, CAST(0.5 AS DOUBLE) * 30 AS spun FROM bars WHERE day(date) = 15 AND month(date) = 6)"))
def d04(spark, sf):
    b = bars(spark, sf).where("day(date) = 15 AND month(date) = 6")
    spins = b.select("ticker", F.col("date").alias("ex_date"), F.lit(100.0).alias("parent_prev_close"), F.lit(80.0).alias("parent_close"), F.lit(0.5).alias("ratio"), F.lit(30.0).alias("spinco_close"), F.lit(None).cast("double").alias("parent_shares"), F.lit(None).cast("double").alias("cash"))
    return A.spinoff_factors(adjusted(spark, sf), spins).select("ticker", "date", rounded("factor").alias("factor"))


@query("d05_rescale_dividends", sql("SELECT ticker, date, CASE WHEN ticker = 'Brand#3' AND date < DATE '1998-01-01' THEN dividends / 4 ELSE dividends END AS dividends FROM acts", *BRAND, ACTS))
def d05(spark, sf):
    rules = spark.createDataFrame([("Brand#3", dt.date(1998, 1, 1), 4.0)], "ticker string, before date, divide_by double")
    return A.rescale_dividends(acts(spark, sf), rules).select("ticker", "date", "dividends")


@query("d06_override_actions", sql("SELECT a.ticker, a.date, CASE WHEN o.ticker IS NOT NULL THEN CAST(3 AS DOUBLE) ELSE stock_splits END AS stock_splits, dividends FROM acts a LEFT JOIN (SELECT ticker, max(date) AS date FROM bars GROUP BY 1) o ON a.ticker = o.ticker AND a.date = o.date", *BRAND, ACTS))
def d06(spark, sf):
    rules = bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("date")).withColumn("split_factor", F.lit(3.0)).withColumn("dividend", F.lit(None).cast("double"))
    return A.override_actions(acts(spark, sf), rules).select("ticker", "date", "stock_splits", "dividends")


@query("d07_patch_prices", sql("""SELECT b.ticker, b.date, CASE WHEN p.new IS NOT NULL AND abs(p.new / close - 1) <= CAST(0.05 AS DOUBLE) THEN p.new ELSE close END AS close FROM bars b LEFT JOIN p ON p.ticker = b.ticker AND p.date = b.date AND p.kind = 'replace_close'
UNION ALL SELECT ticker, date, new FROM p WHERE kind = 'fill' AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = p.ticker AND b.date = p.date)""", *BRAND,
    "p AS (SELECT ticker, date, close * (1 + day(date) / CAST(200 AS DOUBLE)) AS new, 'replace_close' AS kind FROM bars WHERE month(date) = 3 UNION ALL SELECT ticker, date + 1, close, 'fill' FROM bars WHERE month(date) = 7)"))
def d07(spark, sf):
    b = bars(spark, sf).select("ticker", "date", "close").withColumn("source", F.lit("a"))
    p = b.where("month(date) = 3").select("ticker", "date", (F.col("close") * (1 + F.dayofmonth("date") / 200.0)).alias("close"), F.lit("replace_close").alias("action"))
    p = p.unionByName(b.where("month(date) = 7").select("ticker", F.date_add("date", 1).alias("date"), "close", F.lit("fill").alias("action"))).withColumn("max_move", F.lit(None).cast("double"))
    return A.patch_prices(b, p).select("ticker", "date", "close")


# Panels whose gaps are filled with flat bars: placeholders, filler tails, days without trade.
FLAT = """flat AS (SELECT ticker, date, coalesce(open, f) AS open, coalesce(high, f) AS high, coalesce(low, f) AS low, coalesce(close, f) AS close, coalesce(volume, 0) AS volume FROM (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM grid) WHERE f IS NOT NULL)"""


def flat(spark, sf):
    p = panel(spark, sf).withColumn("f", indicators.fill_forward("close")).where("f IS NOT NULL")
    return p.select("ticker", "date", *[F.coalesce(c, "f").alias(c) for c in ("open", "high", "low", "close")], F.coalesce("volume", F.lit(0.0)).alias("volume"))


@query("d08_placeholders", sql(f"SELECT f.ticker, f.date FROM (SELECT *, lag(close) {L} AS before, lead(date) {L} AS nxt FROM flat) f WHERE volume = 0 AND open = close AND high = close AND low = close AND close = before AND nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM spans s WHERE s.ticker = f.ticker AND abs(date_diff('day', s.\"end\", f.date)) <= 7)", *GRID, FLAT, *MEMBERS[1:]))
def d08(spark, sf):
    removed = spans(spark, sf).where("end IS NOT NULL").select("ticker", F.col("end").alias("removed"))
    return A.placeholders(flat(spark, sf), removed).select("ticker", "date")


@query("d09_trim_filler", sql("SELECT ticker, count(*) AS n, max(date) AS last FROM (SELECT *, max(CASE WHEN volume > 0 OR high <> low OR open <> close THEN date END) OVER (PARTITION BY ticker) AS real, max(date) OVER (PARTITION BY ticker) AS fin FROM flat) WHERE real IS NULL OR date_diff('day', real, fin) <= 3 OR date <= real GROUP BY 1", *GRID, FLAT))
def d09(spark, sf):
    return A.trim_filler(flat(spark, sf), 3).groupBy("ticker").agg(F.count("*").alias("n"), F.max("date").alias("last"))


OTHER = "other AS (SELECT ticker, date, floor(close * (2 + CASE WHEN ticker < 'Brand#15' THEN day(date) / CAST(50 AS DOUBLE) ELSE 0 END) * 10000 + CAST(0.5001 AS DOUBLE)) / CAST(10000 AS DOUBLE) AS close FROM bars WHERE date < DATE '1999-01-01'), own AS (SELECT ticker, date, close FROM bars WHERE date >= DATE '1997-06-01')"


def _two(spark, sf):
    b = bars(spark, sf).select("ticker", "date", "close")
    k = 2.0 + F.when(F.col("ticker") < "Brand#15", F.dayofmonth("date") / 50.0).otherwise(0.0)
    return b.where(F.col("date") >= dt.date(1997, 6, 1)), b.where(F.col("date") < dt.date(1999, 1, 1)).withColumn("close", rounded(F.col("close") * k, 4))


@query("d10_splice_check", sql(f"SELECT ticker, n AS days, {r('m')} AS ratio, {r('(b - a) / m')} AS spread, n >= 60 AND (b - a) / m <= CAST(0.005 AS DOUBLE) AS accepted FROM (SELECT x.ticker, count(*) AS n, median(x.close / y.close) AS m, quantile_cont(x.close / y.close, 0.05) AS a, quantile_cont(x.close / y.close, 0.95) AS b FROM own x JOIN other y ON x.ticker = y.ticker AND x.date = y.date GROUP BY 1)", *BRAND, OTHER))
def d10(spark, sf):
    return rounded_all(A.splice_check(*_two(spark, sf)))


@query("d10_splice", sql("SELECT ticker, count(*) AS n, min(date) AS first FROM (SELECT ticker, date FROM own UNION ALL SELECT o.ticker, o.date FROM other o WHERE o.date < (SELECT min(date) FROM own w WHERE w.ticker = o.ticker) AND o.ticker IN (SELECT x.ticker FROM own x JOIN other y ON x.ticker = y.ticker AND x.date = y.date GROUP BY 1 HAVING count(*) >= 60 AND (quantile_cont(x.close / y.close, 0.95) - quantile_cont(x.close / y.close, 0.05)) / median(x.close / y.close) <= CAST(0.005 AS DOUBLE))) GROUP BY 1", *BRAND, OTHER))
def d10b(spark, sf):
    return A.splice(*_two(spark, sf)).groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first"))


@query("d11_carve", sql("SELECT 'New#1' AS ticker, date, close * p AS close FROM (SELECT *, coalesce(product(CASE WHEN stock_splits = 0 THEN 1 ELSE stock_splits END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS p FROM acts) WHERE ticker = 'Brand#4' AND date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'", *BRAND, ACTS))
def d11(spark, sf):
    rules = spark.createDataFrame([("New#1", "Brand#4", dt.date(1999, 1, 1), dt.date(1999, 12, 31))], "label string, source_label string, first date, last date")
    x = acts(spark, sf).withColumn("stock_splits", F.when(F.col("stock_splits") == 0, 1.0).otherwise(F.col("stock_splits")))
    return A.carve(x, rules).select("ticker", "date", "close")


@query("d12_cut_series", sql("SELECT ticker, date FROM bars WHERE NOT (ticker = 'Brand#1' AND date < DATE '1997-01-01') AND NOT (ticker = 'Brand#2' AND date > DATE '2000-01-01')", *BRAND))
def d12(spark, sf):
    starts = spark.createDataFrame([("Brand#1", dt.date(1997, 1, 1))], "ticker string, first_day date")
    ends = spark.createDataFrame([("Brand#2", dt.date(2000, 1, 1))], "ticker string, last_day date")
    return A.cut_series(bars(spark, sf), starts, ends).select("ticker", "date")


@query("d13_no_trade_days", sql("SELECT ticker, date, CASE WHEN close IS NULL THEN 'missing' ELSE 'thin' END AS kind FROM grid WHERE close IS NULL OR volume < 5", *GRID))
def d13(spark, sf):
    p = panel(spark, sf)
    return p.where("close IS NULL").select("ticker", "date", F.lit("missing").alias("kind")).unionByName(p.where("volume < 5").select("ticker", "date", F.lit("thin").alias("kind")))


@query("d14_exit_gaps", sql(f"SELECT ticker, removed, ad AS last_trade, bd AS next_trade, CAST(date_diff('day', ad, bd) AS INTEGER) AS gap_days, {r('bc / ac - 1')} AS change FROM (SELECT s.ticker, s.\"end\" AS removed, max(date) FILTER (date < s.\"end\") AS ad, min(date) FILTER (date >= s.\"end\") AS bd, arg_max(close, date) FILTER (date < s.\"end\") AS ac, arg_min(close, date) FILTER (date >= s.\"end\") AS bc FROM spans s JOIN bars b ON b.ticker = s.ticker WHERE s.\"end\" IS NOT NULL GROUP BY 1, 2) WHERE date_diff('day', ad, bd) >= 2 AND abs(bc / ac - 1) > CAST(0.25 AS DOUBLE)", *MEMBERS))
def d14(spark, sf):
    ends = spans(spark, sf).where("end IS NOT NULL").select("ticker", F.col("end").alias("removed"))
    return rounded_all(A.exit_gaps(bars(spark, sf), ends, 2))


def _rule(spark, ticker, day):
    return spark.createDataFrame([(ticker, day)], "ticker string, day date")


@query("d15_edit_spans")
def d15(spark, sf):
    return membership.edit_spans(
        spans(spark, sf), hold_until=_rule(spark, "Brand#1", dt.date(2003, 1, 1)), end_early=_rule(spark, "Brand#2", dt.date(2001, 6, 1)), start_late=_rule(spark, "Brand#3", dt.date(1995, 5, 1)),
        start_early=_rule(spark, "Brand#4", dt.date(1994, 1, 1)), add=spark.createDataFrame([("Extra", dt.date(1996, 1, 1), dt.date(1997, 1, 1))], "ticker string, start date, end date"),
    )


@query("d16_relabel", sql("SELECT CASE WHEN ticker = 'Brand#5' AND date >= DATE '1997-01-01' AND date < DATE '1998-01-01' THEN 'Brand#5-199801' ELSE ticker END AS ticker, date FROM bars", *BRAND))
def d16(spark, sf):
    rules = spark.createDataFrame([("Brand#5", "Brand#5-199801", dt.date(1997, 1, 1), dt.date(1998, 1, 1))], "bare string, label string, start date, cutoff date")
    return membership.relabel(bars(spark, sf), rules).select("ticker", "date")


@query("d18_merge_spans", sql("""SELECT ticker, min(start) AS start, CASE WHEN max(e) < DATE '9999-12-31' THEN max(e) END AS "end" FROM (SELECT *, sum(CASE WHEN upto IS NULL OR date_diff('day', upto, start) > 62 THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY start) AS g FROM (SELECT ticker, start, coalesce("end", DATE '9999-12-31') AS e, max(coalesce("end", DATE '9999-12-31')) OVER (PARTITION BY ticker ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM spans)) GROUP BY ticker, g""", *MEMBERS))
def d18(spark, sf):
    return membership.merge_spans(spans(spark, sf), 62)


@query("d19_prepend_era")
def d19(spark, sf):
    s = spans(spark, sf)
    old = s.where("start < DATE '1996-01-01'").withColumn("start", F.add_months("start", -24))
    return membership.prepend(s, old, "1995-06-01")


@query("d22_actions_from_ratio", sql(f"SELECT ticker, date, {r('CASE WHEN pf / f < CAST(1 - 0.0001 AS DOUBLE) THEN pc * (1 - pf / f) ELSE 0 END', 3)} AS dividends FROM (SELECT *, lag(f) {L} AS pf, lag(close) {L} AS pc FROM (SELECT *, adj_close / close AS f FROM adj)) WHERE pf IS NOT NULL", *BRAND, ACTS, ADJ))
def d22(spark, sf):
    x = A.actions_from_ratio(adjusted(spark, sf)).withColumn("__p", F.lag("close").over(by_label())).where("__p IS NOT NULL")
    return x.select("ticker", "date", rounded("dividends", 3).alias("dividends"))


@query("d23_implied_distribution", sql(f"SELECT ticker, date, {r('lag(close) ' + L + ' * (1 + volume / CAST(1000 AS DOUBLE)) - close', 4)} AS implied FROM bars", *BRAND))
def d23(spark, sf):
    x = A.implied_distribution(bars(spark, sf).withColumn("ret", F.col("volume") / 1000.0))
    return x.select("ticker", "date", rounded("implied", 4).alias("implied"))


@query("d24_truncation_guard", sql("SELECT ticker, min(date) AS first, count(*) AS n FROM (SELECT ticker, date FROM bars WHERE date >= DATE '1996-01-01' OR ticker < 'Brand#2' UNION ALL SELECT ticker, date FROM bars WHERE date < DATE '1996-01-01' AND ticker >= 'Brand#2') GROUP BY 1", *BRAND))
def d24(spark, sf):
    b = bars(spark, sf)
    new = b.where((F.col("date") >= dt.date(1996, 1, 1)) | (F.col("ticker") < "Brand#2"))
    return A.truncation_guard(b, new).groupBy("ticker").agg(F.min("date").alias("first"), F.count("*").alias("n"))


_RA = f"ra AS (SELECT ticker, date, close / lag(close) {L} - 1 AS x FROM bars), rb AS (SELECT ticker, date, x + CASE WHEN day(date) % 6 = 0 THEN CAST(0.01 AS DOUBLE) ELSE 0 END AS y FROM ra)"


@query("d25_source_agreement", sql(f"SELECT ticker, count(*) AS days, {r('avg(CAST(abs(x - y) < CAST(0.005 AS DOUBLE) AS DOUBLE))')} AS share, {r('max(abs(x - y))')} AS largest FROM ra JOIN rb USING (ticker, date) WHERE x IS NOT NULL GROUP BY 1", *BRAND, _RA))
def d25(spark, sf):
    a = bars(spark, sf).withColumn("x", indicators.returns()).select("ticker", "date", "x")
    b = a.withColumn("x", F.col("x") + F.when(F.dayofmonth("date") % 6 == 0, 0.01).otherwise(0.0))
    return rounded_all(reconcile.agreement(a, b, "x", 0.005))


# Functions

@query("f03_normal_names", "SELECT s_suppkey, lower(regexp_replace(replace(s_name, '#', ' '), '\\s+', ' ', 'g')) AS name FROM supplier")
def f03(spark, sf):
    s = S.parquet(spark, sf, "supplier")
    return s.select("s_suppkey", X.normal_name(F.concat(F.lit("The "), F.col("s_name"), F.lit(" Corp."))).alias("name"))


@query("f05_label_suffix", "SELECT * FROM (VALUES ('ABC-200811', 'ABC', DATE '2008-11-01'), ('BRK-B', 'BRK-B', NULL)) t(raw, bare, month)")
def f05(spark, sf):
    return spark.createDataFrame([("ABC-200811",), ("brk.b",)], "raw string").select(X.label("raw").alias("raw")).select("raw", X.bare_label("raw").alias("bare"), X.label_month("raw").alias("month"))


@query("f06_calendar_keys", "SELECT o_orderkey, CAST(extract(isoyear FROM o_orderdate) * 100 + extract(week FROM o_orderdate) AS BIGINT) AS week, last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(extract(quarter FROM o_orderdate) AS BIGINT) AS quarter, CAST(isodow(o_orderdate) - 1 AS BIGINT) AS weekday FROM orders")
def f06(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return S.parquet(spark, sf, "orders").select("o_orderkey", C.PERIODS["weekly"](d).cast("long").alias("week"), F.last_day(d).alias("month_end"), F.quarter(d).cast("long").alias("quarter"), F.weekday(d).cast("long").alias("weekday"))


_RATIOS = ", ".join(f"({x!r})" for x in N.SPLIT_RATIOS)


@query("f11_nearest_ratio", f"WITH k(k) AS (VALUES {_RATIOS}) SELECT p_partkey, arg_min(CAST(k AS DOUBLE), (abs(p_size / CAST(11 AS DOUBLE) / CAST(k AS DOUBLE) - 1), CAST(k AS DOUBLE))) AS ratio FROM part, k GROUP BY 1")
def f11(spark, sf):
    return S.parquet(spark, sf, "part").select("p_partkey", N.nearest_ratio(F.col("p_size") / 11.0).alias("ratio"))


@query("f12_snap_cent", "SELECT o_orderkey, CASE WHEN abs(x - floor(x * 100 + CAST(0.5 AS DOUBLE)) / 100) < CAST(0.001 AS DOUBLE) THEN floor(x * 100 + CAST(0.5 AS DOUBLE)) / 100 ELSE x END AS x FROM (SELECT o_orderkey, o_totalprice / 7 AS x FROM orders)")
def f12(spark, sf):
    return S.parquet(spark, sf, "orders").select("o_orderkey", N.snap_cent(F.col("o_totalprice") / 7).alias("x"))


@query("f13_explode_list", sql("SELECT date, unnest(string_split(m, ',')) AS ticker FROM (SELECT date, string_agg(ticker, ',' ORDER BY ticker) AS m FROM snaps GROUP BY 1)", *MEMBERS[:2]))
def f13(spark, sf):
    m = snapshots(spark, sf).groupBy("date").agg(F.array_join(F.sort_array(F.collect_list("ticker")), ",").alias("m"))
    return m.select("date", F.explode(F.split("m", ",")).alias("ticker"))


@query("f14_rename_closure", "SELECT * FROM (VALUES ('A', 'D'), ('B', 'D'), ('C', 'D'), ('X', 'Y')) t(old, new)")
def f14(spark, sf):
    return membership.rename_closure(spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "D"), ("X", "Y"), ("Q", "Q")], "old string, new string"))


@query("f15_json_fields", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def f15(spark, sf):
    return S.parquet(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("v29_sentences", "SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(replace(replace(replace(text, '. ', '.' || chr(1)), '! ', '!' || chr(1)), '? ', '?' || chr(1)), chr(1))) AS s FROM documents) WHERE trim(s, ' ') <> '' AND s LIKE '%License%' GROUP BY 1")
def v29(spark, sf):
    d = S.parquet(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", F.explode(X.sentences("text")).alias("s")).where("s LIKE '%License%'").groupBy("doc_id").agg(F.count("*").alias("n"))


# Backtests

_ELIG = f"g AS (SELECT *, count(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS history, median(close * volume) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS d0, count(close * volume) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS dn FROM grid)"


@query("b01_eligible", sql("SELECT ticker, date FROM g WHERE close IS NOT NULL AND history >= 100 AND dn >= 5 AND d0 >= 50000", *GRID, _ELIG))
def b01(spark, sf):
    p = panel(spark, sf).withColumn("history", indicators.days_of_history()).withColumn("dollars", indicators.dollar_volume(20))
    return C.eligible(p, 100, 50000.0).select("ticker", "date")


@query("b02_rebalance_days", sql("SELECT 'weekly' AS schedule, max(date) AS date FROM days GROUP BY extract(isoyear FROM date) * 100 + extract(week FROM date) UNION ALL SELECT 'monthly', min(date) FROM days GROUP BY date_trunc('month', date) UNION ALL SELECT 'quarterly', max(date) FROM days GROUP BY date_trunc('quarter', date) UNION ALL SELECT 'annual', max(date) FROM days GROUP BY year(date)", *GRID))
def b02(spark, sf):
    days = calendar(bars(spark, sf))
    out = None
    for s, w in (("weekly", "end"), ("monthly", "start"), ("quarterly", "end"), ("annual", "end")):
        one = C.rebalance_days(days, s, w).select(F.lit(s).alias("schedule"), "date")
        out = one if out is None else out.unionByName(one)
    return out


_ME = "me AS (SELECT max(date) AS date FROM days GROUP BY date_trunc('month', date))"


@query("b03_momentum_picks", sql(f"SELECT date, ticker, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY date) AS weight FROM (SELECT * FROM (SELECT ticker, date, {r(f'close / lag(close, 60) {L} - 1')} AS s FROM grid) WHERE date IN (SELECT date FROM me) AND s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY date ORDER BY s DESC, ticker) <= 5)", *GRID, _ME))
def b03(spark, sf):
    p = panel(spark, sf).select("ticker", "date", rounded(indicators.returns(60)).alias("s"))
    days = C.rebalance_days(calendar(bars(spark, sf)))
    picks = C.top(p.join(days, "date"), "s", 5)
    return picks.select("date", "ticker", C.equal_weight().alias("weight"))


@query("b05_inverse_vol_weights", sql(f"SELECT date, ticker, {r('coalesce(inv, m) / sum(coalesce(inv, m)) OVER (PARTITION BY date)')} AS weight FROM (SELECT *, median(inv) OVER (PARTITION BY date) AS m FROM (SELECT ticker, date, CAST(1 AS DOUBLE) / nullif(stddev_samp(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 0) AS inv FROM grid) WHERE date IN (SELECT date FROM me))", *GRID, _ME))
def b05(spark, sf):
    p = panel(spark, sf).withColumn("vol", F.stddev_samp("close").over(by_label().rowsBetween(-9, 0)))
    p = p.join(C.rebalance_days(calendar(bars(spark, sf))), "date")
    return p.select("date", "ticker", rounded(C.inverse_vol_weight("vol")).alias("weight"))


TREND = sql(
    f"""SELECT month, CAST(count(*) FILTER (held) AS BIGINT) AS held, {r('sum(CASE WHEN held THEN coalesce(nxt / close - 1, 0) ELSE 0 END) / 10')} AS ret FROM t WHERE month < (SELECT max(month) FROM t) GROUP BY 1""",
    *BRAND, _MONTHS, *MEMBERS[1:],
    """t AS (SELECT m.ticker, m.month, m.close, lead(m.close) OVER (PARTITION BY m.ticker ORDER BY m.month) AS nxt,
  coalesce(m.close > CASE WHEN count(m.close) OVER w >= 10 THEN avg(m.close) OVER w END, false) AND s.ticker IS NOT NULL AS held
  FROM months m LEFT JOIN spans s ON s.ticker = m.ticker AND s.start <= m.month AND (s."end" IS NULL OR s."end" > m.month) WINDOW w AS (PARTITION BY m.ticker ORDER BY m.month ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))""",
)


@query("monthly_trend_backtest", TREND)
def trend(spark, sf):
    """Members above their 10-month average each get a tenth; next month's return, a missing next price counts as none."""
    w = W.partitionBy("ticker").orderBy("month")
    ten = w.rowsBetween(-9, 0)
    m = C.month_end(bars(spark, sf), "close").withColumn("nxt", F.lead("close").over(w))
    m = m.withColumn("up", F.coalesce(F.col("close") > F.when(F.count("close").over(ten) >= 10, F.avg("close").over(ten)), F.lit(False)))
    member = pit.members_on(m.select("ticker", "month"), spans(spark, sf), date="month").distinct().withColumn("in", F.lit(True))
    t = m.join(member, ["ticker", "month"], "left").withColumn("held", F.col("up") & F.coalesce("in", F.lit(False)))
    end = t.agg(F.max("month").alias("__end"))
    gain = F.when(F.col("held"), F.coalesce(N.ratio("nxt", "close") - 1.0, F.lit(0.0))).otherwise(0.0)
    return t.crossJoin(F.broadcast(end)).where(F.col("month") < F.col("__end")).groupBy("month").agg(F.count_if("held").alias("held"), rounded(F.sum(gain) / 10).alias("ret"))


QUERIES["b18_monthly_trend"], SQL["b18_monthly_trend"] = trend, TREND


@query("b19_crisis_returns", sql(f"SELECT c.name, {r('product(1 + ret) - 1')} AS total FROM (SELECT month, {r('avg(g)')} AS ret FROM (SELECT month, (close / lag(close) OVER (PARTITION BY ticker ORDER BY month) - 1) / 10 AS g FROM months) WHERE g IS NOT NULL GROUP BY 1) JOIN (VALUES ('a', DATE '1997-01-01', DATE '1997-12-31'), ('b', DATE '1999-06-01', DATE '2000-06-30')) c(name, s, e) ON month BETWEEN s AND e GROUP BY 1", *BRAND, _MONTHS))
def b19(spark, sf):
    w = W.partitionBy("ticker").orderBy("month")
    m = C.month_end(bars(spark, sf), "close").withColumn("g", (N.ratio("close", F.lag("close").over(w)) - 1.0) / 10).where("g IS NOT NULL")
    ret = m.groupBy("month").agg(rounded(F.avg("g")).alias("ret"))
    windows = spark.createDataFrame([("a", dt.date(1997, 1, 1), dt.date(1997, 12, 31)), ("b", dt.date(1999, 6, 1), dt.date(2000, 6, 30))], "name string, s date, e date")
    return ret.join(windows, F.col("month").between(F.col("s"), F.col("e"))).groupBy("name").agg(rounded(F.product(1 + F.col("ret")) - 1).alias("total"))


@query("b21_coverage", sql(f"SELECT CAST(date_trunc('month', due.date) AS DATE) AS period, count(*) AS due, count(b.close) AS have, {r('CAST(count(b.close) AS DOUBLE) / count(*)')} AS share FROM (SELECT DISTINCT s.ticker, d.date FROM (SELECT DISTINCT date FROM bars) d JOIN spans s ON s.start <= d.date AND (s.\"end\" IS NULL OR s.\"end\" > d.date)) due LEFT JOIN bars b ON b.ticker = due.ticker AND b.date = due.date GROUP BY 1", *MEMBERS))
def b21(spark, sf):
    return rounded_all(quality.coverage(bars(spark, sf), spans(spark, sf)))


def _runs(spark, sf):
    p = panel(spark, sf).withColumn("close", indicators.fill_forward("close")).select("ticker", "date", "close", "volume")
    inside = pit.members_on(p.select("ticker", "date"), spans(spark, sf)).withColumn("member", F.lit(True))
    return p.join(inside, ["ticker", "date"], "left").withColumn("member", F.coalesce("member", F.lit(False)))


def _book() -> dict:
    short = {"windows": (60, 30, 15, 5)}
    return {
        "momentum": ST.Momentum(n=5, **short), "stops": ST.TrailingStops(n=5, gauge="Brand#1", average=20, **short), "golden": ST.GoldenCross(n=5, short=5, long=20, **short),
        "rotation": ST.Rotation(window=20, haven="Brand#9", universe=["Brand#1", "Brand#2", "Brand#3", "Brand#9"]), "lowvol": ST.LowVolatility(n=5, window=10, min_history=30),
        "reversion": ST.Reversion(average=20), "switch": ST.Switch(label="Brand#1", average=20, universe=["Brand#1"]), "six": ST.SixMonths(n=5, window=30, average=20),
    }


@query("b24_strategies")
def b24(spark, sf):
    """Events of all bundled strategies on the panel of users (their values as prices)."""
    p = upanel(spark, sf).select("ticker", "date", "open", "close", "volume")
    names = {f"Brand#{k}": str(k) for k in range(10)}
    runs = {}
    for name, s in _book().items():
        for k, v in list(vars(s).items()):
            if isinstance(v, str) and v in names:
                setattr(s, k, names[v])
            if isinstance(v, list):
                s.universe = [names.get(x, x) for x in v]
        for k, v in {"windows": (10, 6, 4, 2), "average": 5, "window": 5, "short": 3, "long": 6, "min_history": 6}.items():
            if hasattr(s, k):
                setattr(s, k, v)
        s.schedule = "weekly" if s.schedule in ("monthly", "quarterly") else s.schedule
        runs[name] = s
    return rounded_all(ledger.simulate(p, runs), 4)


@query("b17_sweep")
def b17(spark, sf):
    """Momentum with several numbers of holdings, side by side: statistics of each run."""
    runs = ledger.sweep(lambda: ST.Momentum(windows=(60, 30, 15, 5), start="1996-01-01"), "n", [3, 5, 8])
    return rounded_all(stats.series_stats(ledger.equity(ledger.simulate(_runs(spark, sf), runs))))


# Statistics

EQ = f"eq AS (SELECT ticker AS run, date, 1000 + sum(floor((close - open) / 50)) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 100 * row_number() OVER (PARTITION BY ticker ORDER BY date) AS value FROM bars)"


def equity_like(spark, sf):
    w = by_label().rowsBetween(W.unboundedPreceding, 0)
    return bars(spark, sf).select(F.col("ticker").alias("run"), "date", (1000 + F.sum(F.floor((F.col("close") - F.col("open")) / 50)).over(w) + 100 * F.row_number().over(by_label())).cast("double").alias("value"))


_ST = """e1 AS (SELECT *, value / lag(value) OVER (PARTITION BY run ORDER BY date) - 1 AS ret, max(value) OVER (PARTITION BY run ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high FROM eq),
e2 AS (SELECT *, value / high - 1 AS dd, max(CASE WHEN value = high THEN date END) OVER (PARTITION BY run ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM e1),
s AS (SELECT run, min(date) AS start, max(date) AS fin, count(*) AS days, arg_min(value, date) AS first, arg_max(value, date) AS last, stddev_samp(ret) AS dev, avg(ret) AS mean, stddev_samp(CASE WHEN ret < 0 THEN ret END) AS down, min(dd) AS max_dd, arg_min(date, (dd, date)) AS trough, arg_min(peak, (dd, date)) AS peak, arg_min(high, (dd, date)) AS h FROM e2 GROUP BY run),
rec AS (SELECT s.run, min(e2.date) AS recovered FROM s JOIN e2 ON e2.run = s.run AND e2.date > s.trough AND e2.value >= s.h GROUP BY 1)"""


@query("r01_series_stats", sql(f"""SELECT s.run, start, fin AS "end", days, {r('last / first - 1')} AS total, {r("pow(last / first, 1 / (date_diff('day', start, fin) / CAST(365.25 AS DOUBLE))) - 1")} AS cagr, {r('dev * sqrt(CAST(252 AS DOUBLE))')} AS vol,
{r('mean * 252 / (dev * sqrt(CAST(252 AS DOUBLE)))')} AS sharpe, {r('mean * 252 / (down * sqrt(CAST(252 AS DOUBLE)))')} AS sortino, {r('max_dd')} AS max_dd, peak, trough, recovered, {r("(pow(last / first, 1 / (date_diff('day', start, fin) / CAST(365.25 AS DOUBLE))) - 1) / nullif(abs(max_dd), 0)")} AS calmar FROM s LEFT JOIN rec USING (run)""", *BRAND, EQ, _ST))
def r01(spark, sf):
    return rounded_all(stats.series_stats(equity_like(spark, sf)))


@query("r05_yearly_returns", sql(f"SELECT run, period, {r('last / coalesce(lag(last) OVER (PARTITION BY run ORDER BY period), first) - 1')} AS ret FROM (SELECT run, CAST(date_trunc('year', date) AS DATE) AS period, arg_min(value, date) AS first, arg_max(value, date) AS last FROM eq GROUP BY 1, 2)", *BRAND, EQ))
def r05(spark, sf):
    return rounded_all(stats.period_returns(equity_like(spark, sf), "year"))


@query("r06_monthly_share", sql(f"SELECT run, {r('avg(CAST(ret > 0 AS DOUBLE))')} AS positive, {r('max(ret)')} AS best, {r('min(ret)')} AS worst FROM (SELECT run, last / coalesce(lag(last) OVER (PARTITION BY run ORDER BY period), first) - 1 AS ret FROM (SELECT run, date_trunc('month', date) AS period, arg_min(value, date) AS first, arg_max(value, date) AS last FROM eq GROUP BY 1, 2)) GROUP BY 1", *BRAND, EQ))
def r06(spark, sf):
    m = stats.period_returns(equity_like(spark, sf), "month")
    return rounded_all(m.groupBy("run").agg(F.avg((F.col("ret") > 0).cast("double")).alias("positive"), F.max("ret").alias("best"), F.min("ret").alias("worst")))


_J = """j AS (SELECT e.run, e.date, e.value / lag(e.value) OVER w - 1 AS r, b.value / lag(b.value) OVER w - 1 AS b FROM eq e JOIN (SELECT date, value FROM eq WHERE run = 'Brand#1') b ON b.date = e.date WINDOW w AS (PARTITION BY e.run ORDER BY e.date))"""


@query("r07_relative_stats", sql(f"SELECT run, count(*) AS n, {r('covar_samp(r, b) / var_samp(b)')} AS beta, {r('(avg(r) - covar_samp(r, b) / var_samp(b) * avg(b)) * 252')} AS alpha, {r('corr(r, b)')} AS corr, {r('stddev_samp(r - b) * sqrt(CAST(252 AS DOUBLE))')} AS tracking_error, {r('avg(r - b) * 252 / nullif(stddev_samp(r - b) * sqrt(CAST(252 AS DOUBLE)), 0)')} AS information_ratio FROM j WHERE r IS NOT NULL AND b IS NOT NULL GROUP BY 1 HAVING count(*) > 10", *BRAND, EQ, _J))
def r07(spark, sf):
    e = equity_like(spark, sf)
    return rounded_all(stats.relative_stats(e, e.where("run = 'Brand#1'").select("date", F.col("value").alias("bench"))))


@query("r09_round_trips")
def r09(spark, sf):
    o = S.parquet(spark, sf, "orders")
    t = o.select(F.lit("all").alias("run"), F.concat(F.lit("c"), (F.col("o_custkey") % 20).cast("string")).alias("ticker"), F.col("o_orderdate").cast("date").alias("date"), F.when(F.col("o_orderkey") % 3 == 0, "SELL").otherwise("BUY").alias("side"), (F.col("o_orderkey") % 7 + 1).cast("double").alias("shares"), (F.col("o_totalprice") / 1000).alias("price"), F.lit(1.0).alias("cost"), F.col("o_orderkey").alias("seq"))
    return rounded_all(stats.round_trips(t), 4)


@query("r10_trip_stats")
def r10(spark, sf):
    return rounded_all(stats.trip_stats(r09(spark, sf)), 4)


# Verification

@query("v03_dividend_basis", sql(f"SELECT ticker, count(*) AS n, {r('avg(CAST(abs(d * 10000 - floor(d * 10000 + CAST(0.5 AS DOUBLE))) < CAST(0.01 AS DOUBLE) AS DOUBLE))')} AS as_is, {r('avg(CAST(abs(d * p * 10000 - floor(d * p * 10000 + CAST(0.5 AS DOUBLE))) < CAST(0.01 AS DOUBLE) AS DOUBLE))')} AS unsplit FROM (SELECT *, dividends / 3 AS d, coalesce(product(CASE WHEN stock_splits = 0 THEN 1 ELSE 3 END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS p FROM acts) WHERE dividends > 0 AND date > DATE '2000-06-01' GROUP BY 1 HAVING count(*) >= 4", *BRAND, ACTS))
def v03(spark, sf):
    x = acts(spark, sf).withColumn("stock_splits", F.when(F.col("stock_splits") == 0, 1.0).otherwise(3.0)).withColumn("dividends", F.col("dividends") / 3).where(F.col("date") > dt.date(2000, 6, 1))
    return rounded_all(quality.dividend_basis(x))


@query("v04_reconcile_adjustment", sql(f"SELECT ticker, {r('max(abs(h - a))')} AS worst_day, count(*) AS days FROM (SELECT ticker, (close * split + CASE WHEN rejected THEN 0 ELSE dividends END) / lag(close) {L} AS h, adj_close / lag(adj_close) {L} AS a FROM adj) WHERE h IS NOT NULL AND a IS NOT NULL GROUP BY 1", *BRAND, ACTS, ADJ))
def v04(spark, sf):
    split = F.when(F.col("raw") & (F.col("stock_splits") != 0), F.col("stock_splits")).otherwise(1.0)
    x = adjusted(spark, sf).withColumn("stock_splits", split).withColumn("dividends", F.when(F.col("rejected"), 0.0).otherwise(F.col("dividends")))
    return rounded_all(quality.reconcile_adjustment(x).select("ticker", "worst_day", "days"))


@query("v06_structure", sql("""SELECT check_ AS "check", failures, CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT 'duplicates' AS check_, CAST(0 AS BIGINT) AS failures UNION ALL SELECT 'weekend', count(*) FROM bars WHERE isodow(date) >= 6 UNION ALL SELECT 'not_positive', count(*) FROM bars WHERE least(open, high, low, close) <= 0
UNION ALL SELECT 'ohlc', count(*) FROM bars WHERE high < greatest(open, close, low) OR low > least(open, close, high) UNION ALL SELECT 'no_close', count(*) FROM bars WHERE close IS NULL)""", *BRAND))
def v06(spark, sf):
    return quality.structure(bars(spark, sf))


@query("v07_freshness", sql("SELECT ticker, max(date) AS last, CAST(date_diff('day', max(date), (SELECT max(date) FROM bars)) AS INTEGER) AS age FROM bars GROUP BY 1 HAVING date_diff('day', max(date), (SELECT max(date) FROM bars)) > 2", *BRAND))
def v07(spark, sf):
    return quality.freshness(bars(spark, sf), 2)


@query("v08_member_counts", sql(f"SELECT d.date, count(DISTINCT s.ticker) AS n, count(DISTINCT s.ticker) BETWEEN 10 AND 10 AS ok FROM (SELECT DISTINCT date FROM bars) d LEFT JOIN spans s ON d.date >= s.start AND (s.\"end\" IS NULL OR d.date < s.\"end\") GROUP BY 1", *MEMBERS))
def v08(spark, sf):
    return quality.member_counts(spans(spark, sf), bars(spark, sf), 10, 10)


@query("v09_recycled", sql("SELECT s.ticker, max(\"end\") AS \"left\", min(b.date) AS px_start FROM spans s JOIN (SELECT ticker, date FROM bars WHERE date >= DATE '2001-06-01') b ON b.ticker = s.ticker GROUP BY 1 HAVING max(\"end\") IS NOT NULL AND NOT bool_or(\"end\" IS NULL) AND min(b.date) > max(\"end\")", *MEMBERS))
def v09(spark, sf):
    return quality.recycled(bars(spark, sf).where(F.col("date") >= dt.date(2001, 6, 1)), spans(spark, sf))


@query("v14_audit")
def v14(spark, sf):
    """Payments of two sources: amounts, shifted dates, missing and extra ones."""
    a = acts(spark, sf).where("dividends > 0").select("ticker", "date", F.col("dividends").alias("amount"))
    b = a.where("day(date) <> 7").withColumn("date", F.when(F.dayofmonth("date") == 9, F.date_add("date", 1)).otherwise(F.col("date"))).withColumn("amount", F.when(F.dayofmonth("date") == 11, F.col("amount") + 5).otherwise(F.col("amount")))
    return reconcile.audit(a, b, 3, 0.01)


@query("v18_index_rebuild", sql(f"SELECT m.date, {r('rebuilt')} AS rebuilt, n, {r('published')} AS published FROM (SELECT x.date, avg(ret) AS rebuilt, count(*) AS n FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS ret FROM bars) x WHERE ret IS NOT NULL AND EXISTS (SELECT 1 FROM spans s WHERE s.ticker = x.ticker AND s.start <= x.date AND (s.\"end\" IS NULL OR s.\"end\" > x.date)) GROUP BY 1) m JOIN (SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS published FROM (SELECT date, close AS level FROM bars WHERE ticker = 'Brand#1')) p ON p.date = m.date", *MEMBERS))
def v18(spark, sf):
    b = bars(spark, sf)
    return rounded_all(quality.index_rebuild(b, spans(spark, sf), b.where("ticker = 'Brand#1'").select("date", F.col("close").alias("level"))))


@query("v19_regression", sql(f"SELECT ticker, {r('sum(x * e) / sum(x * x)')} AS slope, {r('(sum(x*e)/sum(x*x)) / sqrt((sum(e*e) - (sum(x*e)/sum(x*x)) * sum(x*e)) / ((count(*) - 1) * sum(x*x)))')} AS t FROM (SELECT ticker, volume - 40 AS x, close - 2000 AS e FROM bars) GROUP BY 1", *BRAND))
def v19(spark, sf):
    b = bars(spark, sf).select("ticker", (F.col("volume") - 40).alias("x"), (F.col("close") - 2000).alias("e"))
    return rounded_all(stats.slope_no_intercept(b, "ticker", "x", "e").select("ticker", "slope", "t"))


@query("v23_big_moves", sql(f"SELECT ticker, date, {r('m')} AS move FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS m FROM bars) x WHERE abs(m) > CAST(0.5 AS DOUBLE) AND EXISTS (SELECT 1 FROM spans s WHERE s.ticker = x.ticker AND s.start <= x.date AND (s.\"end\" IS NULL OR s.\"end\" > x.date))", *MEMBERS))
def v23(spark, sf):
    return rounded_all(quality.big_moves(bars(spark, sf), spans(spark, sf), 0.5))


@query("v23_volume_spikes", sql(f"SELECT e.ticker, e.event, median(volume) FILTER (date_diff('day', event, date) BETWEEN -60 AND -14) AS usual, arg_max(volume, (volume, date)) FILTER (date_diff('day', event, date) BETWEEN -12 AND 6) AS peak, arg_max(date, (volume, date)) FILTER (date_diff('day', event, date) BETWEEN -12 AND 6) AS at, {r('arg_max(volume, (volume, date)) FILTER (date_diff(chr(100)||chr(97)||chr(121), event, date) BETWEEN -12 AND 6) / median(volume) FILTER (date_diff(chr(100)||chr(97)||chr(121), event, date) BETWEEN -60 AND -14)')} AS times FROM (SELECT ticker, \"end\" AS event FROM spans WHERE \"end\" IS NOT NULL) e JOIN bars b ON b.ticker = e.ticker AND date_diff('day', event, date) BETWEEN -60 AND 6 GROUP BY 1, 2", *MEMBERS))
def v23b(spark, sf):
    ev = spans(spark, sf).where("end IS NOT NULL").select("ticker", F.col("end").alias("event"))
    return rounded_all(quality.volume_spikes(bars(spark, sf), ev))


@query("w31_payment_gaps", sql("SELECT ticker, date, gap, usual, gap > CAST(1.6 AS DOUBLE) * usual AS skipped FROM (SELECT *, median(gap) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS usual FROM (SELECT ticker, date, CAST(date_diff('day', lag(date) OVER (PARTITION BY ticker ORDER BY date), date) AS DOUBLE) AS gap FROM acts WHERE dividends > 0))", *BRAND, ACTS))
def w31(spark, sf):
    return quality.payment_gaps(acts(spark, sf).where("dividends > 0").select("ticker", "date"))


@query("w29_split_segments", sql(f"SELECT ticker, date, CAST(sum(CASE WHEN stock_splits <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM acts", *BRAND, ACTS))
def w29(spark, sf):
    w = by_label().rowsBetween(W.unboundedPreceding, 0)
    return acts(spark, sf).select("ticker", "date", F.sum((F.col("stock_splits") != 0).cast("long")).over(w).alias("segment"))


