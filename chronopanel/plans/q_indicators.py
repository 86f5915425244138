"""Registered indicator queries (W01-W39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import rounded
from ..operators import indicators as I
from ..operators.grid import by_label
from .shared import BRAND, GRID, HGRID, UGRID, bars, hpanel, panel, r, rounded_all, sql, upanel

W_ = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {a} PRECEDING AND CURRENT ROW)"
L_ = "OVER (PARTITION BY ticker ORDER BY date)"
ALL_ = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _w(n: int) -> str:
    return W_.format(a=n - 1)


def _guard(value: str, x: str, n: int, least: int) -> str:
    return f"CASE WHEN count({x}) {_w(n)} >= {least} THEN {value} END"


QUERIES, SQL = {}, {}


def _one(name: str, build, text: str, ctes=GRID, source=panel, pre=None, extra: str = "") -> None:
    """An indicator on a panel: (ticker, date, value)."""

    def run(spark, sf):
        p = source(spark, sf)
        p = pre(p) if pre else p
        return p.select("ticker", "date", rounded(build()).alias("value"))

    QUERIES[name] = run
    SQL[name] = sql(f"SELECT ticker, date, {r(text)} AS value FROM {extra or 'grid'}", *ctes)


_one("w01_returns_5", lambda: I.returns(5), f"close / lag(close, 5) {L_} - 1")
_one("w02_momentum_60_5", lambda: I.momentum(60, 5), f"lag(close, 5) {L_} / lag(close, 60) {L_} - 1")
_one("w03_daily_returns", I.daily_returns, f"close / lag(close) {L_} - 1")
_one("w04_sma_10", lambda: I.sma(10), _guard(f"avg(close) {_w(10)}", "close", 10, 10), UGRID, upanel)
_one("w04_sma_48_hourly", lambda: I.sma(48), _guard(f"avg(close) {_w(48)}", "close", 48, 48), HGRID, hpanel)
_one("w06_price_to_sma_5", lambda: I.price_to_sma(5), f"close / {_guard(f'avg(close) {_w(5)}', 'close', 5, 5)} - 1", UGRID, upanel)
_one("w07_rolling_high_252", lambda: I.rolling_high(252), _guard(f"max(close) {_w(252)}", "close", 252, 63))
_one("w08_rolling_low_252", lambda: I.rolling_low(252), _guard(f"min(close) {_w(252)}", "close", 252, 63))
_one("w09_pct_of_high_126", lambda: I.pct_of_high(126), f"close / {_guard(f'max(close) {_w(126)}', 'close', 126, 31)}")
_one("w10_drawdown", I.drawdown, f"close / max(close) {ALL_} - 1")
_RET = f"(SELECT *, close / lag(close) {L_} - 1 AS ret FROM grid)"
_one("w11_volatility_10", lambda: I.volatility(10), f"{_guard(f'stddev_samp(ret) {_w(10)}', 'ret', 10, 10)} * sqrt(CAST(252 AS DOUBLE))", UGRID, upanel, I.with_returns, _RET)
_TR = f"(SELECT *, greatest(high - low, abs(high - lag(close) {L_}), abs(low - lag(close) {L_})) AS tr FROM grid)"
_one("w12_atr_7", lambda: I.atr(7), _guard(f"avg(tr) {_w(7)}", "tr", 7, 7), UGRID, upanel, I.with_true_range, _TR)
_one("w13_dollar_volume_20", lambda: I.dollar_volume(20), _guard(f"median(close * volume) {_w(20)}", "close * volume", 20, 5))
_one("w16_zscore_10", lambda: I.zscore(10), _guard(f"(close - avg(close) {_w(10)}) / nullif(stddev_samp(close) {_w(10)}, 0)", "close", 10, 10), UGRID, upanel)
_one(
    "w17_bollinger_pct_10", lambda: I.bollinger_pct(10, 2.0),
    _guard(f"(close - (avg(close) {_w(10)} - 2 * stddev_samp(close) {_w(10)})) / nullif(4 * stddev_samp(close) {_w(10)}, 0)", "close", 10, 10), UGRID, upanel,
)
_C9 = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)"
_one("w27_centred_median_9", lambda: I.centred_median(9, 3, "close"), f"CASE WHEN count(close) {_C9} >= 3 THEN median(close) {_C9} END")
_C21 = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)"
_one("w28_centred_median_21", lambda: I.centred_median(21, 5, "close"), f"CASE WHEN count(close) {_C21} >= 5 THEN median(close) {_C21} END")
_one("w39_fill_forward", lambda: I.fill_forward("close"), f"last_value(close IGNORE NULLS) {ALL_}")


def w18_days_of_history(spark, sf):
    return panel(spark, sf).select("ticker", "date", I.days_of_history().alias("n"))


QUERIES["w18_days_of_history"] = w18_days_of_history
SQL["w18_days_of_history"] = sql(f"SELECT ticker, date, count(close) {ALL_} AS n FROM grid", *GRID)

# Exponential means. One step a non-NULL value; NULL rows carry the mean on.


def _ewm_sql(x: str, alpha: str, rel: str, out: str) -> str:
    """CTEs: {out}(ticker, date, y), the recurrence of x in rel (ticker, date, rn, x) over all its rows."""
    return f"""{out}_n AS (SELECT ticker, rn, {x} AS x, row_number() OVER (PARTITION BY ticker ORDER BY rn) AS k, rn - lag(rn) OVER (PARTITION BY ticker ORDER BY rn) AS g FROM {rel} WHERE ({x}) IS NOT NULL),
{out}_r AS (SELECT ticker, k, rn, CAST(x AS DOUBLE) AS y FROM {out}_n WHERE k = 1 UNION ALL
  SELECT n.ticker, n.k, n.rn, (power(1 - {alpha}, n.g) * p.y + {alpha} * n.x) / (power(1 - {alpha}, n.g) + {alpha}) FROM {out}_r p JOIN {out}_n n ON n.ticker = p.ticker AND n.k = p.k + 1),
{out} AS (SELECT b.ticker, b.date, b.rn, last_value(e.y IGNORE NULLS) OVER w AS y, count(({x})) OVER w AS n FROM {rel} b LEFT JOIN {out}_r e ON e.ticker = b.ticker AND e.rn = b.rn WINDOW w AS (PARTITION BY b.ticker ORDER BY b.rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _rec(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def _a(n: int) -> str:
    return f"(CAST(2 AS DOUBLE) / {n + 1})"


_BASE = "base AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM grid)"


def w05_ema_10(spark, sf):
    return rounded_all(I.recursive(upanel(spark, sf).select("ticker", "date", "close"), value=("ema", 10)).select("ticker", "date", "value"))


QUERIES["w05_ema_10"] = QUERIES["w20_ewm_gaps"] = w05_ema_10
SQL["w05_ema_10"] = SQL["w20_ewm_gaps"] = _rec(f"SELECT ticker, date, {r('CASE WHEN n >= 10 THEN y END')} AS value FROM e", *UGRID, _BASE, _ewm_sql("close", _a(10), "base", "e"))


def w14_rsi_7(spark, sf):
    return rounded_all(I.recursive(upanel(spark, sf).select("ticker", "date", "close"), value=("rsi", 7)).select("ticker", "date", "value"))


_DIFF = f"diff AS (SELECT *, greatest(close - lag(close) {L_}, 0) AS up, greatest(lag(close) {L_} - close, 0) AS down0, close - lag(close) {L_} AS d FROM base)"
_DIFF2 = "dd AS (SELECT ticker, date, rn, CASE WHEN d IS NOT NULL THEN up END AS up, CASE WHEN d IS NOT NULL THEN down0 END AS down FROM diff)"
QUERIES["w14_rsi_7"] = w14_rsi_7
SQL["w14_rsi_7"] = _rec(
    f"SELECT u.ticker, u.date, {r('CASE WHEN u.n >= 7 AND NOT (u.y = 0 AND v.y = 0) THEN CASE WHEN v.y = 0 THEN 100 ELSE 100 - 100 / (1 + u.y / v.y) END END')} AS value FROM u JOIN v ON u.ticker = v.ticker AND u.rn = v.rn",
    *UGRID, _BASE, _DIFF, _DIFF2, _ewm_sql("up", "(CAST(1 AS DOUBLE) / 7)", "dd", "u"), _ewm_sql("down", "(CAST(1 AS DOUBLE) / 7)", "dd", "v"),
)


def w15_macd_hourly(spark, sf):
    return rounded_all(I.recursive(hpanel(spark, sf).select("ticker", "date", "close"), value=("macd", 12, 26, 9)).select("ticker", "date", "value"))


QUERIES["w15_macd_hourly"] = w15_macd_hourly
SQL["w15_macd_hourly"] = _rec(
    f"SELECT l.ticker, l.date, {r('l.x - s.y')} AS value FROM line l JOIN s ON l.ticker = s.ticker AND l.rn = s.rn",
    *HGRID, _BASE, _ewm_sql("close", _a(12), "base", "f"), _ewm_sql("close", _a(26), "base", "g"),
    "line AS (SELECT f.ticker, f.date, f.rn, f.y - g.y AS x FROM f JOIN g ON f.ticker = g.ticker AND f.rn = g.rn)", _ewm_sql("x", _a(9), "line", "s"),
)


def w19_monthly_macd(spark, sf):
    return rounded_all(I.recursive(panel(spark, sf).select("ticker", "date", "close"), value=("monthly_macd", 8, 17, 9)).select("ticker", "date", "value"))


QUERIES["w19_monthly_macd"] = w19_monthly_macd
SQL["w19_monthly_macd"] = _rec(
    f"SELECT b.ticker, b.date, {r('last_value(m.v IGNORE NULLS) OVER (PARTITION BY b.ticker ORDER BY b.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS value FROM grid b LEFT JOIN m ON m.ticker = b.ticker AND m.date = b.date",
    *GRID, "base AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date DESC) AS z FROM grid) WHERE z = 1)",
    _ewm_sql("close", _a(8), "base", "f"), _ewm_sql("close", _a(17), "base", "g"),
    "line AS (SELECT f.ticker, f.date, f.rn, f.y - g.y AS x FROM f JOIN g ON f.ticker = g.ticker AND f.rn = g.rn)", _ewm_sql("x", _a(9), "line", "s"),
    "m AS (SELECT l.ticker, l.date, l.x - s.y AS v FROM line l JOIN s ON l.ticker = s.ticker AND l.rn = s.rn)",
)


def w21_registry(spark, sf):
    """Every indicator by its name, counted: how many values each gives on the panel of users."""
    p = upanel(spark, sf)
    args = {"momentum": (10, 2), "sma": (5,), "price_to_sma": (5,), "ema": (5,), "volatility": (5,), "atr": (5,), "zscore": (5,), "bollinger_pct": (5,), "rsi": (5,), "dollar_volume": (8,), "rolling_high": (8,), "rolling_low": (8,), "pct_of_high": (8,)}
    for name in I.ALL:
        p = I.add(p, name, None, *args.get(name, ()))
    stack = ", ".join(f"'{n}', count({n})" for n in I.ALL)
    return p.groupBy().agg(*[F.count(n).alias(n) for n in I.ALL]).selectExpr(f"stack({len(I.ALL)}, {', '.join(f'{chr(39)}{n}{chr(39)}, `{n}`' for n in I.ALL)}) AS (indicator, n)") if stack else p


QUERIES["w21_registry"] = w21_registry


def w23_row_average(spark, sf):
    """Averages over stored rows, not calendar rows, without a guard."""
    w = by_label().rowsBetween(-49, 0)
    return bars(spark, sf).select("ticker", "date", rounded(F.avg("close").over(w)).alias("value"))


QUERIES["w23_row_average"] = w23_row_average
SQL["w23_row_average"] = sql(f"SELECT ticker, date, {r(f'avg(close) {_w(50)}')} AS value FROM bars", *BRAND)


def w25_lag_lead(spark, sf):
    w = by_label()
    return bars(spark, sf).select("ticker", "date", F.lag("close").over(w).alias("before"), F.lead("close").over(w).alias("after"))


QUERIES["w25_lag_lead"] = w25_lag_lead
SQL["w25_lag_lead"] = sql(f"SELECT ticker, date, lag(close) {L_} AS before, lead(close) {L_} AS after FROM bars", *BRAND)


def w32_growth(spark, sf):
    """Growth of one unit and the deepest fall so far."""
    from pyspark.sql import Window as W

    w = by_label().rowsBetween(W.unboundedPreceding, 0)
    p = upanel(spark, sf).withColumn("f", F.coalesce(1.0 + I.daily_returns() / 1000.0, F.lit(1.0)))
    p = p.withColumn("growth", F.product("f").over(w))
    p = p.withColumn("fall", F.col("growth") / F.max("growth").over(w) - 1.0)
    return rounded_all(p.select("ticker", "date", "growth", F.min("fall").over(w).alias("deepest")))


QUERIES["w32_growth"] = w32_growth
SQL["w32_growth"] = sql(
    f"SELECT ticker, date, {r('growth')} AS growth, {r(f'min(fall) {ALL_}')} AS deepest FROM c", *UGRID,
    f"a AS (SELECT *, coalesce(1 + (close / lag(close) {L_} - 1) / CAST(1000 AS DOUBLE), CAST(1 AS DOUBLE)) AS f FROM grid)",
    f"b AS (SELECT *, product(f) {ALL_} AS growth FROM a)", f"c AS (SELECT *, growth / max(growth) {ALL_} - 1 AS fall FROM b)",
)


def w37_outliers(spark, sf):
    """Moves above 60 %, or above 30 % and above 3 deviations of the last 20 days."""
    p = I.with_returns(panel(spark, sf)).withColumn("dev", F.stddev_samp("ret").over(by_label().rowsBetween(-20, -1)))
    a = F.abs("ret")
    return p.where((a > 0.6) | ((a > 0.3) & (a > 3 * F.col("dev")))).select("ticker", "date", rounded("ret").alias("ret"))


QUERIES["w37_outliers"] = w37_outliers
SQL["w37_outliers"] = sql(
    f"SELECT ticker, date, {r('ret')} AS ret FROM b WHERE abs(ret) > CAST(0.6 AS DOUBLE) OR (abs(ret) > CAST(0.3 AS DOUBLE) AND abs(ret) > 3 * dev)", *GRID,
    f"a AS (SELECT *, close / lag(close) {L_} - 1 AS ret FROM grid)", "b AS (SELECT *, stddev_samp(ret) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS dev FROM a)",
)
