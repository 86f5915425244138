"""Further registered queries of the inventory: aggregates, windows, functions, statistics and audits."""

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
from ..operators.grid import by_label
from ..sources import tables as S
from .q_market import _MONTHS
from .q_series import ACTS, ADJ, EQ, FLAT, L, _runs, acts, adjusted, equity_like, flat
from .shared import BRAND, GRID, MEMBERS, UGRID, bars, r, rounded_all, snapshots, spans, sql, upanel

QUERIES, SQL = {}, {}


def query(name: str, text: str | None = None):
    def put(f):
        QUERIES[name] = f
        if text:
            SQL[name] = text
        return f

    return put


@query("p01_project_rename", "SELECT c_custkey AS id, upper(c_name) AS name FROM customer")
def p01(spark, sf):
    return S.parquet(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"))


@query("p10_finished_sessions", sql("SELECT ticker, date FROM bars WHERE date < DATE '2001-06-01'", *BRAND))
def p10(spark, sf):
    """Rows before a given today: the unfinished session is dropped."""
    return bars(spark, sf).where(F.col("date") < F.lit(dt.date(2001, 6, 1))).select("ticker", "date")


@query("p11_positive_prices", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def p11(spark, sf):
    return S.parquet(spark, sf, "customer", ["c_custkey"], "c_acctbal > 0")


@query("j05_outer_sources", sql("SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.date, b.date) AS date, a.close AS one, b.close AS two FROM (SELECT * FROM bars WHERE volume > 30) a FULL JOIN (SELECT * FROM bars WHERE volume < 60) b ON a.ticker = b.ticker AND a.date = b.date", *BRAND))
def j05(spark, sf):
    b = bars(spark, sf)
    one = b.where("volume > 30").select("ticker", "date", F.col("close").alias("one"))
    return one.join(b.where("volume < 60").select("ticker", "date", F.col("close").alias("two")), ["ticker", "date"], "full")


@query("j11_multi_span_mask", sql("SELECT b.ticker, b.date, EXISTS (SELECT 1 FROM spans s WHERE s.ticker = b.ticker AND b.date >= s.start AND (s.\"end\" IS NULL OR b.date < s.\"end\")) AS member FROM bars b", *MEMBERS))
def j11(spark, sf):
    b = bars(spark, sf).select("ticker", "date")
    inside = pit.members_on(b, spans(spark, sf)).withColumn("m", F.lit(True))
    return b.join(inside, ["ticker", "date"], "left").select("ticker", "date", F.coalesce("m", F.lit(False)).alias("member"))


@query("j15_one_to_one")
def j15(spark, sf):
    """Joins and leaves of members matched one to one within 40 days."""
    ch = pit.member_changes(snapshots(spark, sf))
    a = ch.where("change = 1").select(F.struct("ticker", "date").alias("l"), F.col("date").alias("d"))
    b = ch.where("change = -1").select(F.struct("ticker", "date").alias("r"), F.col("date").alias("e"))
    # bands one day wider than the tolerance: a join meets three
    band = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / 41)
    a = a.withColumn("band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: i + band("d"))))
    near = a.join(b.withColumn("band", band("e")), "band").withColumn("gap", F.abs(F.datediff("e", "d"))).where("gap <= 40").drop("band")
    return reconcile.mutual_best(near, "l", "r", ["gap"]).select("l.ticker", F.col("l.date").alias("date"), F.col("r.ticker").alias("other"), "gap")


@query("j19_map_join", "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def j19(spark, sf):
    names = S.parquet(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return S.parquet(spark, sf, "customer", ["c_custkey", "c_nationkey"]).join(names, "c_nationkey", "left").select("c_custkey", "nation")


@query("a02_count_distinct", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n FROM lineitem")
def a02(spark, sf):
    return S.parquet(spark, sf, "lineitem").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"), F.count("*").alias("n"))


@query("a08_conditional_share", f"SELECT l_returnflag AS flag, {r('avg(CAST(l_quantity > 25 AS DOUBLE))')} AS share, count_if(l_tax > CAST(0.05 AS DOUBLE))::BIGINT AS taxed FROM lineitem GROUP BY 1")
def a08(spark, sf):
    return S.parquet(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(rounded(F.avg((F.col("l_quantity") > 25).cast("double"))).alias("share"), F.count_if(F.col("l_tax") > 0.05).alias("taxed"))


@query("a11_column_correlations", sql(f"SELECT b.ticker, {r('corr(b.close, m.close)', 5)} AS c FROM bars b JOIN (SELECT date, close FROM bars WHERE ticker = 'Brand#7') m ON m.date = b.date WHERE b.ticker <> 'Brand#7' GROUP BY 1 ORDER BY c DESC, b.ticker LIMIT 5", *BRAND))
def a11(spark, sf):
    b = bars(spark, sf)
    m = b.where("ticker = 'Brand#7'").select("date", F.col("close").alias("m"))
    return b.where("ticker <> 'Brand#7'").join(m, "date").groupBy("ticker").agg(rounded(F.corr("close", "m"), 5).alias("c")).orderBy(F.desc("c"), "ticker").limit(5)


@query("a14_share_of_total", sql(f"SELECT ticker, date, {r('volume / sum(volume) OVER (PARTITION BY date)')} AS share FROM bars", *BRAND))
def a14(spark, sf):
    return bars(spark, sf).select("ticker", "date", rounded(F.col("volume") / F.sum("volume").over(W.partitionBy("date"))).alias("share"))


@query("a15_value_counts", "SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def a15(spark, sf):
    return S.parquet(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("value")).agg(F.count("*").alias("n"))


@query("w24_global_max", sql("SELECT ticker, date, close = max(close) OVER (PARTITION BY ticker) AS at_high FROM bars", *BRAND))
def w24(spark, sf):
    return bars(spark, sf).select("ticker", "date", (F.col("close") == F.max("close").over(W.partitionBy("ticker"))).alias("at_high"))


@query("w26_later_product", sql(f"SELECT ticker, date, coalesce(product(CASE WHEN stock_splits = 0 THEN 1 ELSE stock_splits END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS later FROM acts WHERE date >= DATE '2000-01-01'", *BRAND, ACTS))
def w26(spark, sf):
    x = acts(spark, sf).where(F.col("date") >= dt.date(2000, 1, 1)).withColumn("s", F.when(F.col("stock_splits") == 0, 1.0).otherwise(F.col("stock_splits")))
    return x.select("ticker", "date", A.later_product("s").alias("later"))


@query("w30_segment_basis", sql(f"SELECT ticker, segment, count(*) AS n, {r('median(x)', 5)} AS basis FROM (SELECT ticker, close / open AS x, sum(CASE WHEN stock_splits <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS segment FROM acts) GROUP BY 1, 2", *BRAND, ACTS))
def w30(spark, sf):
    w = by_label().rowsBetween(W.unboundedPreceding, 0)
    x = acts(spark, sf).withColumn("segment", F.sum((F.col("stock_splits") != 0).cast("long")).over(w)).withColumn("x", F.col("close") / F.col("open"))
    return x.groupBy("ticker", "segment").agg(F.count("*").alias("n"), rounded(F.median("x"), 5).alias("basis"))


@query("w33_ten_month_gate", sql("SELECT ticker, month, CASE WHEN count(close) OVER w >= 10 THEN close > avg(close) OVER w END AS above FROM months WINDOW w AS (PARTITION BY ticker ORDER BY month ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)", *BRAND, _MONTHS))
def w33(spark, sf):
    w = W.partitionBy("ticker").orderBy("month").rowsBetween(-9, 0)
    return C.month_end(bars(spark, sf), "close").select("ticker", "month", F.when(F.count("close").over(w) >= 10, F.col("close") > F.avg("close").over(w)).alias("above"))


@query("w35_trailing_run", sql("SELECT ticker, count(*) FILTER (date > real OR real IS NULL) AS flat_bars FROM (SELECT *, max(CASE WHEN volume > 0 THEN date END) OVER (PARTITION BY ticker) AS real FROM flat) GROUP BY 1", *GRID, FLAT))
def w35(spark, sf):
    x = flat(spark, sf).withColumn("real", F.max(F.when(F.col("volume") > 0, F.col("date"))).over(W.partitionBy("ticker")))
    return x.groupBy("ticker").agg(F.count_if(F.col("real").isNull() | (F.col("date") > F.col("real"))).alias("flat_bars"))


@query("w38_last_window_correlation", sql(f"SELECT a.ticker AS a, b.ticker AS b, {r('corr(a.x, b.x)', 4)} AS c FROM rr a JOIN rr b ON a.date = b.date AND a.ticker < b.ticker GROUP BY 1, 2 HAVING count(*) >= 8", *UGRID, f"rr AS (SELECT * FROM (SELECT ticker, date, day, close / lag(close) {L} - 1 AS x FROM grid) WHERE x IS NOT NULL AND day >= 10)"))
def w38(spark, sf):
    """All pairs of labels."""
    x = indicators.with_returns(upanel(spark, sf)).where("ret IS NOT NULL AND day >= 10").select("ticker", "date", "ret")
    return reconcile.correlated_pairs(x, "ret", least=8, digits=4)


@query("w38_last_window_correlation_all")
def w38_all(spark, sf):
    """The former name of the query over all pairs."""
    return w38(spark, sf)


@query("t04_largest_moves", sql(f"SELECT ticker, date, {r('ret')} AS ret FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS ret FROM bars) WHERE ret IS NOT NULL ORDER BY {r('abs(ret)')} DESC, ticker, date LIMIT 20", *BRAND))
def t04(spark, sf):
    x = indicators.with_returns(bars(spark, sf)).where("ret IS NOT NULL")
    return x.orderBy(rounded(F.abs("ret")).desc(), "ticker", "date").limit(20).select("ticker", "date", rounded("ret").alias("ret"))


@query("f01_regex", "SELECT p_partkey, regexp_extract(p_brand, '#(\\d+)', 1) AS n, regexp_replace(p_type, '[AEIOU]', '', 'g') AS t FROM part")
def f01(spark, sf):
    return S.parquet(spark, sf, "part").select("p_partkey", F.regexp_extract("p_brand", r"#(\d+)", 1).alias("n"), F.regexp_replace("p_type", "[AEIOU]", "").alias("t"))


@query("f02_strings", "SELECT p_partkey, upper(trim(p_name)) AS u, replace(p_name, 'a', '') AS x, starts_with(p_brand, 'Brand#1') AS s, contains(p_name, 'e') AS c FROM part")
def f02(spark, sf):
    return S.parquet(spark, sf, "part").select("p_partkey", F.upper(F.trim("p_name")).alias("u"), F.replace("p_name", F.lit("a"), F.lit("")).alias("x"), F.col("p_brand").startswith("Brand#1").alias("s"), F.col("p_name").contains("e").alias("c"))


@query("f07_date_arithmetic", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) + 45 AS later, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days FROM orders")
def f07(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return S.parquet(spark, sf, "orders").select("o_orderkey", F.date_add(F.last_day(d), 45).alias("later"), F.datediff(F.lit(dt.date(2002, 1, 1)), d).alias("days"))


@query("f10_math", "SELECT p_partkey, floor(sqrt(p_retailprice) * 1000) AS s, floor(ln(p_retailprice) * 1000) AS l, sign(p_size - 25)::DOUBLE AS g, least(greatest(p_size, 10), 40) AS c FROM part")
def f10(spark, sf):
    p = F.col("p_retailprice")
    return S.parquet(spark, sf, "part").select("p_partkey", F.floor(F.sqrt(p) * 1000).cast("double").alias("s"), F.floor(F.log(p) * 1000).cast("double").alias("l"), F.signum(F.col("p_size") - 25).alias("g"), F.least(F.greatest("p_size", F.lit(10)), F.lit(40)).alias("c"))


@query("d03_history_cut", sql("SELECT ticker, count(*) AS n, min(date) AS first FROM (SELECT *, max(CASE WHEN volume = 41 THEN date END) OVER (PARTITION BY ticker) AS cut FROM bars) WHERE cut IS NULL OR date > cut GROUP BY 1", *BRAND))
def d03(spark, sf):
    x = bars(spark, sf).withColumn("dividends", F.lit(0.0)).withColumn("stock_splits", F.when(F.col("volume") == 41, -1.0).otherwise(0.0)).withColumn("raw", F.lit(True))
    return A.back_adjust(x).groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first"))


@query("d17_merge_labels")
def d17(spark, sf):
    pairs = spark.createDataFrame([("Brand#1", "Brand#2"), ("Brand#3", "None")], "bare string, label string")
    return membership.merge_labels(spans(spark, sf), pairs)


@query("d20_identity_acceptance", sql(f"SELECT ticker, n >= 250 AND off <= 550 AND {r('same')} <= CAST(0.3 AS DOUBLE) AS accepted FROM (SELECT a.ticker, count(*) AS n, abs(date_diff('day', max(a.date), DATE '2001-06-01')) AS off, avg(CAST(a.close = b.close AS DOUBLE)) AS same FROM bars a JOIN (SELECT date, max(close) AS close FROM bars GROUP BY 1) b ON a.date = b.date GROUP BY 1)", *BRAND))
def d20(spark, sf):
    """Enough overlap, an end near the label's month, few closes equal to today's owner."""
    b = bars(spark, sf).select("ticker", "date", "close")
    owner = b.groupBy("date").agg(F.max("close").alias("owner"))
    g = b.join(owner, "date").groupBy("ticker").agg(F.count("*").alias("n"), F.abs(F.datediff(F.max("date"), F.lit(dt.date(2001, 6, 1)))).alias("off"), rounded(F.avg((F.col("close") == F.col("owner")).cast("double"))).alias("same"))
    return g.select("ticker", ((F.col("n") >= 250) & (F.col("off") <= 550) & (F.col("same") <= 0.3)).alias("accepted"))


@query("d21_split_at_label", sql("SELECT ticker, date AS first_after, CAST(gap AS INTEGER) AS gap FROM (SELECT ticker, date, date_diff('day', lag(date) OVER (PARTITION BY ticker ORDER BY date), date) AS gap FROM ubars) WHERE gap >= 3", *UGRID[:1]))
def d21(spark, sf):
    from ..sources.bars import user_day

    x = user_day(spark, sf).withColumn("gap", F.datediff("date", F.lag("date").over(by_label())))
    return x.where("gap >= 3").select("ticker", F.col("date").alias("first_after"), "gap")


@query("b16_benchmark", sql(f"SELECT date, {r('c / f * 1000', 4)} AS bench FROM (SELECT date, last_value(close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c, (SELECT arg_min(close, date) FROM bars WHERE ticker = 'Brand#5') AS f FROM grid WHERE ticker = 'Brand#5')", *GRID))
def b16(spark, sf):
    from .shared import panel

    return ledger.benchmark(panel(spark, sf), "Brand#5", 1000.0).select("date", rounded("bench", 4).alias("bench"))


@query("b20_equal_weight_index", sql(f"SELECT CAST(date_trunc('month', date) AS DATE) AS month, {r('avg(m)')} AS ret FROM (SELECT date, avg(ret) AS m FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS ret FROM bars) WHERE ret IS NOT NULL GROUP BY 1) GROUP BY 1", *BRAND))
def b20(spark, sf):
    x = indicators.with_returns(bars(spark, sf)).where("ret IS NOT NULL")
    return x.groupBy("date").agg(F.avg("ret").alias("m")).groupBy(F.trunc("date", "month").alias("month")).agg(rounded(F.avg("m")).alias("ret"))


@query("b23_single_swap", sql("SELECT date, CASE WHEN abs(abs(i - a) - abs(i - b)) <= CAST(0.01 AS DOUBLE) THEN 'undecided' WHEN abs(i - a) < abs(i - b) THEN 'ours' ELSE 'theirs' END AS verdict FROM (SELECT date, floor(avg(close)) / 1000 AS i, floor(max(close)) / 1000 AS a, floor(min(close)) / 1000 AS b FROM bars GROUP BY 1)", *BRAND))
def b23(spark, sf):
    k = lambda c: F.floor(c) / 1000.0
    d = bars(spark, sf).groupBy("date").agg(k(F.avg("close")).alias("index"), k(F.max("close")).alias("with_ours"), k(F.min("close")).alias("with_theirs"))
    return quality.single_swap(d, 0.01).select("date", "verdict")


@query("r04_drawdown_series", sql(f"SELECT run, date, {r('value / max(value) OVER (PARTITION BY run ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1')} AS dd FROM eq", *BRAND, EQ))
def r04(spark, sf):
    w = W.partitionBy("run").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return equity_like(spark, sf).select("run", "date", rounded(F.col("value") / F.max("value").over(w) - 1).alias("dd"))


@query("r08_turnover")
def r08(spark, sf):
    from .. import strategies as ST

    runs = {"m": ST.Momentum(windows=(60, 30, 15, 5), n=5, start="2000-01-01")}
    return rounded_all(ledger.turnover(ledger.simulate(_runs(spark, sf), runs)))


@query("r11_yearly_table", sql(f"SELECT coalesce(a.period, b.period) AS period, {r('a.ret')} AS strategy, {r('b.ret')} AS bench, {r('a.ret - b.ret')} AS excess FROM (SELECT * FROM y WHERE run = 'Brand#2') a FULL JOIN (SELECT * FROM y WHERE run = 'Brand#1') b ON a.period = b.period", *BRAND, EQ, "y AS (SELECT run, period, last / coalesce(lag(last) OVER (PARTITION BY run ORDER BY period), first) - 1 AS ret FROM (SELECT run, CAST(date_trunc('year', date) AS DATE) AS period, arg_min(value, date) AS first, arg_max(value, date) AS last FROM eq GROUP BY 1, 2))"))
def r11(spark, sf):
    y = stats.period_returns(equity_like(spark, sf), "year")
    a = y.where("run = 'Brand#2'").select("period", F.col("ret").alias("strategy"))
    j = a.join(y.where("run = 'Brand#1'").select("period", F.col("ret").alias("bench")), "period", "full")
    return rounded_all(j.withColumn("excess", F.col("strategy") - F.col("bench")))


@query("r12_monthly_stats", sql(f"SELECT ticker, {r('avg(g) * 12')} AS mean, {r('stddev_samp(g) * sqrt(CAST(12 AS DOUBLE))')} AS vol, {r('avg(g) * 12 / (stddev_samp(g) * sqrt(CAST(12 AS DOUBLE)))')} AS sharpe FROM (SELECT ticker, close / lag(close) OVER (PARTITION BY ticker ORDER BY month) - 1 AS g FROM months) WHERE g IS NOT NULL GROUP BY 1", *BRAND, _MONTHS))
def r12(spark, sf):
    w = W.partitionBy("ticker").orderBy("month")
    m = C.month_end(bars(spark, sf), "close").withColumn("g", N.ratio("close", F.lag("close").over(w)) - 1.0).where("g IS NOT NULL")
    vol = F.stddev_samp("g") * F.sqrt(F.lit(12.0))
    return rounded_all(m.groupBy("ticker").agg((F.avg("g") * 12).alias("mean"), vol.alias("vol"), N.ratio(F.avg("g") * 12, vol).alias("sharpe")))


@query("v01_known_answers", "SELECT * FROM (VALUES (0, 'ALGERIA', 'UNVERIFIED'), (1, 'x', 'UNVERIFIED')) t(k, want, status) WHERE k < 0 UNION ALL SELECT n_nationkey, n_name, 'PASS' FROM nation WHERE n_nationkey < 3 UNION ALL SELECT 99, 'none', 'UNVERIFIED'")
def v01(spark, sf):
    """Known rows looked up: found and equal, found and different, or not there."""
    n = S.parquet(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("got"))
    known = n.where("k < 3").withColumnRenamed("got", "want").unionByName(spark.createDataFrame([(99, "none")], "k int, want string"))
    j = known.join(n, "k", "left")
    return j.select("k", "want", quality.status((F.col("want") != F.col("got")).cast("int"), F.col("got").isNotNull()).alias("status"))


@query("v05_cross_source_ledger", sql(f"SELECT ticker, CASE WHEN share >= CAST(0.95 AS DOUBLE) THEN 'PASS' ELSE 'FAIL' END AS status, days, {r('1 - share')} AS pct_off FROM (SELECT ticker, count(*) AS days, {r('avg(CAST(abs(x - y) < CAST(0.005 AS DOUBLE) AS DOUBLE))')} AS share FROM (SELECT ticker, date, x, x + CASE WHEN ticker < 'Brand#2' AND day(date) = 3 THEN CAST(0.02 AS DOUBLE) WHEN ticker >= 'Brand#2' AND day(date) % 3 = 0 THEN CAST(0.01 AS DOUBLE) ELSE 0 END AS y FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS x FROM bars)) WHERE x IS NOT NULL GROUP BY 1)", *BRAND))
def v05(spark, sf):
    a = bars(spark, sf).withColumn("x", indicators.returns()).select("ticker", "date", "x")
    early, day = F.col("ticker") < "Brand#2", F.dayofmonth("date")
    b = a.withColumn("x", F.col("x") + F.when(early & (day == 3), 0.02).when(~early & (day % 3 == 0), 0.01).otherwise(0.0))
    g = reconcile.agreement(a, b, "x", 0.005).withColumn("share", rounded("share"))
    return g.select("ticker", F.when(F.col("share") >= 0.95, "PASS").otherwise("FAIL").alias("status"), "days", rounded(1 - F.col("share")).alias("pct_off"))


@query("v11_guard_summary", sql("SELECT status, count(*) AS n FROM (SELECT CASE WHEN o.ticker IS NULL THEN 'new' WHEN n.ticker IS NULL THEN 'gone' WHEN abs(n.close / o.close - 1) > CAST(0.01 AS DOUBLE) THEN 'changed' ELSE 'same' END AS status FROM (SELECT * FROM bars WHERE volume <> 30) o FULL JOIN (SELECT ticker, date, close * CASE WHEN day(date) = 4 THEN 2 ELSE 1 END AS close FROM bars WHERE volume <> 20) n ON o.ticker = n.ticker AND o.date = n.date) GROUP BY 1", *BRAND))
def v11(spark, sf):
    b = bars(spark, sf).select("ticker", "date", "close", "volume")
    new = b.where("volume <> 20").withColumn("close", F.col("close") * F.when(F.dayofmonth("date") == 4, 2).otherwise(1))
    return reconcile.restatement(b.where("volume <> 30"), new, ["ticker", "date"], "close", 0.01).groupBy("status").agg(F.count("*").alias("n"))


@query("v13_best_candidate", sql("SELECT a, b, n FROM (SELECT x.ticker AS a, y.ticker AS b, count(*) AS n FROM bars x JOIN bars y ON x.date = y.date AND abs(x.close - y.close) < 5 AND x.ticker <> y.ticker GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1", *BRAND))
def v13(spark, sf):
    """Of all labels the one whose closes agree on most days."""
    b = bars(spark, sf).select("ticker", "date", "close")
    a, c = b.toDF("a", "date", "x"), b.toDF("b", "date", "y")
    n = a.join(c, "date").where("a <> b AND abs(x - y) < 5").groupBy("a", "b").agg(F.count("*").alias("n"))
    return n.groupBy("a").agg(F.min_by(F.struct("b", "n"), F.struct(-F.col("n"), F.col("b"))).alias("m")).select("a", "m.b", "m.n")


@query("v17_implied_total", sql(f"SELECT ticker, {r('sum(CASE WHEN d > 0 THEN d ELSE 0 END)', 2)} AS implied FROM (SELECT ticker, {r(f'lag(close) {L} * (1 + volume / CAST(100 AS DOUBLE)) - close', 2)} AS d FROM bars) GROUP BY 1", *BRAND))
def v17(spark, sf):
    x = A.implied_distribution(bars(spark, sf).withColumn("ret", F.col("volume") / 100.0)).withColumn("d", rounded("implied", 2))
    return x.groupBy("ticker").agg(rounded(F.sum(F.when(F.col("d") > 0, F.col("d")).otherwise(0.0)), 2).alias("implied"))


@query("v20_rivals", sql("SELECT a.ticker AS ticker, b.ticker AS rival FROM e a JOIN e b ON a.ticker <> b.ticker AND abs(date_diff('day', a.last, b.last)) <= 3 AND abs(b.close / a.close - 1) <= CAST(0.25 AS DOUBLE)", *BRAND, "e AS (SELECT ticker, max(date) AS last, arg_max(close, date) AS close FROM bars GROUP BY 1)"))
def v20(spark, sf):
    """Labels that end within three days of each other at prices within a quarter."""
    e = bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("last"), F.max_by("close", "date").alias("close"))
    band = e.withColumn("k", F.explode(F.expr("sequence(floor(datediff(last, DATE '1970-01-01') / 4) - 1, floor(datediff(last, DATE '1970-01-01') / 4) + 1)")))
    b = e.select(F.col("ticker").alias("rival"), F.col("last").alias("l2"), F.col("close").alias("c2"), F.expr("floor(datediff(last, DATE '1970-01-01') / 4)").alias("k"))
    j = band.join(b, "k").where((F.col("ticker") != F.col("rival")) & (F.abs(F.datediff("last", "l2")) <= 3) & (F.abs(F.col("c2") / F.col("close") - 1) <= 0.25))
    return j.select("ticker", "rival")


@query("v22_split_like_days", sql(f"SELECT ticker, date, {r('x')} AS ratio FROM (SELECT ticker, date, lag(close) {L} / close AS x FROM bars) WHERE abs(x / 2 - 1) < CAST(0.005 AS DOUBLE) OR abs(x / 3 - 1) < CAST(0.005 AS DOUBLE)", *BRAND))
def v22(spark, sf):
    x = bars(spark, sf).withColumn("x", N.ratio(F.lag("close").over(by_label()), "close"))
    return x.where((F.abs(F.col("x") / 2 - 1) < 0.005) | (F.abs(F.col("x") / 3 - 1) < 0.005)).select("ticker", "date", rounded("x").alias("ratio"))


@query("v27_rebuild_diff", sql("SELECT date, ticker FROM snaps EXCEPT SELECT s.date, s.ticker FROM snaps s WHERE s.ticker = 'Brand#8' AND year(s.date) = 1999", *MEMBERS[:2]))
def v27(spark, sf):
    s = snapshots(spark, sf)
    return s.subtract(s.where("ticker = 'Brand#8' AND year(date) = 1999"))


@query("v28_spin_dry_run", sql(f"SELECT ticker, date, {r('(80 + CAST(0.5 AS DOUBLE) * 30) / 100 * close', 4)} AS expected FROM bars WHERE day(date) = 15 AND month(date) = 6", *BRAND))
def v28(spark, sf):
    return bars(spark, sf).where("day(date) = 15 AND month(date) = 6").select("ticker", "date", rounded((80 + 0.5 * 30) / 100 * F.col("close"), 4).alias("expected"))


@query("v16_year_comparison", sql(f"SELECT year(date) AS year, count(*) AS days, count_if(adj_close / close < CAST(0.5 AS DOUBLE))::BIGINT AS halved, {r('avg(adj_close / close)')} AS mean FROM adj GROUP BY 1", *BRAND, ACTS, ADJ))
def v16(spark, sf):
    x = adjusted(spark, sf).withColumn("q", F.col("adj_close") / F.col("close"))
    return x.groupBy(F.year("date").cast("long").alias("year")).agg(F.count("*").alias("days"), F.count_if(F.col("q") < 0.5).alias("halved"), rounded(F.avg("q")).alias("mean"))


@query("f04_similarity", "SELECT n_nationkey, floor((1 - levenshtein(lower(n_name), 'germania') / CAST(greatest(length(n_name), 8) AS DOUBLE)) * 1000000 + CAST(0.5001 AS DOUBLE)) / CAST(1000000 AS DOUBLE) AS sim FROM nation")
def f04(spark, sf):
    return S.parquet(spark, sf, "nation").select("n_nationkey", rounded(X.similarity(F.lower("n_name"), F.lit("germania"))).alias("sim"))
