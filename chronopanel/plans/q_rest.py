"""Further registered queries: round trips of sources and sinks, joins and functions by themselves, checks, and one whole simulation."""

from __future__ import annotations

import datetime as dt
import io
import tempfile
import uuid
import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..functions.numeric import rounded
from ..operators import adjust as A
from ..operators import cross_section as C
from ..operators import indicators, ledger, membership, pit, quality, reconcile, stats
from ..operators.grid import by_label
from ..sources import tables as S
from .q_series import ACTS, EQ, L, _ST, acts, equity_like
from .shared import BRAND, GRID, MEMBERS, bars, panel, r, rounded_all, snapshots, spans, sql

QUERIES, SQL = {}, {}


def query(name: str, text: str | None = None):
    def put(f):
        QUERIES[name] = f
        if text:
            SQL[name] = text
        return f

    return put


def _scratch(spark: SparkSession) -> str:
    """A new folder for a round trip, in the one that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{named or tempfile.mkdtemp(prefix='chronopanel-')}/round-trip-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


# Sources and sinks

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey FROM customer"


def _customers(spark, sf):
    return S.parquet(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])


@query("s06_csv_scan", _CUSTOMER)
def s06(spark, sf):
    path = _scratch(spark)
    S.write_csv(_customers(spark, sf), path)
    return S.csv(spark, path, _customers(spark, sf).schema)


@query("s07_filtered_csv", _CUSTOMER + " WHERE c_nationkey = 7")
def s07(spark, sf):
    """The filter goes into the reader of the split files."""
    return s06(spark, sf).where("c_nationkey = 7")


@query("s09_labelled_files", "SELECT r_name AS label, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def s09(spark, sf):
    """One file for each region, whose name is the label."""
    path = _scratch(spark)
    both = S.parquet(spark, sf, "nation").join(S.parquet(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    both.select("r_name", "n_name").repartition("r_name").write.partitionBy("r_name").parquet(path + "/parts")
    fs, _ = _files(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(to(path + "/files"))
    for folder in fs.listStatus(to(path + "/parts")):  # as many as there are labels of the archive
        name = folder.getPath().getName()
        if name.startswith("r_name="):
            for file in fs.listStatus(folder.getPath()):
                if file.getPath().getName().endswith(".parquet"):
                    fs.rename(file.getPath(), to(f"{path}/files/{name.removeprefix('r_name=')}.parquet"))
    return S.labelled_files(spark, path + "/files/*.parquet").select(F.replace("label", F.lit("%20"), F.lit(" ")).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("s10_zipped_csv", "SELECT n_nationkey, n_name FROM nation")
def s10(spark, sf):
    rows = S.parquet(spark, sf, "nation", ["n_nationkey", "n_name"]).collect()  # 25 rows: the archive to be read
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("nation.csv", "key,name\n" + "".join(f"{x[0]},{x[1]}\n" for x in rows))
    path = _scratch(spark) + ".zip"
    fs, where = _files(spark, path)
    out = fs.create(where)
    out.write(bytearray(body.getvalue()))
    out.close()
    return S.zipped_csv(spark, path, "nation.csv", "n_nationkey int, n_name string")


@query("s11_html_cells", "SELECT n_nationkey AS page_id, CAST(n_regionkey AS INTEGER) AS row, n_name AS text FROM nation UNION ALL SELECT n_nationkey, n_regionkey + 1, 'x & y' FROM nation")
def s11(spark, sf):
    """Cells of a table in pages made of the rows of nation."""
    n = S.parquet(spark, sf, "nation")
    filler = F.repeat(F.lit("<TR><td></td></TR>"), F.col("n_regionkey").cast("int"))
    page = F.concat(F.lit("<p>head<table class='a'>"), filler, F.lit("<tr><th scope='row'>"), F.col("n_name"), F.lit("</th></tr>\n<tr><td><b>x</b> &amp; y</td></tr></table>"))
    cells = S.html_tables(n.select(F.col("n_nationkey").alias("page_id"), page.alias("html")), "html", ["page_id"])
    return cells.where("text <> ''").select("page_id", "row", "text")


@query("s17_price_sink", sql("SELECT ticker, count(*) AS n, min(date) AS first FROM bars GROUP BY 1", *BRAND))
def s17(spark, sf):
    path = _scratch(spark)
    S.write_prices(bars(spark, sf), path)
    return spark.read.parquet(path).groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first"))


@query("s18_csv_sink", sql("SELECT ticker, count(*) AS n FROM bars GROUP BY 1", *BRAND))
def s18(spark, sf):
    path = _scratch(spark)
    S.write_csv(bars(spark, sf), path)
    return S.csv(spark, path).groupBy("ticker").agg(F.count("*").alias("n"))


@query("s19_json_sink", "SELECT r_regionkey, r_name FROM region")
def s19(spark, sf):
    path = _scratch(spark)
    S.write_json(S.parquet(spark, sf, "region", ["r_regionkey", "r_name"]), path)
    return spark.read.schema("r_regionkey int, r_name string").json(path)


@query("s21_view", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def s21(spark, sf):
    S.register(spark, chronopanel_nation=S.parquet(spark, sf, "nation"))
    return spark.sql("SELECT n_regionkey, count(*) AS n FROM chronopanel_nation GROUP BY 1")


# Joins and aggregates

@query("j06_inner_concat", sql("SELECT x.date, x.close AS a, y.close AS b FROM bars x JOIN bars y ON x.date = y.date WHERE x.ticker = 'Brand#1' AND y.ticker = 'Brand#2'", *BRAND))
def j06(spark, sf):
    b = bars(spark, sf)
    side = lambda t, n: b.where(F.col("ticker") == t).select("date", F.col("close").alias(n))
    return side("Brand#1", "a").join(side("Brand#2", "b"), "date")


@query("j08_semi_join", sql("SELECT ticker, date FROM bars b WHERE EXISTS (SELECT 1 FROM spans s WHERE s.ticker = b.ticker AND s.start <= b.date AND (s.\"end\" IS NULL OR s.\"end\" > b.date))", *MEMBERS))
def j08(spark, sf):
    return pit.members_on(bars(spark, sf).select("ticker", "date"), spans(spark, sf))


@query("j09_anti_join", sql("SELECT ticker, date FROM bars b WHERE NOT EXISTS (SELECT 1 FROM snaps s WHERE s.ticker = b.ticker AND s.date = date_trunc('month', b.date))", *MEMBERS[:2]))
def j09(spark, sf):
    s = snapshots(spark, sf).withColumnRenamed("date", "month")
    return bars(spark, sf).select("ticker", "date", F.trunc("date", "month").alias("month")).join(s, ["ticker", "month"], "left_anti").select("ticker", "date")


@query("a06_arg_extremes", sql("SELECT ticker, arg_max(date, (close, date)) AS best, arg_min(date, (close, date)) AS worst FROM bars GROUP BY 1", *BRAND))
def a06(spark, sf):
    key = F.struct("close", "date")
    return bars(spark, sf).groupBy("ticker").agg(F.max_by("date", key).alias("best"), F.min_by("date", key).alias("worst"))


@query("a10_beta_alpha", sql(f"SELECT ticker, {r('covar_samp(x, m) / var_samp(m)')} AS beta, {r('avg(x) - covar_samp(x, m) / var_samp(m) * avg(m)')} AS alpha FROM (SELECT ticker, close AS x, avg(close) OVER (PARTITION BY date) AS m FROM bars) GROUP BY 1 HAVING var_samp(m) > 0", *BRAND))
def a10(spark, sf):
    b = bars(spark, sf)
    j = b.join(b.groupBy("date").agg(F.avg("close").alias("m")), "date")
    g = j.groupBy("ticker").agg(N.ratio(F.covar_samp("close", "m"), F.var_samp("m")).alias("beta"), F.avg("close").alias("x"), F.avg("m").alias("m")).where("beta IS NOT NULL")
    return rounded_all(g.select("ticker", "beta", (F.col("x") - F.col("beta") * F.col("m")).alias("alpha")))


@query("a23_round_dividends", sql(f"SELECT ticker, count(*) AS n, {r('avg(CAST(abs(dividends * 100 - floor(dividends * 100 + CAST(0.5 AS DOUBLE))) < CAST(0.0001 AS DOUBLE) AS DOUBLE))')} AS as_is FROM acts WHERE dividends > 0 GROUP BY 1 HAVING count(*) >= 4", *BRAND, ACTS))
def a23(spark, sf):
    return rounded_all(quality.dividend_basis(acts(spark, sf), digits=2).select("ticker", "n", "as_is"))


@query("b04_equal_weight", sql("SELECT date, ticker, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY date) AS weight FROM snaps", *MEMBERS[:2]))
def b04(spark, sf):
    return snapshots(spark, sf).select("date", "ticker", C.equal_weight().alias("weight"))


@query("r02_volatility_sharpe", sql(f"SELECT run, {r('dev * sqrt(CAST(252 AS DOUBLE))')} AS vol, {r('mean * 252 / (dev * sqrt(CAST(252 AS DOUBLE)))')} AS sharpe FROM s", *BRAND, EQ, _ST))
def r02(spark, sf):
    return rounded_all(stats.series_stats(equity_like(spark, sf)).select("run", "vol", "sharpe"))


@query("r03_sortino", sql(f"SELECT run, {r('mean * 252 / (down * sqrt(CAST(252 AS DOUBLE)))')} AS sortino FROM s", *BRAND, EQ, _ST))
def r03(spark, sf):
    return rounded_all(stats.series_stats(equity_like(spark, sf)).select("run", "sortino"))


# Functions

@query("f08_weekday", "SELECT o_orderkey, isodow(o_orderdate) >= 6 AS weekend FROM orders")
def f08(spark, sf):
    return S.parquet(spark, sf, "orders").select("o_orderkey", (F.weekday("o_orderdate") >= 5).alias("weekend"))


@query("f09_time_zone", "SELECT event_id, CAST(timezone('America/New_York', timezone('UTC', CAST(ts AS TIMESTAMP))) AS DATE) AS local_day FROM events")
def f09(spark, sf):
    """A UTC time as the date in New York."""
    plain = F.col("ts").cast("timestamp_ntz")
    return S.parquet(spark, sf, "events").select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), plain).cast("date").alias("local_day"))


@query("f16_percent_text", "SELECT p_partkey, CASE WHEN p_size IS NULL THEN 'n/a' ELSE format('{:.1f}%', CAST(p_size AS DOUBLE) * 100 / 8) END AS share FROM part")
def f16(spark, sf):
    return S.parquet(spark, sf, "part").select("p_partkey", F.replace(N.percent_text(F.col("p_size") / 8.0, 1), F.lit(","), F.lit("")).alias("share"))


@query("f17_literals", "SELECT * FROM (VALUES ('12', 'int', '12'), ('1.50', 'float', '1.5'), ('true', 'bool', 'true'), ('None', 'none', NULL), ('abc', 'text', 'abc')) t(raw, kind, value)")
def f17(spark, sf):
    """Values of a command line as the narrowest type that reads them."""
    raw = spark.createDataFrame([(x,) for x in ("12", "1.50", "true", "None", "abc")], "raw string")
    return raw.select("raw", *X.literal("raw"))


# Series, membership, checks

@query("d10_splice_prefixes", sql("""SELECT ticker, count(*) AS n, min(date) AS first, count_if(date >= DATE '1997-06-01')::BIGINT AS own, floor(sum(CASE WHEN date >= DATE '1996-03-01' THEN close ELSE close * 6 END) * 100 + CAST(0.5 AS DOUBLE)) / 100 AS closes
FROM (SELECT *, count_if(date >= DATE '1997-06-01') OVER (PARTITION BY ticker) >= 60 AS enough FROM bars) WHERE date >= DATE '1997-06-01' OR date < DATE '1996-03-01' OR enough GROUP BY 1""", *BRAND))
def d10c(spark, sf):
    """Two prefixes in front of every series: the newer at a quarter of its prices, measured; the older at a third of both, by a declared ratio."""
    b = bars(spark, sf).select("ticker", "date", "close").withColumn("source", F.lit("own"))
    own = b.where("date >= DATE '1997-06-01'")
    new = b.withColumn("close", F.col("close") / 4).withColumn("ticker", F.concat("ticker", F.lit("-new")))
    old = b.where("date < DATE '1996-03-01'").withColumn("close", F.col("close") * 3).withColumn("ticker", F.concat("ticker", F.lit("-old")))
    prefixes = new.where("date >= DATE '1996-03-01'").unionByName(old).withColumn("source", F.lit("x"))
    labels = b.select("ticker").distinct()
    rule = lambda tail, day, k: labels.select("ticker", F.concat("ticker", F.lit(tail)).alias("prefix"), F.lit(day).alias("before"), F.lit(k).cast("double").alias("ratio"))
    rules = rule("-new", dt.date(1997, 6, 1), None).unionByName(rule("-old", dt.date(1996, 3, 1), 2.0))
    got, _ = A.splice_prefixes(own, prefixes, rules)
    return got.groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.count_if(F.col("source") == "own").alias("own"), (F.floor(F.sum("close") * 100 + 0.5) / 100.0).alias("closes"))


_SPIN = """sp AS (SELECT ticker, date, close, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS p0 FROM bars)"""


@query("v02_spinoff_return", sql("SELECT ticker, date, CASE WHEN p0 IS NULL THEN 'UNVERIFIED' WHEN month(date) = 6 THEN 'FAIL' ELSE 'PASS' END AS status FROM sp WHERE day(date) = 15", *BRAND, _SPIN))
def v02(spark, sf):
    """Adjusted returns on spin-off days against the holder's; every June's is wrong by a thousandth."""
    w = by_label()
    x = bars(spark, sf).select("ticker", "date", "close").withColumn("p0", F.lag("close").over(w))
    want = (F.col("close") + F.lit(0.5) * 30.0) / F.col("p0")
    x = x.withColumn("ret", F.when(F.dayofmonth("date") == 15, want + F.when(F.month("date") == 6, 0.001).otherwise(0.0)).otherwise(F.col("close") / F.col("p0")) - 1.0)
    spins = x.where("day(date) = 15").select("ticker", F.col("date").alias("ex_date"), F.col("p0").alias("parent_prev_close"), F.col("close").alias("parent_close"), F.lit(0.5).alias("ratio"), F.lit(30.0).alias("spinco_close"))
    return quality.spinoff_returns(x, spins).select("ticker", F.col("ex_date").alias("date"), "status")


@query("v10_statuses", sql("SELECT ticker, CASE WHEN count(*) < 50 THEN 'UNVERIFIED' WHEN count_if(volume > 90) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM bars GROUP BY 1", *BRAND))
def v10(spark, sf):
    g = bars(spark, sf).groupBy("ticker").agg(F.count("*").alias("n"), F.count_if(F.col("volume") > 90).alias("bad"))
    return g.select("ticker", quality.status(F.col("bad"), F.col("n") >= 50).alias("status"))


@query("v12_yearly_agreement", sql(f"SELECT ticker, year(date) AS year, count(*) AS days, {r('avg(CAST(day(date) % 6 <> 0 AS DOUBLE))')} AS share FROM (SELECT ticker, date, close / lag(close) {L} - 1 AS x FROM bars) WHERE x IS NOT NULL GROUP BY 1, 2", *BRAND))
def v12(spark, sf):
    a = bars(spark, sf).withColumn("x", indicators.returns()).select("ticker", "date", "x")
    b = a.withColumn("x", F.col("x") + F.when(F.dayofmonth("date") % 6 == 0, 0.01).otherwise(0.0))
    return rounded_all(reconcile.agreement(a, b, "x", 0.005, by_year=True).select("ticker", "year", "days", "share"))


@query("v21_best_correlated", sql(f"SELECT a, b, c FROM (SELECT x.ticker AS a, y.ticker AS b, {r('corr(x.close, y.close)')} AS c, count(*) AS n FROM bars x JOIN bars y ON x.date = y.date AND x.ticker <> y.ticker GROUP BY 1, 2 HAVING count(*) >= 20) WHERE c IS NOT NULL AND NOT isnan(c) QUALIFY row_number() OVER (PARTITION BY a ORDER BY c DESC, b) = 1", *BRAND))
def v21(spark, sf):
    """The other label with the highest correlation over the common dates."""
    b = bars(spark, sf).select("ticker", "date", "close")
    return reconcile.best_correlated(b, b, "close", 20, but_itself=True)


_SPELLS = "sl AS (SELECT ticker, min(date) + 1 AS s, max(date) - 1 AS e FROM bars GROUP BY 1), cal AS (SELECT DISTINCT date FROM bars)"


@query("v24_membership_from_spells", sql("""SELECT ticker, (SELECT min(date) FROM cal WHERE date >= greatest(s, DATE '1996-01-01')) AS start, CASE WHEN e >= DATE '1997-12-31' THEN DATE '1998-01-01' ELSE coalesce((SELECT min(date) FROM cal WHERE date > (SELECT max(date) FROM cal WHERE date <= e) AND date < DATE '1998-01-01'), DATE '1998-01-01') END AS "end"
FROM sl WHERE s < DATE '1998-01-01' AND e >= DATE '1996-01-01'""", *BRAND, _SPELLS))
def v24(spark, sf):
    """Spells of a list clipped to a window and moved to trading days."""
    b = bars(spark, sf)
    spells = b.groupBy("ticker").agg(F.date_add(F.min("date"), 1).alias("start"), F.date_sub(F.max("date"), 1).alias("end"))
    return membership.from_spells(spells, b.select("date").distinct(), dt.date(1996, 1, 1), dt.date(1998, 1, 1))


@query("v25_list_reconciliation")
def v25(spark, sf):
    """Joins of one list against the same joins reported up to six days later: each to its nearest, one to one."""
    m = spans(spark, sf).select("ticker", "start")
    a = m.select("ticker", F.col("start").alias("date"), F.lit(1.0).alias("amount"))
    b = m.select("ticker", F.expr("date_add(start, length(ticker) % 7)").alias("date"), F.lit(1.0).alias("amount"))
    return reconcile.audit(a, b, 6, 0.5)


# Simulation

@dataclass
class HalfIn(ledger.Strategy):
    """Half of the money into one label, once."""

    label: str = "Brand#1"
    universe: str = "all"

    def on_rebalance(self, day):
        day.set_weights({self.label: 0.5})


_HALF = """p AS (SELECT date, day, last_value(close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c, close FROM grid WHERE ticker = 'Brand#1'),
g AS (SELECT arg_max(close, date) AS final, max(date) AS last FROM p WHERE close IS NOT NULL),
f AS (SELECT min(date) AS first, 500000 / arg_min(close, date) AS shares, (SELECT final FROM g) AS final, (SELECT last FROM g) AS last, (SELECT min(p.date) FROM p, g WHERE p.date > g.last) AS gone FROM p WHERE close IS NOT NULL AND day >= 1 AND day <= 6)"""
_LEFT = "499500 + f.shares * f.final * CAST(0.999 AS DOUBLE)"


@query("b11_daily_loop", sql(f"SELECT p.date, {r(f'CASE WHEN f.first IS NULL OR p.date < f.first THEN 1000000 WHEN p.date > f.last THEN {_LEFT} ELSE 499500 + f.shares * p.c END', 2)} AS value, {r(f'CASE WHEN f.first IS NULL OR p.date < f.first THEN 1000000 WHEN p.date > f.last THEN {_LEFT} ELSE 499500 END', 2)} AS cash FROM p, f", *GRID, _HALF))
def b11(spark, sf):
    """Ordered on the first day, filled on the next day with a price (at most five days of retries), with a fee of ten basis points, then held to its last price."""
    p = panel(spark, sf).select("ticker", "date", "close")
    first = p.agg(F.min("date")).first()[0]
    e = ledger.equity(ledger.simulate(p, {"half": HalfIn(schedule=[first])}))
    return e.select("date", rounded("value", 2).alias("value"), rounded("cash", 2).alias("cash"))


@query("b06_orders", sql(f"SELECT f.first AS date, 'BUY' AS side, {r('f.shares', 4)} AS shares, CAST(500000 AS DOUBLE) AS value, CAST(500 AS DOUBLE) AS cost FROM f WHERE f.first IS NOT NULL UNION ALL SELECT f.gone, 'DELIST', {r('f.shares', 4)}, {r('f.shares * f.final', 4)}, {r('f.shares * f.final / 1000', 4)} FROM f WHERE f.first IS NOT NULL AND f.gone IS NOT NULL", *GRID, _HALF))
def b06(spark, sf):
    p = panel(spark, sf).select("ticker", "date", "close")
    first = p.agg(F.min("date")).first()[0]
    return rounded_all(ledger.trades(ledger.simulate(p, {"half": HalfIn(schedule=[first])})).select("date", "side", "shares", "value", "cost"), 4)
