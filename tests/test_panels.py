"""Point-in-time joins, membership, series construction and text helpers on hand-made rows."""

import datetime as dt

import pytest

from chronopanel.functions import numeric as N
from chronopanel.functions import text as X
from chronopanel.operators import adjust as A
from chronopanel.operators import cross_section as C
from chronopanel.operators import grid, membership, pit, quality, reconcile
from chronopanel.sources import tables as S


def d(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_interval_edges(spark):
    b = spark.createDataFrame([("A", d(k)) for k in range(6)] + [("R", d(1))], "ticker string, date date")
    s = spark.createDataFrame([("A", d(1), d(3)), ("A", d(2), d(4)), ("A", d(5), None)], "ticker string, start date, end date")
    assert rows(pit.members_on(b, s)) == [("A", d(1)), ("A", d(2)), ("A", d(3)), ("A", d(5))]
    assert pit.join_intervals(b, s).where(f"date = DATE '{d(2)}'").count() == 2


def test_snapshots_and_intervals_round_trip(spark):
    snaps = [(d(0), "A"), (d(0), "B"), (d(5), "A"), (d(9), "A"), (d(9), "B"), (d(12), "B")]
    df = spark.createDataFrame(snaps, "date date, ticker string")
    spans = pit.snapshots_to_intervals(df)
    assert rows(spans.select("ticker", "start", "end")) == [("A", d(0), d(12)), ("B", d(0), d(5)), ("B", d(9), None)]
    assert set(rows(pit.intervals_to_snapshots(spans, df))) == set(snaps)
    assert rows(pit.member_changes(df)) == [(d(5), "B", -1), (d(9), "B", 1), (d(12), "A", -1)]


def test_as_of(spark):
    left = spark.createDataFrame([("k", d(0), 1), ("k", d(3), 2), ("k", d(4), 3), ("z", d(4), 4)], "k string, at date, id int")
    right = spark.createDataFrame([("k", d(3), "x"), ("k", d(1), "w")], "k string, t date, v string")
    assert [(r["id"], r["v"]) for r in grid.as_of(left, right, ["k"], "at", "t", ["v"]).orderBy("id").collect()] == [(1, None), (2, "x"), (3, "x"), (4, None)]
    assert [(r["id"], r["v"]) for r in grid.as_of(left, right, ["k"], "at", "t", ["v"], strict=True).orderBy("id").collect()] == [(1, None), (2, "w"), (3, "x"), (4, None)]


def test_rank_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 3.0), ("d", 2.0), ("e", None)], "ticker string, v double").selectExpr("DATE '2024-01-01' AS date", "*")
    assert [r[0] for r in df.select("ticker", C.average_rank("v").alias("r")).orderBy("ticker").select("r").collect()] == [1.5, 4.0, 1.5, 3.0, None]
    assert [r["ticker"] for r in C.top(df, "v", 2).orderBy("place").collect()] == ["a", "c"]


def bar(spark, items):
    return spark.createDataFrame(items, "ticker string, date date, close double, dividends double, stock_splits double, raw boolean")


def test_back_adjustment(spark):
    df = bar(spark, [("A", d(0), 100.0, 0.0, 0.0, True), ("A", d(1), 50.0, 0.0, 2.0, True), ("A", d(2), 49.0, 1.0, 0.0, True), ("Y", d(0), 100.0, 0.0, 0.0, False), ("Y", d(1), 50.0, 0.0, 2.0, False), ("J", d(0), 10.0, 0.0, 0.0, True), ("J", d(1), 10.0, 5.0, 0.0, True)])
    got = {(r["ticker"], r["date"]): r["adj_close"] for r in A.back_adjust(df).collect()}
    assert got["A", d(0)] == pytest.approx(100 / 2 * 0.98) and got["A", d(1)] == pytest.approx(49.0) and got["A", d(2)] == 49.0
    assert got["Y", d(0)] == 100.0 and got["J", d(0)] == 10.0


def test_history_is_cut_at_a_bad_factor(spark):
    df = bar(spark, [("A", d(0), 10.0, 0.0, 0.0, True), ("A", d(1), 10.0, 0.0, -2.0, True), ("A", d(2), 10.0, 0.0, 0.0, True)])
    assert [r["date"] for r in A.back_adjust(df).collect()] == [d(2)]


def test_basis_ignores_patches(spark):
    df = spark.createDataFrame([("A", "tiingo"), ("A", "yahoo-patch"), ("A", "yahoo-patch"), ("B", "yahoo")], "ticker string, source string")
    assert {r["ticker"]: r["raw"] for r in A.basis(df, ["tiingo"]).collect()} == {"A": True, "B": False}


def test_patches(spark):
    df = spark.createDataFrame([("A", d(0), 100.0, "s"), ("A", d(2), 100.0, "s"), ("A", d(3), 100.0, "s")], "ticker string, date date, close double, source string")
    p = spark.createDataFrame([("A", d(1), 99.0, "fill", None), ("A", d(0), 104.0, "replace", None), ("A", d(2), 106.0, "replace", None), ("A", d(3), 120.0, "replace_close", 0.3)], "ticker string, date date, close double, action string, max_move double")
    assert [r["close"] for r in A.patch_prices(df, p).orderBy("date").collect()] == [104.0, 99.0, 100.0, 120.0]


@pytest.mark.parametrize("n,ok", [(59, False), (60, True)])
def test_splice_needs_overlap(spark, n, ok):
    own = spark.createDataFrame([("A", d(k), 10.0) for k in range(100, 100 + n)], "ticker string, date date, close double")
    old = spark.createDataFrame([("A", d(k), 5.0) for k in range(100 + n)], "ticker string, date date, close double")
    assert A.splice_check(own, old).first()["accepted"] is ok
    got = A.splice(own, old)
    assert got.count() == (100 + n if ok else n) and (not ok or got.where("close <> 10").count() == 0)


def test_filler_tail(spark):
    items = [("A", d(k), 1.0, 1.0, 1.0, 1.0, 5.0 if k < 3 else 0.0) for k in range(50)] + [("B", d(k), 1.0, 1.0, 1.0, 1.0, 5.0 if k < 45 else 0.0) for k in range(50)]
    df = spark.createDataFrame(items, "ticker string, date date, open double, high double, low double, close double, volume double")
    n = {r["ticker"]: r["count"] for r in A.trim_filler(df).groupBy("ticker").count().collect()}
    assert n == {"A": 3, "B": 50}


def test_exit_gap_bounds(spark):
    b = spark.createDataFrame([("A", d(0), 100.0), ("A", d(5), 74.0), ("B", d(0), 100.0), ("B", d(4), 50.0), ("C", d(0), 100.0), ("C", d(6), 75.0)], "ticker string, date date, close double")
    ends = spark.createDataFrame([(t, d(1)) for t in "ABC"], "ticker string, removed date")
    assert [r["ticker"] for r in A.exit_gaps(b, ends).collect()] == ["A"]


def test_membership_edits(spark):
    s = spark.createDataFrame([("A", d(0), d(10)), ("A", d(20), None), ("B", d(0), d(5))], "ticker string, start date, end date")
    rule = lambda t, k: spark.createDataFrame([(t, d(k))], "ticker string, day date")
    assert rows(membership.edit_spans(s, hold_until=rule("B", 9), start_late=rule("A", 3))) == [("A", d(3), d(10)), ("A", d(20), None), ("B", d(0), d(9))]
    none = spark.createDataFrame([], "ticker string, date date")
    assert rows(membership.bridge_gaps(s, none)) == [("A", d(0), None), ("B", d(0), d(5))]
    kept = spark.createDataFrame([("A", d(10))], "ticker string, date date")
    assert membership.bridge_gaps(s, kept).count() == 3


def test_rename_chains_and_cycles(spark):
    """Against following each label by itself: a long chain, cycles, labels that lead into them, self-renames."""
    pairs = [(f"c{k:03}", f"c{k + 1:03}") for k in range(70)] + [("A", "B"), ("B", "A"), ("R", "S"), ("S", "T"), ("T", "R"), ("X", "Y"), ("Y", "S"), ("Q", "Q"), ("c050", "c051")]
    step = {a: b for a, b in pairs if a != b}
    want = {}
    for a in step:
        seen, x = [a], step[a]
        while x not in seen:
            seen.append(x)
            if x not in step:
                break
            x = step[x]
        want[a] = seen[-1]
    got = {r["old"]: r["new"] for r in membership.rename_closure(spark.createDataFrame(pairs, "old string, new string")).collect()}
    assert got == want and want["c000"] == "c070" and want["X"] == "R"
    assert membership.rename_closure(spark.createDataFrame([], "old string, new string")).count() == 0



def test_audit_statuses(spark):
    a = spark.createDataFrame([("A", d(0), 1.0), ("A", d(10), 1.0), ("A", d(20), 1.0), ("A", d(40), 1.0)], "ticker string, date date, amount double")
    b = spark.createDataFrame([("A", d(0), 1.0), ("A", d(12), 1.0), ("A", d(20), 2.0), ("A", d(60), 1.0)], "ticker string, date date, amount double")
    assert sorted(r["status"] for r in reconcile.audit(a, b, 5, 0.01).collect()) == ["amount", "date", "extra", "match", "missing"]


def test_structure_checks(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 6), 1.0, 2.0, 3.0, 1.0), ("A", dt.date(2024, 1, 6), 1.0, 2.0, 0.5, -1.0)], "ticker string, date date, open double, high double, low double, close double")
    assert {r["check"]: r["status"] for r in quality.structure(df).collect()} == {"duplicates": "FAIL", "weekend": "FAIL", "not_positive": "FAIL", "ohlc": "FAIL", "no_close": "PASS"}
    assert {r["status"] for r in quality.structure(df.limit(0)).collect()} == {"UNVERIFIED"}


def test_functions(spark):
    df = spark.createDataFrame([("The Foo-Bar Corp.", "<p>a&amp;b</p><script>x<y</script> c")], "n string, h string")
    r = df.select(X.normal_name("n").alias("n"), X.plain_text("h").alias("h"), N.number(N.F.lit("$1,200")).alias("x"), X.similarity(N.F.lit("abcd"), N.F.lit("abce")).alias("s")).first()
    assert tuple(r) == ("foo bar", "a&b c", 1200.0, 0.75)
    assert spark.range(1).select(N.nearest_ratio(N.F.lit(1.98))).first()[0] == 2.0


def test_html_tables(spark):
    df = spark.createDataFrame([(1, "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td><b>2</b></td></tr></table>")], "id int, html string")
    assert [r["text"] for r in S.html_tables(df, "html", ["id"]).orderBy("row", "col").collect()] == ["A", "B", "1", "2"]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("B", d(0), 1.5), ("A", d(1), 2.5)], "ticker string, date date, close double")
    S.write_prices(df, str(tmp_path / "p"))
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == rows(df)
    S.write_csv(df, str(tmp_path / "c"))
    assert rows(S.csv(spark, str(tmp_path / "c"), "ticker string, date date, close double")) == rows(df)
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "ticker,close\nA,1.5\nB,2\n")
    assert rows(S.zipped_csv(spark, str(tmp_path / "z.zip"), "m.csv", "ticker string, close double")) == [("A", 1.5), ("B", 2.0)]
    df.where("ticker = 'A'").coalesce(1).write.parquet(str(tmp_path / "f"))
    assert S.labelled_files(spark, str(tmp_path / "f")).first()["label"].startswith("part-")


def test_filters_reach_the_scan(spark, sf):
    plan = S.parquet(spark, sf, "lineitem", ["l_orderkey"], "l_quantity >= 45")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_quantity,45" in plan and "l_comment" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_one_exchange_for_all_windows(spark, sf):
    from chronopanel.operators import indicators as I
    from chronopanel.sources.bars import user_day

    p = grid.dense(user_day(spark, sf)).repartition("ticker")
    q = p.select("ticker", "date", I.sma(5), I.rolling_high(8), I.returns(2))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(ticker") <= 2


def test_streaming_bars(spark, sf, tmp_path):
    from chronopanel.streaming.bars import hourly_bars, replay

    got = replay(spark, sf, hourly_bars)
    assert got.count() > 0 and {"ticker", "open", "high", "low", "close", "n"} <= set(got.columns)


def test_splice_rules(spark):
    """Refusal, a tolerance of a row's own, a declared ratio, own rows that give way, and newest first, all price columns scaled."""
    kind = "ticker string, date date, open double, close double, dividends double, source string"
    own = [(t, d(100 + k), 10.0, 10.0, 0.0, "y") for t in "ABCE" for k in range(80)] + [("E", d(99), 7.0, 7.0, 0.0, "y")]
    pre = [("pA", d(k), 5.0, 5.0, 1.0, "c") for k in range(180)]
    pre += [("pB", d(k), 5.0, 5.0 + 0.02 * (k % 7), 1.0, "c") for k in range(180)] + [("pC", d(k), 2.0, 2.0, 0.5, "c") for k in range(100)] + [("oA", d(k), 1.0, 1.0, 0.0, "c") for k in range(60)]
    pre += [("pE", d(k), 5.0, 5.0, 0.0, "c") for k in range(180)]
    rules = [("A", "pA", d(100), None, None, None), ("A", "oA", d(50), None, 3.0, None), ("B", "pB", d(100), None, None, None), ("C", "pC", d(100), None, 4.0, None), ("E", "pE", d(100), None, None, True)]
    rule = spark.createDataFrame(rules, "ticker string, prefix string, before date, tol double, ratio double, drop_own boolean")
    out, said = A.splice_prefixes(spark.createDataFrame(own, kind), spark.createDataFrame(pre, kind), rule)
    got = {}
    for r in out.collect():
        got.setdefault(r["ticker"], {})[r["date"]] = r
    assert {(r["ticker"], r["prefix"]): r["accepted"] for r in said.collect()} == {("A", "pA"): True, ("A", "oA"): True, ("B", "pB"): False, ("C", "pC"): True, ("E", "pE"): True}
    assert len(got["A"]) == 180 and got["A"][d(60)]["open"] == 10.0 and got["A"][d(60)]["dividends"] == 2.0 and got["A"][d(60)]["source"] == "c-splice" and got["A"][d(100)]["source"] == "y"
    assert got["A"][d(20)]["close"] == 10.0  # the newer prefix has these days already
    assert len(got["B"]) == 80 and got["C"][d(0)]["close"] == 8.0 and got["E"][d(99)]["close"] == 10.0
    loose = rule.withColumn("tol", N.F.lit(0.1))
    assert A.splice_prefixes(spark.createDataFrame(own, kind), spark.createDataFrame(pre, kind), loose)[0].where("ticker = 'B'").count() == 180


def test_patches_keep_sources(spark):
    rows_ = spark.createDataFrame([("A", d(0), 10.0, "y"), ("A", d(1), 10.0, "y"), ("A", d(3), 10.0, "z")], "ticker string, date date, close double, source string")
    patches = spark.createDataFrame([("A", d(2), 11.0, "fill", None, None), ("A", d(0), 10.1, "replace", None, "w"), ("A", d(1), 20.0, "replace_close", None, None), ("A", d(3), 12.0, "replace_close", 0.3, None)], "ticker string, date date, close double, action string, max_move double, source string")
    got = {r["date"]: (r["close"], r["source"]) for r in A.patch_prices(rows_, patches).collect()}
    assert got == {d(0): (10.1, "w-patch"), d(1): (10.0, "y"), d(2): (11.0, "y-patch"), d(3): (12.0, "z-patch")}


def test_spinoff_check_is_three_valued(spark):
    r_ = spark.createDataFrame([("A", d(1), 0.15), ("B", d(1), 0.2)], "ticker string, date date, ret double")
    s = spark.createDataFrame([("A", d(1), 100.0, 80.0, 0.5, 30.0, 20.0), ("A", d(1), 100.0, 80.0, 1.0, 0.0, 20.0), ("B", d(1), 100.0, 80.0, 0.5, 30.0, 0.0), ("C", d(1), 100.0, 80.0, 0.5, 30.0, 0.0)], "ticker string, ex_date date, parent_prev_close double, parent_close double, ratio double, spinco_close double, cash double")
    assert {x["ticker"]: x["status"] for x in quality.spinoff_returns(r_.replace(0.15, 0.15), s).collect()} == {"A": "PASS", "B": "FAIL", "C": "UNVERIFIED"}


def test_list_against_brute_force(spark):
    from chronopanel.operators import reconcile

    rng = __import__("random").Random(3)
    a = sorted({(rng.choice("AB"), rng.randint(0, 60)) for _ in range(25)})
    b = sorted({(rng.choice("AB"), rng.randint(0, 60)) for _ in range(25)})
    frame = lambda x: spark.createDataFrame([(t, d(k), 1.0) for t, k in x], "ticker string, date date, amount double")
    free_a, free_b, want = set(a), set(b), set()
    for _, x, y in sorted((abs(x[1] - y[1]), x, y) for x in a for y in b if x[0] == y[0] and abs(x[1] - y[1]) <= 6):
        if x in free_a and y in free_b:
            free_a.remove(x), free_b.remove(y), want.add((x[0], d(x[1]), d(y[1])))
    got = reconcile.audit(frame(a), frame(b), 6, 0.5)
    assert {(r["ticker"], r["date"], r["other"]) for r in got.where("date IS NOT NULL AND other IS NOT NULL").collect()} == want
    assert got.where("status = 'extra'").count() == len(free_a) and got.where("status = 'missing'").count() == len(free_b)
