"""The command line and the report of a run."""

from chronopanel import __main__ as cli
from chronopanel.operators import report
from chronopanel.plans.shared import bars, spans

FILE = '''
from dataclasses import dataclass
from chronopanel.operators.ledger import Strategy

@dataclass
class Best(Strategy):
    n: int = 3
    def signals(self):
        return {"r": ("returns", 5)}
    def on_rebalance(self, day):
        day.equal_weight(day.top(day.signal("r"), self.n))
'''


def test_command_line(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    (tmp_path / "s.py").write_text(FILE)
    bars(spark, sf).write.parquet(str(tmp_path / "bars"))
    spans(spark, sf).write.parquet(str(tmp_path / "spans"))
    args = [str(tmp_path / "s.py"), "--bars", str(tmp_path / "bars"), "--spans", str(tmp_path / "spans"), "--set", "benchmark=Brand#1", "--sweep", "n=2,4", "--events", str(tmp_path / "e"), "--html", str(tmp_path / "p.html")]
    text = cli.main(args, spark)
    assert "n=2" in text and "CAGR" in text and "beta" in text and "largest fall from" in text
    page = (tmp_path / "p.html").read_text()
    assert page.count("<polyline") == 2 and "Sharpe" in page
    held = spark.read.parquet(str(tmp_path / "e")).where("kind = 'holding'").groupBy("run", "date").count()
    most = {r["run"]: r["n"] for r in held.groupBy("run").agg({"count": "max"}).toDF("run", "n").collect()}
    assert most["n=2"] <= 3 and 2 < most["n=4"] <= 5


def test_values_and_figures():
    assert [cli.value(x) for x in ("3", "0.5", "True", "None", "weekly", "[1, 2]")] == [3, 0.5, True, None, "weekly", [1, 2]]
    assert report.percent(None) == report.number(float("nan")) == "n/a" and report.percent(0.1234, 1) == "12.3%" and report.number(-1.005, 1) == "-1.0"
