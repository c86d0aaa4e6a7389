import os
import sys
from datetime import date

import pandas as pd
import pytest
from helpers import calendar, column, d, series
from pyspark import cloudpickle
from pyspark.sql import functions as F

from barloom import sinks
from barloom.operators.quality import FindingsError
from barloom.plans import generated_run, holding_run, market_run
from barloom.shared import shared_folder
from barloom.sources import (
    fetch_bars,
    load_sources,
    read_series,
    read_symbol_dir,
    read_tagged,
    read_through,
    read_two_header,
    read_wide,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_series_files(spark, tmp_path):
    put(tmp_path, "RATE_2020-01-02_2020-12-31.csv", "Date,Value\n2020-01-02,1.88\n2020-01-03,\n")
    put(tmp_path, "SPREAD_X.csv", "Date,Value\n2020-01-02,3.6\n")
    got = read_series(spark, str(tmp_path)).orderBy("series_id", "date").collect()
    assert [tuple(r) for r in got] == [
        ("RATE", d("2020-01-02"), 1.88), ("RATE", d("2020-01-03"), None),
        ("SPREAD_X", d("2020-01-02"), 3.6),
    ]


def test_wide_file(spark, tmp_path):
    path = put(tmp_path, "wide.csv", (
        "Date,Open_SPY,High_SPY,Low_SPY,Close_SPY,Volume_SPY,Close_^VIX,Value_DGS10\n"
        "2020-01-02 00:00:00-05:00,1,2,0.5,1.5,100,13,1.9\n"
    ))
    got = {r.symbol: r for r in read_wide(spark, path).collect()}
    assert set(got) == {"SPY", "^VIX"}
    assert (got["SPY"].date, got["SPY"].close, got["SPY"].volume) == (d("2020-01-02"), 1.5, 100)
    assert (got["^VIX"].close, got["^VIX"].open) == (13.0, None)


def test_two_header_file(spark, tmp_path):
    path = put(tmp_path, "two.csv", (
        "Ticker,\"(' spy\",\"(' spy\",tlt\nPrice,Close'),Volume'),Close\nDate,,,\n"
        "2020-01-02,10,5,7\n2020-01-03,11,6,8\n"
    ))
    bars = read_two_header(spark, path)
    assert column(bars.where("symbol = 'spy'"), "close", "date") == [10, 11]
    assert column(bars.where("symbol = 'tlt'"), "volume", "date") == [None, None]
    stats = holding_run(path, ["SPY", "close"], 100.0, spark).first()
    assert stats.end_value == pytest.approx(110)
    with pytest.raises(ValueError, match="gld"):
        holding_run(path, "gld", spark=spark)
    assert holding_run(path, spark=spark).count() == 2


def test_symbol_files(spark, tmp_path):
    text = "Date,Open,High,Low,Close,Volume\n2023-01-03,50,50,50,50,10000\n"
    put(tmp_path, "TEST1.csv", text)
    put(tmp_path, "OTHER.csv", text)
    asked = spark.createDataFrame([("TEST1",), ("GONE",)], "symbol string")
    bars, missing = read_symbol_dir(spark, str(tmp_path), asked)
    assert bars.first().asDict() == {
        "symbol": "TEST1", "date": d("2023-01-03"), "open": 50.0, "high": 50.0, "low": 50.0,
        "close": 50.0, "volume": 10000,
    }
    assert [r.symbol for r in missing.collect()] == ["GONE"]


def test_source_list(spark, tmp_path):
    wide = put(tmp_path, "y.csv", "Date,Close_SPY,Close_TLT\n2020-01-02,1,2\n")
    tag = put(tmp_path, "f.csv", "date,ticker,value,data_flag\n2020-01-02,OAS,3.5,actual\n")
    entries = [
        {"type": "yahoo", "tickers": ["SPY"], "file_path": wide},
        {"type": "fred", "ticker": "OAS", "file_path": tag},
        {"type": "fred", "ticker": "OAS", "file_path": str(tmp_path / "none.csv")},
        {"type": "other", "ticker": "OAS", "file_path": tag},
    ]
    got = {r.symbol: r for r in load_sources(spark, entries).collect()}
    assert (got["SPY"].close, got["SPY"].source) == (1.0, "yahoo")
    assert (got["OAS"].value, got["OAS"].data_flag) == (3.5, "actual")
    with pytest.raises(RuntimeError):
        load_sources(spark, entries[2:])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_tagged(spark, str(tmp_path / "none.csv"))


class Provider:
    """Serves a ramp per symbol, fails for BAD, has nothing for VOID, and logs each call."""

    def __init__(self, log, failures=0):
        self.log, self.failures = str(log), failures

    def __call__(self, symbol, start, end):
        with open(self.log, "a") as f:
            f.write(symbol + "\n")
        with open(self.log) as f:
            calls = f.read().split().count(symbol)
        if symbol == "BAD" or calls <= self.failures:
            raise OSError("no answer")
        if symbol == "VOID":
            return pd.DataFrame()
        days = pd.bdate_range(start, end)
        ramp = pd.Series(range(1, len(days) + 1), dtype=float)
        frame = pd.DataFrame({"date": days, "value": ramp, "volume": 7})
        return frame.assign(**dict.fromkeys(["open", "high", "low", "close"], ramp))


def calls(log):
    with open(log) as f:
        return sorted(f.read().split())


def requests(spark, *symbols, end="2020-01-10"):
    return spark.createDataFrame(
        [(s, d("2020-01-06"), d(end)) for s in symbols], "symbol string, start date, end date"
    )


def test_fetch(spark, tmp_path):
    log = tmp_path / "log"
    bars, status = fetch_bars(
        requests(spark, " spy", "BAD", "VOID"), Provider(log), str(tmp_path / "got"), tasks=2
    )
    assert column(bars, "close", "date") == [1, 2, 3, 4, 5]
    assert {r.symbol for r in bars.collect()} == {"SPY"}
    got = {r.symbol: (r.status, r.rows) for r in status.collect()}
    assert got == {"SPY": ("ok", 5), "BAD": ("failed", 0), "VOID": ("empty", 0)}
    assert calls(log) == ["BAD", "SPY", "VOID"]  # three more actions, no further call
    with pytest.raises(RuntimeError, match="any data"):
        fetch_bars(requests(spark, "BAD", "VOID"), Provider(log), str(tmp_path / "none"))


class Untyped(Provider):
    """Answers for ODD with a volume and a date that cannot be typed."""

    def __call__(self, symbol, start, end):
        got = super().__call__(symbol, start, end)
        if symbol == "ODD":
            return got.assign(date="no day", volume=1.5)
        return got.assign(volume=7, extra="x")


def test_answers_that_cannot_be_typed_are_reported(spark, tmp_path):
    bars, status = fetch_bars(
        requests(spark, "SPY", "ODD"), Untyped(tmp_path / "log"), str(tmp_path / "got"),
        arrival=True,
    )
    assert {r.symbol: (r.status, r.rows) for r in status.collect()} == {
        "SPY": ("ok", 5), "ODD": ("failed", 0)
    }
    assert [r.arrival.arrival for r in bars.orderBy("arrival").collect()] == [0, 1, 2, 3, 4]


class InParts(Provider):
    """Answers in frames of two rows; LATE breaks off after the first, as often as it may fail."""

    def __call__(self, symbol, start, end):
        whole = Provider(self.log)(symbol, start, end)
        calls_so_far = calls(self.log).count(symbol)
        for at in range(0, len(whole), 2):
            if symbol == "LATE" and at and calls_so_far <= self.failures:
                raise OSError("broke off")
            yield whole[at : at + 2]


@pytest.mark.parametrize("most", [1000, 0])
def test_answers_in_parts(spark, tmp_path, monkeypatch, most):
    """Rows of attempts that broke off do not count; partitions and rows give the same."""
    from barloom.sources import fetching

    monkeypatch.setattr(fetching, "REQUESTS", most)
    asked = requests(spark, "SPY", "LATE", "VOID").union(requests(spark, None))
    bars, status = fetch_bars(
        asked, InParts(tmp_path / "log", 1), str(tmp_path / "got"), attempts=2, wait=0.01, arrival=True
    )
    for symbol in ("SPY", "LATE"):
        assert column(bars.where(F.col("symbol") == symbol), "close", "arrival") == [1, 2, 3, 4, 5]
    assert {r.symbol: (r.status, r.rows) for r in status.collect()} == {
        "SPY": ("ok", 5), "LATE": ("ok", 5), "VOID": ("empty", 0)
    }
    _, status = fetch_bars(
        requests(spark, "SPY", "LATE"), InParts(tmp_path / "log2", 9), str(tmp_path / "again")
    )
    assert {r.symbol: (r.status, r.rows, r.message) for r in status.collect()} == {
        "SPY": ("ok", 5, ""), "LATE": ("failed", 0, "OSError: broke off")
    }


def test_fetch_format(spark, tmp_path):
    from barloom.sources import fetch_option, register

    register(spark)
    asked = '[["SPY", "2020-01-06", "2020-01-10"], ["BAD", "2020-01-06", "2020-01-10"]]'
    reader = spark.read.format("barloom_fetch").options(
        fetch=fetch_option(Provider(tmp_path / "log")), kind="series", requests=asked
    )
    df = reader.load()
    assert df.rdd.getNumPartitions() == 2  # one per request
    assert reader.option("tasks", 1).load().rdd.getNumPartitions() == 1
    rows = df.collect()
    assert sorted(r.value for r in rows if r.status is None) == [1, 2, 3, 4, 5]
    assert {(r.symbol, r.status, r.rows) for r in rows if r.status} == {("SPY", "ok", 5), ("BAD", "failed", 0)}
    assert reader.option("requests", "[]").load().count() == 0


def test_fetch_tries_again(spark, tmp_path):
    log = tmp_path / "log"
    bars, _ = fetch_bars(
        requests(spark, "SPY"), Provider(log, 2), str(tmp_path / "got"), attempts=3, wait=0.01
    )
    assert bars.count() == 5 and calls(log) == ["SPY"] * 3


def test_read_through(spark, tmp_path):
    log, landed = tmp_path / "log", str(tmp_path / "landed")
    first = read_through(requests(spark, "OAS", "VOID"), Provider(log), landed)
    assert column(first, "value", "date") == [1, 2, 3, 4, 5]
    both = read_through(
        requests(spark, "OAS", "VOID").union(requests(spark, "OAS", end="2020-01-07")),
        Provider(log), landed,
    )
    assert column(both, "value", "date")[:5] == [1, 2, 3, 4, 5]
    assert both.count() == both.select("date").distinct().count()  # shared days come once
    assert calls(log) == ["OAS", "OAS", "VOID", "VOID"]
    with pytest.raises(RuntimeError, match="BAD"):
        read_through(requests(spark, "BAD", "NEW"), Provider(log), landed, wait=0.01)
    assert calls(log).count("BAD") == 3
    read_through(requests(spark, "NEW"), Provider(log), landed)
    assert calls(log).count("NEW") == 1  # landed although its neighbour failed


def test_dual_and_checked(spark, tmp_path):
    df = series(spark, ("2020-01-01", 1.0), ("2020-01-02", None)).withColumn("Unnamed: 0", F.lit(1))
    kept = sinks.write_checked(df, str(tmp_path), "m")
    assert kept.columns == ["series_id", "date", "value"]
    text = spark.read.option("header", True).csv(str(tmp_path / "m.csv"))
    assert text.columns == kept.columns and text.count() == kept.count() == 2
    with pytest.raises(FindingsError, match="'a'"):
        sinks.write_checked(df.toDF("a", "b", "a", "c"), str(tmp_path), "n")


def test_by_alias(spark, tmp_path):
    rows = [("A B", d("2020-01-01"), 1.0), ("C", d("2020-01-01"), 2.0)]
    df = spark.createDataFrame(rows, "alias string, date date, close double")
    sinks.write_by_alias(df, str(tmp_path / "out"))
    assert {p for p in os.listdir(tmp_path / "out") if "=" in p} == {"alias=A B", "alias=C"}
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "alias=C"))
    assert back.columns == ["Date", "close"]


def test_table(spark, tmp_path):
    df = series(spark, ("2020-01-01", 1.0), ("2020-01-02", 2.0)).select(
        F.col("value").cast("string").alias("value"), "date", F.lit("x").alias("extra")
    )
    sinks.replace_table(df, "synthetic_cash", str(tmp_path / "t"))
    sinks.replace_table(df, "synthetic_cash", str(tmp_path / "t"))
    stored = spark.table("synthetic_cash")
    assert [tuple(f) for f in stored.dtypes] == [("date", "date"), ("value", "double")]
    assert stored.count() == 2
    with pytest.raises(FindingsError, match="repeated key"):
        sinks.replace_table(df.union(df), "synthetic_cash", str(tmp_path / "t"))
    assert spark.table("synthetic_cash").count() == 2
    found = sinks.write_and_reconcile(df, "free", str(tmp_path / "c"), str(tmp_path / "f"))
    assert found.isEmpty() and spark.table("free").columns == ["value", "date", "extra"]


@pytest.mark.parametrize("external", [True, False])
def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, external):
    name, path = f"kept_{external}", str(tmp_path / "t") if external else None
    rows = spark.range(100).withColumn("v", F.col("id") * 2)
    sinks.replace_table(rows, name, path)
    broken = rows.repartition(4).withColumn(
        "v", F.when(F.col("id") == 77, F.raise_error(F.lit("halfway"))).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="halfway"):
        sinks.replace_table(broken, name, path)
    assert spark.table(name).agg(F.sum("v")).first()[0] == 9900
    # A replacement may be made from the table itself, and have another layout.
    sinks.replace_table(spark.table(name).where("id < 10").select("id", F.lit("x").alias("w")), name, path)
    assert spark.table(name).columns == ["id", "w"] and spark.table(name).count() == 10
    assert not [t.name for t in spark.catalog.listTables() if "__" in t.name and "kept" in t.name]
    if external:
        assert len(os.listdir(path)) == 1  # the rows of the tables replaced are gone


def test_order_is_checked_across_blocks(spark, tmp_path):
    """A file read in many blocks: falls inside a block and at the edge of one are named."""
    from barloom.operators.quality import check_ohlcv
    from barloom.track import Track

    days = [str(date(2020, 1, 1) + pd.Timedelta(days=i)) for i in range(400)]
    days[123], days[250] = days[250], "2019-01-01"
    put(tmp_path, "S.csv", "Date,Open,High,Low,Close,Volume\n" + "".join(f"{x},1,1,1,1,1\n" for x in days))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for block in ("200b", "333b", size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            bars, _ = read_symbol_dir(spark, str(tmp_path), stored=True)
            place = Track(
                ("symbol", "stored_file"), ("stored_block", "stored_row"), F.col("stored_block")
            )
            falls = {r.detail for r in check_ohlcv(bars, place).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert falls == {"date falls to 2020-05-04", "date falls to 2019-01-01"}


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda key, default=None: default)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_market_run(spark, tmp_path):
    ranges = spark.createDataFrame(
        [("spy", d("2020-01-01"), d("2020-01-12")), ("tlt", d("2020-01-07"), d("2020-01-12"))],
        "symbol string, start date, end date",
    )
    one = ranges.where("symbol = 'spy'").withColumn("symbol", F.lit("OAS"))
    out = market_run(
        ranges, one, ["OAS"], calendar(spark, "2020-01-01", "2020-01-31"),
        Provider(tmp_path / "log"), Provider(tmp_path / "log"), str(tmp_path / "run"),
    )
    assert out.columns[-1] == "Value_OAS"
    assert out.count() == 14  # both symbols on the seven sessions either has
    late = out.where("symbol = 'TLT'").orderBy("date").collect()
    assert late[0].date == date(2020, 1, 2) and late[0].close == 1.0
    assert os.path.isdir(tmp_path / "run" / "merged_data.csv")
    wide = market_run(
        ranges, one, ["OAS"], calendar(spark, "2020-01-01", "2020-01-31"),
        Provider(tmp_path / "log"), Provider(tmp_path / "log"), str(tmp_path / "wide"),
        ["SPY", "TLT"],
    )
    assert wide.count() == 7
    assert {"Close_SPY", "Volume_TLT", "Value_OAS"} < set(wide.columns)
    assert column(wide, "Close_TLT", "date") == [1, 1, 1, 1, 2, 3, 4]


def test_generated_run(spark, tmp_path):
    spec = spark.createDataFrame(
        [("T1", d("2023-01-01"), d("2023-01-10"), "linear", 100.0, 1.0),
         ("T2", d("2023-01-01"), d("2023-01-02"), "cash", 50.0, None)],
        "symbol string, start date, end date, data_type string, start_value double, "
        "growth_rate double",
    )
    asked = spark.createDataFrame([("T1",), ("T2",), ("T3",)], "symbol string")
    s = series(spark, ("2023-01-03", 1.5), ("2023-01-04", None), ("2023-01-05", 2.5))
    bars, skipped = generated_run(
        asked, spec, calendar(spark, "2023-01-01", "2023-12-31"), s, str(tmp_path / "g")
    )
    assert column(bars.where("symbol = 'T1'"), "close", "date") == [100, 101, 102, 103, 104, 105]
    assert column(bars.where("symbol = 'S'"), "close", "date") == [1.5, 2.0, 2.5]
    assert {tuple(r) for r in skipped.collect()} == {
        ("T3", "no settings"), ("T2", "no sessions in range")
    }


def test_metrics_json(spark, tmp_path):
    from barloom.operators import risk

    rows = [(s, date(2020, 1, i + 1), 10.0 + i * k) for s, k in (("A", 1), ("B", 2))
            for i in range(5)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close double")
    report = risk.metrics_report(bars, ["A"], ["A", "B"])
    sinks.write_metrics_json(report, ["A", "B"], str(tmp_path / "j"))
    got = spark.read.json(str(tmp_path / "j")).collect()
    assert len(got) == 1
    assert got[0].metadata.ticker == "A" and got[0].metadata.benchmarks == ["A", "B"]
    assert [c.benchmark for c in got[0].benchmark_comparison] == ["A", "B"]


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/")


def test_wide_files_are_read_by_their_own_headers(spark, tmp_path):
    put(tmp_path, "a.csv", 'Date,Open_A,"Close_A",Close_B\n2020-01-02,1,"2",9\nDate,Open_A,"Close_A",Close_B\n')
    put(tmp_path, "b.csv", "Date,Close_A,Open_A\n2020-01-03,3,4\nnever,5,6\n")
    got = read_wide(spark, str(tmp_path)).collect()
    assert {(r.symbol, r.date, r.open, r.close) for r in got} == {
        ("A", d("2020-01-02"), 1, 2), ("B", d("2020-01-02"), None, 9), ("A", d("2020-01-03"), 4, 3),
        ("A", None, 6, 5),
    }


def test_two_header_files_are_read_by_their_own_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "Ticker,AAA,BBB\nPrice,Close,Close\n2020-01-02,1,2\n,3,3\n")
    put(tmp_path, "b.csv", "Ticker,BBB,AAA,AAA\nPrice,Close,Close,Open\n2020-01-03,3,4,5\n")
    got = read_two_header(spark, str(tmp_path)).collect()
    assert {(r.symbol, r.date, r.open, r.close) for r in got} == {
        ("AAA", d("2020-01-02"), None, 1), ("BBB", d("2020-01-02"), None, 2),
        ("AAA", d("2020-01-03"), 5, 4), ("BBB", d("2020-01-03"), None, 3),
    }


def test_files_without_a_header_take_the_one_that_all_others_have(spark, tmp_path):
    put(tmp_path, "head.csv", "Ticker,AAA,BBB\nPrice,Close,Close\n")
    put(tmp_path, "body.csv", "2020-01-02,1,2\n2020-01-03,3,4\n")
    assert read_two_header(spark, str(tmp_path)).count() == 4
    put(tmp_path, "other.csv", "Ticker,BBB,AAA\nPrice,Close,Close\n2020-01-04,5,6\n")
    with pytest.raises(Exception, match="no header for .*body.csv"):
        read_two_header(spark, str(tmp_path)).collect()


def test_only_header_lines_are_looked_at(spark, tmp_path):
    from barloom.operators.quality import check_header_lines

    put(tmp_path, "a.csv", "Date,X,Y,X\n2020-01-01,1,2,3\n,3,3\n,4,4\n")
    put(tmp_path, "b.csv", "2020-01-01,1,1\n,7,7\n")
    put(tmp_path, "c.csv", '\nDate,"A,B","A,B"\n,5,5\n')
    found = {(r.file[-5:], r.column_name, r.n_uses) for r in check_header_lines(spark, str(tmp_path)).collect()}
    assert found == {("a.csv", "X", 2), ("c.csv", "A,B", 2)}
