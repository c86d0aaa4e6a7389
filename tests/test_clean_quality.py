import pytest
from helpers import closes, column, d, series
from pyspark.sql import functions as F

from barloom.functions import day, day_in_zone, flatten_header, normalize_symbol, strip_header, to_number
from barloom.operators import clean, quality
from barloom.track import Track


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


def test_text_functions(spark):
    assert one(spark, normalize_symbol, " spy ") == "SPY"
    assert one(spark, strip_header, "(' spy") == "spy"
    assert one(spark, strip_header, "Close')") == "Close"
    assert one(spark, lambda c: flatten_header(c, F.lit("Close")), "SPY") == "spy_close"
    assert one(spark, lambda c: flatten_header(c, F.lit("")), "Date") == "date"


@pytest.mark.parametrize("text,value", [
    ("1.5", 1.5), ("abc", None), ("", None), ("NaN", None), ("1d", None), ("-2e3", -2000.0),
    (" 7 ", 7.0), ("inf", float("inf")),
])
def test_to_number(spark, text, value):
    assert one(spark, to_number, text) == value


@pytest.mark.parametrize("text,value", [
    ("2020-01-02", "2020-01-02"), ("2020-01-02 23:30:00-05:00", "2020-01-02"),
    ("2020-01-02T10:00:00", "2020-01-02"), ("n/a", None), ("2020-02-30", None),
])
def test_day(spark, text, value):
    assert one(spark, day, text) == (value and d(value))


def test_series_to_ohlcv(spark):
    s = series(spark, ("2023-01-01", 3.0), ("2023-01-02", 3.1), ("2023-01-03", 3.2))
    live = clean.series_to_ohlcv(s)
    assert live.columns == ["symbol", "date", "open", "high", "low", "close", "volume", "value"]
    assert column(live, "close", "date") == column(live, "open", "date") == [3.0, 3.1, 3.2]
    assert "value" not in clean.repaired_series_to_ohlcv(s).columns


def test_wide_and_column_choice(spark):
    flat = spark.createDataFrame([(d("2020-01-01"), 1.0, 2.0, 9)],
                                 "date date, spy_open double, spy_close double, spy_volume int")
    assert clean.column_of_symbol(flat, "SPY").columns == ["spy_volume"]
    with pytest.raises(ValueError, match="TLT"):
        clean.column_of_symbol(flat, "TLT")
    wide = clean.to_wide(closes(spark, "^VIX", ("2020-01-01", 3)), ["^VIX"], ["close"])
    assert wide.columns == ["date", "Close_^VIX"]


def test_targets(spark):
    bars = clean.cast_ohlcv(
        closes(spark, "spy", ("2020-01-01", 3)).selectExpr(
            "symbol", "date", "close open", "close high", "close low", "close", "'5' volume"
        )
    )
    assert clean.target_series(bars, "SPY").first().value == 3.0
    assert clean.target_series(bars, ("spy", "close")).count() == 1
    with pytest.raises(ValueError, match="spread"):
        clean.target_series(bars, ("spy", "spread"))
    with pytest.raises(KeyError, match="target_asset"):
        clean.target_of({"parameters": {}})
    asked = spark.createDataFrame([("SPY", "Close"), ("S", "P")], "symbol string, field string")
    assert [tuple(r) for r in quality.check_targets(asked, bars).collect()] == [("s", "p")]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    assert clean.drop_duplicate_columns(df).first().asDict() == {"a": 1, "b": 2}
    assert clean.drop_unnamed(df.toDF("a", "Unnamed: 0", "c")).columns == ["a", "c"]
    found = quality.check_duplicate_columns(spark, ["a", "b", "a", "a"])
    assert [r.subject for r in found.collect()] == ["a"]
    with pytest.raises(quality.FindingsError, match="'a'"):
        quality.assert_clean(found)


def test_ranges_and_aliases(spark):
    rows = [("2020-02-01", "2020-01-01"), ("2020-13-01", "current"), ("2020-01-01", "current"),
            (None, None), ("2020-1-2", "2020-01-03"), ("2020-01-01", "soon")]
    found = quality.check_ranges(spark.createDataFrame(rows, "start string, end string"))
    assert {(r.start, r.finding) for r in found.collect()} == {
        ("2020-02-01", "start after end"), ("2020-13-01", "start is no date"),
        ("2020-01-01", "end is no date"),
    }
    rows = [("one", "A", "X"), ("two", "B", "X"), ("two", "C", "Y")]
    found = quality.check_aliases(
        spark.createDataFrame(rows, "source string, symbol string, alias string")
    )
    assert [tuple(r) for r in found.collect()] == [("X", 2)]


def test_request_defaults(spark):
    rows = [("A", None, None), ("B", "2021-01-01", "current"), ("C", "2021-01-01", "2021-02-01")]
    df = spark.createDataFrame(rows, "symbol string, start string, end string")
    got = {r.symbol: r for r in clean.resolve_requests(df).collect()}
    today = spark.sql("SELECT current_date()").first()[0]
    assert (got["A"].start, got["A"].end) == (d("2020-01-01"), today)
    assert got["B"].end == today and got["C"].end == d("2021-02-01")


def test_counts_and_profiles(spark):
    a, b = spark.range(3), spark.range(4)
    assert quality.reconcile_counts(x=a, y=a).count() == 0
    assert {tuple(r) for r in quality.reconcile_counts(x=a, y=b).collect()} == {("x", 3), ("y", 4)}
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b double")
    profile = {r.column_name: r for r in quality.missing_profile(df).collect()}
    assert (profile["a"].all_missing, profile["b"].all_missing) == (False, True)
    assert [r[0] for r in quality.check_numeric(df, ["a", "b"]).collect()] == ["b"]


def test_ohlcv_check(spark):
    good = spark.createDataFrame(
        [("A", d("2020-01-01"), 1.0, 1.0, 1.0, 1.0, 5, 0)],
        "symbol string, date date, open double, high double, low double, close double, "
        "volume bigint, pos int",
    )
    track = Track(("symbol",), ("pos",))
    assert quality.check_ohlcv(good, track).isEmpty()
    bad = good.withColumn("close", F.lit(1)).withColumn("date", F.lit("x")).drop("low")
    assert {r.subject for r in quality.check_ohlcv(bad).collect()} == {"close", "date", "low"}


def test_key_check(spark):
    rows = [("A", d("2020-01-01")), ("A", d("2020-01-01")), (None, d("2020-01-01")), ("B", None)]
    found = quality.check_keys(
        spark.createDataFrame(rows, "symbol string, date date"), ["symbol", "date"]
    )
    assert sorted(r.finding for r in found.collect()) == [
        "missing key", "missing key", "repeated key"
    ]


def test_missing_has_one_form(spark):
    df = spark.createDataFrame([(float("nan"), " a "), (1.0, "b")], "v double, symbol string")
    got = clean.normalized(clean.nan_to_null(df, ["v"])).collect()
    assert [tuple(r) for r in got] == [(None, "A"), (1.0, "B")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_day_on_another_clock(spark, zone):
    """Midnight in New York is the same instant whatever zone the session shows."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.timestamp_seconds(F.lit(1577941199))  # 2020-01-02 04:59:59 in UTC
        got = spark.range(1).select(
            day_in_zone(at, "America/New_York").alias("a"),
            day_in_zone(at + F.make_dt_interval(secs=F.lit(1)), "America/New_York").alias("b"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (got.a, got.b) == (d("2020-01-01"), d("2020-01-02"))
