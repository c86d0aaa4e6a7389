import pytest
from helpers import calendar, column, d

from barloom.operators import align
from barloom.sources import nyse_holidays, synthesize

# Weekdays on which the New York exchange was closed.
CLOSED_2020 = ["2020-01-01", "2020-01-20", "2020-02-17", "2020-04-10", "2020-05-25",
               "2020-07-03", "2020-09-07", "2020-11-26", "2020-12-25"]
CLOSED_2023 = ["2023-01-02", "2023-01-16", "2023-02-20", "2023-04-07", "2023-05-29",
               "2023-06-19", "2023-07-04", "2023-09-04", "2023-11-23", "2023-12-25"]
EASTERS = {1995: "04-14", 2000: "04-21", 2008: "03-21", 2019: "04-19", 2024: "03-29",
           2025: "04-18", 2038: "04-23"}


def test_holidays(spark):
    assert column(nyse_holidays(spark, 2020, 2020), "date", "date") == [d(x) for x in CLOSED_2020]
    assert column(nyse_holidays(spark, 2023, 2023), "date", "date") == [d(x) for x in CLOSED_2023]
    everything = set(column(nyse_holidays(spark, 1990, 2040), "date", "date"))
    for year, friday in EASTERS.items():
        assert d(f"{year}-{friday}") in everything
    assert d("2021-12-31") not in everything and d("2022-01-01") not in everything
    assert d("1994-04-27") in everything
    with pytest.raises(ValueError, match="1981"):
        nyse_holidays(spark, 1950, 1990)


def test_repeated_holidays_do_no_harm(spark):
    from barloom.sources import trading_calendar

    span = spark.createDataFrame([(d("2023-01-01"), d("2023-01-31"))], "start date, end date")
    holidays = nyse_holidays(spark, 2023, 2023)
    assert trading_calendar(span, holidays.union(holidays)).count() == 20


def test_sessions(spark):
    assert calendar(spark, "2020-01-01", "2020-12-31").count() == 253
    half = calendar(spark, "2023-01-01", "2023-06-30").orderBy("seq").collect()
    assert len(half) == 124
    assert half[0].date == d("2023-01-03") and half[0].prev_day is None
    assert half[0].next_day == half[1].date and half[-1].next_day is None


def test_membership(spark):
    sessions = calendar(spark, "2020-01-01", "2020-01-31")
    asked = spark.createDataFrame([(d("2020-01-01"),), (d("2020-01-02"),)], "date date")
    assert column(align.on_calendar(asked, sessions), "date", "date") == [d("2020-01-02")]
    assert column(align.off_calendar(asked, sessions), "date", "date") == [d("2020-01-01")]


@pytest.fixture(scope="module")
def made(spark):
    spec = spark.createDataFrame(
        [("UP", d("2023-01-01"), d("2023-06-30"), "linear", 50.0, 1.0),
         ("FLAT", d("2023-01-01"), d("2023-06-30"), "cash", 100.0, None),
         ("BARE", d("2023-01-01"), d("2023-01-05"), None, None, None),
         ("EMPTY", d("2023-01-01"), d("2023-01-02"), "linear", 1.0, 1.0),
         ("ODD", d("2023-01-01"), d("2023-06-30"), "square", 1.0, 1.0)],
        "symbol string, start date, end date, data_type string, start_value double, "
        "growth_rate double",
    )
    return synthesize(spec, calendar(spark, "2023-01-01", "2023-12-31"))


def test_generated_bars(made):
    bars, findings = made
    up = bars.where("symbol = 'UP'").orderBy("date").collect()
    assert [r.close for r in up] == [50.0 + i for i in range(124)]
    assert {(r.open, r.volume) for r in up if r.close == 50} == {(50.0, 10000)}
    assert bars.where("symbol = 'FLAT' AND close = 100").count() == 124
    assert column(bars.where("symbol = 'BARE'"), "close", "date") == [1.0, 1.01, 1.02]
    assert {(r.symbol, r.finding) for r in findings.collect()} == {
        ("EMPTY", "no sessions in range"), ("ODD", "unsupported data type")
    }
