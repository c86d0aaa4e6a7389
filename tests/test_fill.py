import pytest
from helpers import column, d, series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barloom.operators import fill
from barloom.track import Track

TRACK = Track(("series_id",))
GAPPED = [None, 1.0, None, None, 4.0, None]


@pytest.fixture(scope="module")
def gapped(spark):
    return series(spark, *[(f"2020-01-0{i + 1}", v) for i, v in enumerate(GAPPED)])


def test_fills(gapped):
    assert column(fill.ffill(gapped, "value", TRACK), "value", "date") == [None, 1, 1, 1, 4, 4]
    assert column(fill.bfill(gapped, "value", TRACK), "value", "date") == [1, 1, 4, 4, 4, None]
    assert column(fill.ffill_bfill(gapped, "value", TRACK), "value", "date") == [1, 1, 1, 1, 4, 4]
    got = column(fill.interpolate(gapped, "value", TRACK), "value", "date")
    assert got == [None, 1, 2, 3, 4, 4]


def test_interpolation_counts_rows_not_days(spark):
    uneven = series(spark, ("2020-01-01", 1.0), ("2020-01-02", None), ("2020-03-01", 3.0))
    assert column(fill.interpolate(uneven, "value", TRACK), "value", "date") == [1, 2, 3]


def test_flag_and_dispatch(gapped):
    flagged = fill.handle_missing(gapped, "value", "flag")
    assert column(flagged, "is_missing", "date") == [True, False, True, True, False, True]
    assert column(flagged, "value", "date") == GAPPED
    with pytest.raises(ValueError, match="strategy"):
        fill.handle_missing(gapped, "value", "guess")


def test_dedupe_keeps_first_arrival(spark):
    rows = [("A", d("2020-01-01"), 1, 10.0), ("A", d("2020-01-01"), 0, 11.0),
            ("A", d("2020-01-02"), 2, 12.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, arrival int, close double")
    kept = fill.dedupe_first(df, ["symbol", "date"], "arrival")
    assert column(kept, "close", "date") == [11.0, 12.0]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_monotonic_allows_equal_dates(spark):
    rows = [("A", 0, d("2020-01-01")), ("A", 1, d("2020-01-01")), ("A", 2, d("2020-01-02")),
            ("B", 0, d("2020-01-02")), ("B", 1, d("2020-01-01"))]
    df = spark.createDataFrame(rows, "symbol string, pos int, date date")
    found = fill.monotonic_check(df, "date", Track(("symbol",), ("pos",))).collect()
    assert [(r.symbol, r.previous_date, r.date) for r in found] == [
        ("B", d("2020-01-02"), d("2020-01-01"))
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=1, max_size=28))
def test_fill_properties(spark, values):
    df = series(spark, *[(f"2020-02-{i + 1:02d}", v) for i, v in enumerate(values)])
    once = fill.ffill_bfill(df, "value", TRACK)
    got = column(once, "value", "date")
    assert (None in got) == all(v is None for v in values)
    assert column(fill.ffill_bfill(once, "value", TRACK), "value", "date") == got
    assert all(g == v for g, v in zip(got, values, strict=True) if v is not None)
