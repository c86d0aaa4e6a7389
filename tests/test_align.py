import numpy as np
import pandas as pd
from helpers import calendar, closes, column, d, days, series
from pyspark.sql import functions as F

from barloom.operators import align


def test_same_day_match(spark):
    base = days(spark, "2020-01-01", "2020-01-02", "2020-01-03")
    points = [("2020-01-01", 1.5), ("2020-01-02", 1.6), ("2020-01-03", 1.7)]
    s = series(spark, *points, series_id="OAS")
    merged = align.attach_series(base, s, ["OAS"])
    assert column(merged, "Value_OAS", "date") == [1.5, 1.6, 1.7]
    report = align.alignment_report(base, s).first()
    assert (report.matches, report.misses) == (3, 0)


def test_off_base_observation_does_not_carry(spark):
    base = days(spark, "2020-02-28", "2020-03-02", "2020-03-03")
    s = series(spark, ("2020-02-28", 5.04), ("2020-02-29", 5.06), ("2020-03-03", 4.9))
    aligned = align.align_to_base(base, s)
    assert column(aligned, "value", "date") == [5.04, None, 4.9]
    assert column(aligned, "present", "date") == [True, False, True]
    assert column(align.align_to_base(base, s, "ffill"), "value", "date") == [5.04, 5.04, 4.9]


def test_matched_missing_value_is_a_match(spark):
    base = days(spark, "2020-01-01", "2020-01-02")
    s = series(spark, ("2020-01-01", None), ("2020-01-02", 2.0), ("2020-01-05", 9.0))
    report = align.alignment_report(base, s).first()
    assert (report.matches, report.misses) == (2, 0)
    assert column(align.align_to_base(base, s, "ffill"), "value", "date") == [None, 2.0]
    assert column(align.align_to_base(base, s, "ffill_bfill"), "value", "date") == [2.0, 2.0]


def test_series_wholly_off_base_still_appears(spark):
    base = days(spark, "2020-01-01", "2020-01-02")
    s = series(spark, ("2019-12-01", 1.0), ("2019-12-02", 2.0), ("2021-01-01", 3.0))
    got = align.align_to_base(base, s, "ffill_bfill").collect()
    assert sorted((r.date, r.value, r.present) for r in got) == [
        (d("2020-01-01"), None, False), (d("2020-01-02"), None, False)
    ]


def test_unknown_series_gives_missing_column(spark):
    base = days(spark, "2020-01-01")
    merged = align.attach_series(base, series(spark, ("2020-01-01", 1.0)), ["S", "NONE"])
    assert merged.columns == ["date", "Value_S", "Value_NONE"]
    assert merged.first().Value_NONE is None


def test_random_grids_equal_pandas(spark):
    rng = np.random.default_rng(5)
    base = pd.bdate_range("2020-01-01", periods=40)
    everything = pd.date_range("2019-12-20", "2020-03-15")
    frames, wanted = [], {}
    for i in range(12):
        picked = np.sort(rng.choice(len(everything), rng.integers(1, 50), replace=False))
        s = pd.Series(rng.normal(size=len(picked)).round(4), index=everything[picked])
        s[rng.random(len(s)) < 0.3] = np.nan
        frames.append(pd.DataFrame({"series_id": f"s{i}", "date": s.index.date, "value": s.values}))
        wanted[f"s{i}"] = s.reindex(base)
    long = pd.concat(frames)
    df = spark.createDataFrame(long, "series_id string, date date, value double")
    df = df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    dates = spark.createDataFrame([(x.date(),) for x in base], "date date")
    for mode, repair in (
        (None, lambda s: s), ("ffill", lambda s: s.ffill()),
        ("ffill_bfill", lambda s: s.ffill().bfill()),
    ):
        got = align.align_to_base(dates, df, mode).toPandas()
        assert len(got) == 12 * 40
        for name, g in got.sort_values("date").groupby("series_id"):
            want = repair(wanted[name])
            np.testing.assert_array_equal(g["value"].astype(float).values, want.values)


def test_outer_align(spark):
    bars = closes(spark, "A", ("2020-01-01", 1), ("2020-01-03", 3)).union(
        closes(spark, "B", ("2020-01-02", 5))
    )
    got = align.outer_align(bars, values=["close"])
    assert column(got, "close", "symbol", "date") == [1, None, 3, None, 5, None]
    filled = align.outer_align(bars, values=["close"], fill="ffill_bfill")
    assert column(filled, "close", "symbol", "date") == [1, 1, 3, 5, 5, 5]


def test_roll_to_session(spark):
    sessions = calendar(spark, "2019-12-01", "2023-12-31")
    asked = [("2023-01-01", "2023-06-19"), ("2020-01-01", "2020-12-31"),
             ("2023-01-01", "2023-01-02"), ("2030-01-01", "2030-02-01"), (None, "2020-01-05")]
    ranges = spark.createDataFrame(
        [(i, s and d(s), d(e)) for i, (s, e) in enumerate(asked)], "i int, start date, end date"
    )
    got = align.roll_to_session(ranges, sessions).orderBy("i").collect()
    assert [(r.first_session, r.last_session) for r in got] == [
        (d("2023-01-03"), d("2023-06-16")), (d("2020-01-02"), d("2020-12-31")),
        (None, None), (None, None), (None, None),
    ]
    assert [r.finding is None for r in got] == [True, True, False, False, False]


def test_grid_needs_no_cross_join(spark):
    bars = closes(spark, "A", ("2020-01-01", 1), ("2020-01-03", 3))
    plan = align.outer_align(bars, values=["close"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_repeated_days_match_once(spark):
    base = days(spark, "2020-01-01", "2020-01-02")
    s = series(spark, ("2020-01-01", 1.0), ("2020-01-01", 2.0), ("2020-01-01", 3.0), ("2019-01-01", 1.0))
    report = align.alignment_report(base, s).first()
    assert (report.matches, report.misses) == (1, 1)
    off = align.alignment_report(base, series(spark, ("2019-01-01", 1.0))).first()
    assert (off.matches, off.misses) == (0, 2)
    assert column(align.align_to_base(base, s), "value", "date") == [1.0, None]


def test_long_timelines_take_several_bitmaps(spark):
    base = spark.range(40000).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    s = base.select(F.lit("S").alias("series_id"), "date", F.lit(1.0).alias("value")).where(
        "datediff(date, date '1900-01-01') % 3 = 0"
    )
    report = align.alignment_report(base, s.union(s)).first()
    assert (report.matches, report.misses) == (13334, 26666)


def test_first_of_repeated_days(spark):
    rows = [("A", d("2020-01-01"), None, 9.0, 1), ("A", d("2020-01-01"), 2.0, 3.0, 1), ("A", d("2020-01-01"), 1.0, 1.0, 2),
            ("A", d("2020-01-02"), None, None, 1), ("B", None, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, close double, came int")
    got = align.first_of_day(df, "symbol", "date", ["open", "close"], ["came"]).collect()
    assert {(r.symbol, r.date, r.open, r.close) for r in got} == {
        ("A", d("2020-01-01"), 2.0, 3.0), ("A", d("2020-01-02"), None, None), ("B", None, 1.0, 1.0)
    }
    plain = align.first_of_day(df, "symbol", "date", ["open"])
    assert {(r.symbol, r.date, r.open) for r in plain.collect()} == {
        ("A", d("2020-01-01"), 1.0), ("A", d("2020-01-02"), None), ("B", None, 1.0)
    }
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_unique_keys_need_no_aggregate(spark):
    bars = closes(spark, "A", ("2020-01-01", 1), ("2020-01-03", 3))
    plan = align.outer_align(bars, days(spark, "2020-01-01", "2020-01-03"), ["close"], unique=True)
    repeats = align.outer_align(bars, days(spark, "2020-01-01", "2020-01-03"), ["close"])
    assert column(plan, "close", "date") == column(repeats, "close", "date") == [1, 3]
