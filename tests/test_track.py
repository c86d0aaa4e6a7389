"""Cells must not change results: every running calculation against pandas and one-cell runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import fill, portfolio, risk
from barloom.track import (
    Track,
    even_cells,
    first_known,
    last_before,
    last_known,
    next_known,
    position,
    previous,
    running,
    running_max,
    running_sum,
)


@pytest.fixture(scope="module")
def ticks(spark):
    rng = np.random.default_rng(7)
    rows = []
    for key, n in (("hot", 400), ("warm", 60), ("one", 1), ("void", 12)):
        stamps = pd.Timestamp("2024-01-01") + pd.to_timedelta(
            np.sort(rng.choice(3 * 86400, n, replace=False)), unit="s"
        )
        values = rng.uniform(1, 9, n).round(3)
        values[rng.random(n) < 0.4] = np.nan
        if key == "void":
            values[:] = np.nan
        rows.append(pd.DataFrame({"k": key, "ts": stamps, "v": values}))
    pdf = pd.concat(rows, ignore_index=True)
    pdf["n"] = range(len(pdf))
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=3)).withColumn(
        "v", F.when(~F.isnan("v"), F.col("v"))
    )
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), pdf


def hours():
    return F.unix_date(F.to_date("ts")) * 24 + F.hour("ts")


NAMES = ["one cell", "hours", "two orders", "even"]


def tracks():
    return {
        "one cell": Track(("k",), ("ts",)),
        "hours": Track(("k",), ("ts",), hours()),
        "two orders": Track(("k",), ("ts", "n"), F.floor(hours() / 5)),
        "even": Track(("k",), ("ts",), F.col("cell")),
    }


def rows(df, *columns):
    pdf = df.toPandas().sort_values("n").reset_index(drop=True)
    return pdf[list(columns)].astype(float)


@pytest.mark.parametrize("name", NAMES)
def test_running_equals_pandas(ticks, name):
    df, pdf = ticks
    v = F.col("v")
    got = rows(
        running(
            even_cells(df, "ts"), tracks()[name], lk=last_known(v), nk=next_known(v),
            prev=previous(v), first=first_known(v), before=last_before(v),
            pos=position(), total=running_sum(v), peak=running_max(v),
        ),
        "lk", "nk", "prev", "first", "before", "pos", "total", "peak",
    )
    g = pdf.groupby("k", sort=False)["v"]
    want = pd.DataFrame(
        {
            "lk": g.ffill(),
            "nk": g.bfill(),
            "prev": g.shift(1),
            "first": g.transform(lambda s: s.bfill().iloc[0]).where(g.ffill().notna()),
            "before": g.ffill().groupby(pdf["k"], sort=False).shift(1),
            "pos": pdf.groupby("k").cumcount() + 1,
            "total": g.transform(lambda s: s.cumsum().ffill()),
            "peak": g.transform(lambda s: s.cummax().ffill()),
        }
    ).astype(float)
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("name", NAMES)
def test_fills_equal_pandas(ticks, name):
    df, pdf = ticks
    track, cells = tracks()[name], even_cells(df, "ts")
    g = pdf.groupby("k", sort=False)["v"]
    for op, want in (
        (fill.ffill, g.ffill()),
        (fill.bfill, g.bfill()),
        (fill.ffill_bfill, g.transform(lambda s: s.ffill().bfill())),
        (fill.interpolate, g.transform(lambda s: s.interpolate())),
    ):
        got = rows(op(cells, "v", track), "v")["v"]
        pd.testing.assert_series_equal(got, want, check_names=False)


@pytest.mark.parametrize("micros", [60_000_000, 1_000_000, 0])
def test_even_cells_split_a_burst(spark, micros):
    """A third of a year's rows fall in one minute, one second, one moment."""
    calm = spark.range(6000).select("id", F.timestamp_seconds(F.col("id") * 5256).alias("ts"))
    burst = spark.range(6000, 9000).select(
        "id",
        F.timestamp_micros(F.lit(10**13) + F.col("id") % 100 * F.lit(micros // 100)).alias("ts"),
    )
    cells = even_cells(calm.union(burst), "ts", "id", place="place")
    assert cells.count() == 9000
    top = cells.groupBy("cell").count().agg(F.max("count")).first()[0]
    assert top <= 94  # the root of the number of rows
    ordered = cells.orderBy("ts", "id").select("cell", "place").toPandas()
    assert ordered["cell"].is_monotonic_increasing
    assert ordered["place"].is_monotonic_increasing and ordered["place"].is_unique


@pytest.mark.parametrize("name", NAMES)
def test_signal_equity_equals_loop(ticks, name):
    df, _ = ticks
    track = tracks()[name]
    full = fill.ffill_bfill(even_cells(df, "ts"), "v", track).where("v IS NOT NULL")
    signals = fill.momentum_signals(full, "v", track)
    got = portfolio.signal_equity(signals, init_cash=1.0, value="v", track=track).toPandas()
    for _, one in got.sort_values(["k", "ts"]).groupby("k"):
        equity, long, trades, before = 1.0, False, 0, None
        for r in one.itertuples():
            if before is not None and long:
                equity *= r.v / before
            if r.entry and not long:
                long, trades = True, trades + 1
            elif r.exit and long:
                long, trades = False, trades + 1
            assert r.equity == pytest.approx(equity)
            assert (r.long, r.trades) == (long, trades)
            before = r.v


@pytest.mark.parametrize("name", NAMES)
def test_signal_equity_over_missing_prices(ticks, name):
    df, _ = ticks
    track, cells = tracks()[name], even_cells(df, "ts")
    signals = cells.withColumn("entry", F.col("n") % 7 == 1).withColumn("exit", F.col("n") % 7 == 5)
    got = portfolio.signal_equity(signals, init_cash=1.0, value="v", track=track).toPandas()
    for _, one in got.sort_values(["k", "ts"]).groupby("k"):
        equity, asked, holding, trades, last = 1.0, False, False, 0, None
        for r in one.itertuples():
            asked = True if r.entry else False if r.exit else asked
            if r.v == r.v and r.v is not None:
                if last is not None and holding:
                    equity *= r.v / last
                trades += asked != holding  # what was asked for is filled at this price
                holding, last = asked, r.v
            assert r.equity == pytest.approx(equity)
            assert (r.long, r.trades) == (holding, trades)


@pytest.mark.parametrize("name", NAMES)
def test_drawdown_and_returns_equal_pandas(ticks, name):
    df, pdf = ticks
    track = tracks()[name]
    full = fill.ffill_bfill(even_cells(df, "ts"), "v", track)
    filled = pdf.groupby("k", sort=False)["v"].transform(lambda s: s.ffill().bfill())
    g = filled.groupby(pdf["k"])
    got = rows(risk.drawdown(full, "v", track), "drawdown")["drawdown"]
    want = filled / g.cummax() - 1
    pd.testing.assert_series_equal(got, want, check_names=False)
    got = rows(risk.returns(full, "v", track), "ret")["ret"]
    pd.testing.assert_series_equal(got, g.pct_change(fill_method=None), check_names=False)


@pytest.mark.parametrize("name", NAMES)
def test_returns_and_holdings_over_missing_prices(ticks, name):
    """A late first price and gaps: the product of the returns is the equity."""
    df, _ = ticks
    track, cells = tracks()[name], even_cells(df, "ts")
    held = portfolio.hold_equity(risk.returns(cells, "v", track), 1.0, "v", track)
    got = held.toPandas().sort_values(["k", "ts"])
    for _, one in got.groupby("k"):
        equity, last = None, None
        for r in one.itertuples():
            if r.v == r.v and r.v is not None:
                if last is not None:
                    equity *= r.v / last
                    assert r.ret == pytest.approx(r.v / last - 1)
                else:
                    equity = 1.0
                    assert not r.ret == r.ret
                last = r.v
            else:
                assert not r.ret == r.ret
            assert r.equity == pytest.approx(equity) if equity is not None else r.equity != r.equity


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "long"])
def test_cells_keep_the_order_across_a_clock_change(spark, kind):
    """In March New York skips an hour of the clock; zone-less times there are still in order."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        minutes = spark.range(3000).select(
            "id",
            (F.lit("2024-03-09").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id")))
            .alias("at"),
        )
        at = F.col("id") if kind == "long" else F.col("at").cast(kind)
        got = even_cells(minutes.select("id", at.alias("at")), "at").orderBy("at", "cell").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    cells = [r.cell for r in got]
    assert cells == sorted(cells)
    assert len(set(cells)) >= (3 if kind == "date" else 40)
