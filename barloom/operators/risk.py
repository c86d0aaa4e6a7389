"""Returns and risk figures, for all symbols in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import ratio
from barloom.operators.portfolio import growth_rate
from barloom.operators.quality import years_between
from barloom.track import Track, last_before, quoted, running, running_max

DAILY = Track()

# Fixed value: trading days per year.
YEAR = 252


def returns(
    bars: DataFrame, value: str = "close", track: Track = DAILY, name: str = "ret"
) -> DataFrame:
    """Simple return against the last price before the row; null at the first price.

    A missing price has no return, and the next one has the whole change since the last, which is
    what equity curves earn there.
    """
    return (
        running(bars, track, __prev=last_before(F.col(value)))
        .withColumn(name, ratio(F.col(value), F.col("__prev")) - 1)
        .drop("__prev")
    )


def _volatility(r: Column, year: int) -> Column:
    return F.stddev_samp(r) * F.sqrt(F.lit(float(year)))


def _sharpe(r: Column, rf: float, year: int) -> Column:
    excess = r - F.lit(float(rf))
    spread = F.stddev_samp(excess)
    return ratio(F.avg(excess), spread) * F.sqrt(F.lit(float(year)))


def _sortino(r: Column, mar: float, year: int) -> Column:
    below = F.when(r.isNotNull(), F.least(r - F.lit(float(mar)), F.lit(0.0)))
    downside = F.sqrt(F.avg(below * below))
    return ratio(F.avg(r) - F.lit(float(mar)), downside) * F.sqrt(F.lit(float(year)))


def volatility(rets: DataFrame, key: str = "symbol", r: str = "ret", year: int = YEAR):
    return rets.groupBy(key).agg(_volatility(F.col(r), year).alias("volatility"))


def sharpe(
    rets: DataFrame, rf: float = 0.0, key: str = "symbol", r: str = "ret", year: int = YEAR
) -> DataFrame:
    """Mean excess return over its deviation, per year; null where nothing deviates."""
    return rets.groupBy(key).agg(_sharpe(F.col(r), rf, year).alias("sharpe"))


def sortino(
    rets: DataFrame, mar: float = 0.0, key: str = "symbol", r: str = "ret", year: int = YEAR
) -> DataFrame:
    """Mean return over the target against the downside deviation, per year."""
    return rets.groupBy(key).agg(_sortino(F.col(r), mar, year).alias("sortino"))


def drawdown(df: DataFrame, value: str = "close", track: Track = DAILY) -> DataFrame:
    """Distance below the highest value so far, as a (negative) share of it."""
    return (
        running(df, track, __peak=running_max(F.col(value)))
        .withColumn("drawdown", ratio(F.col(value), F.col("__peak")) - 1)
        .drop("__peak")
    )


def max_drawdown(df: DataFrame, value: str = "close", track: Track = DAILY) -> DataFrame:
    return drawdown(df, value, track).groupBy(*track.key).agg(
        F.min("drawdown").alias("max_drawdown")
    )


def _stepped(df: DataFrame, value: str, track: Track) -> DataFrame:
    """Adds return and distance below the peak of every row: one window."""
    v = F.col(quoted(value))
    return (
        running(df, track, __prev=last_before(v), __peak=running_max(v))
        .withColumn("__ret", ratio(v, F.col("__prev")) - 1)
        .withColumn("__down", ratio(v, F.col("__peak")) - 1)
    )


def _figures(value: str, date: str, place: str, rf: float, mar: float, year: int) -> list[Column]:
    """Figures of the values that are there: a curve that starts late starts at its first one."""
    r, there = F.col("__ret"), F.col(quoted(value)).isNotNull()
    day, place = (F.when(there, F.col(quoted(c))) for c in (date, place))
    return [
        F.min(day).alias("start_date"),
        F.max(day).alias("end_date"),
        F.min_by(quoted(value), place).alias("start_value"),
        F.max_by(quoted(value), place).alias("end_value"),
        years_between(date, value).alias("__years"),
        _volatility(r, year).alias("volatility"),
        _sharpe(r, rf, year).alias("sharpe"),
        _sortino(r, mar, year).alias("sortino"),
        F.min("__down").alias("max_drawdown"),
    ]


def _shown() -> list[Column | str]:
    first, last = F.col("start_value"), F.col("end_value")
    return [
        "start_date",
        "end_date",
        "start_value",
        "end_value",
        (last - first).alias("total_profit"),
        (ratio(last, first) - 1).alias("total_return"),
        (growth_rate(first, last, F.col("__years")) * 100).alias("cagr_pct"),
        "volatility",
        "sharpe",
        "sortino",
        "max_drawdown",
    ]


def strategy_stats(
    equity: DataFrame,
    value: str = "equity",
    rf: float = 0.0,
    mar: float = 0.0,
    year: int = YEAR,
    track: Track = DAILY,
    date: str | None = None,
) -> DataFrame:
    """One row of figures per curve; ``date`` is the first order column unless named.

    The price before and the peak so far come from one window, and the figures from one aggregate
    on the same partitioning: one shuffle in all.
    """
    place = track.order[0]
    found = _figures(value, date or place, place, rf, mar, year)
    return _stepped(equity, value, track).groupBy(*track.key).agg(*found).select(
        *track.key, *_shown()
    )


def _marks(rets: DataFrame, benchmarks: Sequence[str], key: str, r: str) -> DataFrame:
    """Returns of the benchmarks as columns of one row per day."""
    return rets.where(F.col(key).isin(list(benchmarks))).groupBy("date").agg(
        *[
            F.max(F.when(F.col(key) == b, F.col(r))).alias(f"__b{i}")
            for i, b in enumerate(benchmarks)
        ]
    )


def _against(benchmarks: Sequence[str], r: str, rf: float, year: int) -> Column:
    """Alpha and beta against each benchmark, over the days both have; an array per curve."""
    figures = []
    for i, b in enumerate(benchmarks):
        mark = F.when(F.col(r).isNotNull(), F.col(f"__b{i}") - F.lit(float(rf)))
        mine = F.when(F.col(f"__b{i}").isNotNull(), F.col(r) - F.lit(float(rf)))
        beta = ratio(F.covar_samp(mine, mark), F.var_samp(mark))
        figures.append(
            F.struct(
                F.lit(b).alias("benchmark"),
                ((F.avg(mine) - beta * F.avg(mark)) * F.lit(float(year))).alias("alpha"),
                beta.alias("beta"),
            )
        )
    return F.array(*figures)


def alpha_beta(
    rets: DataFrame,
    benchmarks: Sequence[str],
    rf: float = 0.0,
    key: str = "symbol",
    r: str = "ret",
    year: int = YEAR,
) -> DataFrame:
    """Alpha and beta of every symbol against each listed benchmark, on dates both have.

    The benchmarks become columns of one table with a row per day, so returns are joined once by
    date and never multiplied by the number of benchmarks. A symbol that shares no day with a
    benchmark has missing figures; without benchmarks there are no rows.
    """
    if not benchmarks:
        return rets.select(key).limit(0).selectExpr(
            quoted(key), "'' AS benchmark", "0D AS alpha", "0D AS beta"
        )
    marks = _marks(rets, benchmarks, key, r)
    joined = rets.select(quoted(key), "date", quoted(r)).join(marks, "date", "left")
    summed = joined.groupBy(key).agg(_against(benchmarks, r, rf, year).alias("__against"))
    return summed.select(key, F.inline("__against"))


def metrics_report(
    bars: DataFrame,
    tickers: Sequence[str] | None,
    benchmarks: Sequence[str],
    start: str | None = None,
    end: str | None = None,
    rf: float = 0.0,
    mar: float = 0.0,
) -> DataFrame:
    """Figures of each ticker with its alpha and beta against each benchmark.

    One window and one aggregate over the bars; the benchmarks' returns are joined by day. Every
    ticker has a row per benchmark, with missing alpha and beta where they share no days, and one
    row with a missing benchmark if none is listed.
    """
    in_range = bars
    if start:
        in_range = in_range.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        in_range = in_range.where(F.col("date") <= F.lit(end).cast("date"))
    if tickers is not None:
        in_range = in_range.where(F.col("symbol").isin([*tickers, *benchmarks]))
    stepped = _stepped(in_range, "close", DAILY)
    found = _figures("close", "date", "date", rf, mar, YEAR)
    if benchmarks:
        own = returns(in_range.where(F.col("symbol").isin(list(benchmarks))), name="__ret")
        stepped = stepped.join(_marks(own, benchmarks, "symbol", "__ret"), "date", "left")
        against = _against(benchmarks, "__ret", rf, YEAR)
    else:
        none = "array(struct(string(null) AS benchmark, double(null) AS alpha, double(null) AS beta))"
        against = F.expr(f"any_value({none})")
    report = stepped.groupBy("symbol").agg(*found, against.alias("__against"))
    report = report.select("symbol", *_shown(), F.inline("__against"))
    return report if tickers is None else report.where(F.col("symbol").isin(list(tickers)))
