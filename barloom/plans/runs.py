"""The three runs: merged market data, a holding strategy, configured and generated series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.align import attach_series, outer_align, roll_to_session
from barloom.operators.clean import (
    configured_only,
    repaired_series_to_ohlcv,
    target_series,
    to_wide,
)
from barloom.operators.fill import dedupe_first
from barloom.operators.portfolio import hold_equity
from barloom.operators.quality import assert_clean, check_ohlcv, emptiness, missing_series
from barloom.operators.risk import strategy_stats
from barloom.sinks import write_by_alias, write_checked, write_dual
from barloom.sources.fetching import Fetch, fetch_bars, read_through
from barloom.sources.files import read_symbol_dir, read_two_header
from barloom.sources.generated import synthesize
from barloom.track import Track


def market_run(
    bars_requests: DataFrame,
    series_requests: DataFrame,
    series_ids: Sequence[str],
    calendar: DataFrame,
    fetch_bar: Fetch,
    fetch_value: Fetch,
    folder: str,
    wide_symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Ranges rolled to sessions, bars fetched, aligned and filled, series attached, saved.

    Bars and series are landed when fetched, so the plan after that starts from written tables.
    The tables saved are long; with ``wide_symbols`` they have one row per day and a
    ``Field_TICKER`` column per field of each listed symbol.
    """
    bars, _ = fetch_bars(
        _rolled(bars_requests, calendar), fetch_bar, f"{folder}/fetched", arrival=True
    )
    series = read_through(_rolled(series_requests, calendar), fetch_value, f"{folder}/series")
    aligned = outer_align(bars, fill="ffill_bfill", arrival=["arrival"])
    if wide_symbols is not None:
        aligned = to_wide(aligned, wide_symbols)
    whole = write_dual(aligned, folder, "yahoo_data")
    merged = attach_series(whole, series, series_ids)
    return write_checked(merged, folder, "merged_data")


def _rolled(requests: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        roll_to_session(requests, calendar)
        .where("finding IS NULL")
        .select("symbol", F.col("first_session").alias("start"), F.col("last_session").alias("end"))
    )


def holding_run(
    source: DataFrame | str,
    target: str | Sequence[str] | None = None,
    init_cash: float = 100.0,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Figures of buying and holding: of one (symbol, field) target, or of every symbol's close.

    ``source`` is a frame of bars or the path of a two-header CSV.
    """
    bars = read_two_header(spark, source) if isinstance(source, str) else source
    if target is None:
        prices = bars.select("symbol", "date", F.col("close").alias("value"))
    else:
        name = target if isinstance(target, str) else target[0]
        prices = target_series(bars, target).withColumn("symbol", F.lit(name.lower()))
        if prices.isEmpty():
            raise ValueError(f"target {target!r} is not in the data")
    present = prices.where("value IS NOT NULL")
    return strategy_stats(hold_equity(present, init_cash, "value"), "equity")


def generated_run(
    requested: DataFrame,
    spec: DataFrame,
    calendar: DataFrame,
    series: DataFrame,
    folder: str,
    strategy: str = "interpolate",
) -> tuple[DataFrame, DataFrame]:
    """Bars of configured generated symbols and of repaired series, one output per alias.

    Gives the bars read back from the output, deduplicated and checked, and the requested
    symbols that were skipped, with the reason. A symbol and day that is both generated and in the
    series is the generated one; a series without any value is skipped and reported.
    """
    known, unknown = configured_only(requested, spec)
    made, findings = synthesize(spec.join(known.select("symbol"), "symbol", "left_semi"), calendar)
    repaired = repaired_series_to_ohlcv(series, strategy, Track(("series_id",)))
    empty_series = missing_series(series, "series_id", "value")
    both = made.withColumn("__from", F.lit(0)).unionByName(repaired.withColumn("__from", F.lit(1)))
    bars = dedupe_first(both, ["symbol", "date"], ["__from", "date"]).drop("__from")
    write_by_alias(bars.withColumnRenamed("symbol", "alias"), folder)
    written, _ = read_symbol_dir(bars.sparkSession, folder, folder_of="alias", stored=True)
    place = Track(
        ("symbol", "stored_file"), ("stored_block", "stored_row"), F.col("stored_block")
    )
    assert_clean(check_ohlcv(written, place))
    back = written.drop("stored_file", "stored_block", "stored_row")
    empty = emptiness(known, made).withColumn("finding", F.lit("no rows"))
    skipped = (
        unknown.select("symbol", F.lit("no settings").alias("finding"))
        .unionByName(findings.select("symbol", "finding"))
        .unionByName(empty.join(findings, "symbol", "left_anti"))
    )
    return back, skipped.unionByName(empty_series)


