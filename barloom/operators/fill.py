"""Repair of missing values along a series, and row-order operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.track import (
    Track,
    column_names,
    last_known,
    later_present,
    next_known,
    position,
    previous,
    quoted,
    running,
    through_cells,
)

DAILY = Track()


def ffill(df: DataFrame, columns: str | Sequence[str], track: Track = DAILY) -> DataFrame:
    """Last present value; leading gaps stay."""
    return running(
        df, track, **{c: last_known(F.col(quoted(c))) for c in column_names(columns)}
    ).select(*map(quoted, df.columns))


def bfill(df: DataFrame, columns: str | Sequence[str], track: Track = DAILY) -> DataFrame:
    """Next present value; trailing gaps stay."""
    return running(
        df, track, **{c: next_known(F.col(quoted(c))) for c in column_names(columns)}
    ).select(*map(quoted, df.columns))


def ffill_bfill(df: DataFrame, columns: str | Sequence[str], track: Track = DAILY) -> DataFrame:
    """Forward fill, then back fill of what is left: only leading gaps look ahead."""
    names = column_names(columns)
    both = {}
    for i, c in enumerate(names):
        both[f"__before_{i}"] = last_known(F.col(quoted(c)))
        both[f"__after_{i}"] = next_known(F.col(quoted(c)))
    filled = {c: F.coalesce(f"__before_{i}", f"__after_{i}") for i, c in enumerate(names)}
    return running(df, track, **both).withColumns(filled).select(*map(quoted, df.columns))


def interpolate(df: DataFrame, columns: str | Sequence[str], track: Track = DAILY) -> DataFrame:
    """Straight line between the present neighbours, by row position and not by elapsed time.

    Leading gaps stay missing; trailing gaps take the last present value.
    """
    names = column_names(columns)
    placed = _neighbours(df, names, track) if track.segment is None else (
        _neighbours_by_cell(df, names, track)
    )
    lines = {c: _line(F.col(quoted(c)), i) for i, c in enumerate(names)}
    return placed.withColumns(lines).select(*map(quoted, df.columns))


def _point(value: str, place: Column) -> Column:
    """A present value with its place in the series; null for a gap."""
    here = F.struct(F.col(quoted(value)).alias("v"), place.alias("p"))
    return F.when(F.col(quoted(value)).isNotNull(), here)


def _neighbours(df: DataFrame, names: list[str], track: Track) -> DataFrame:
    """Adds ``__pos`` and, per column, the present points ``__before_i`` and ``__after_i``."""
    around = {}
    for i, c in enumerate(names):
        around[f"__before_{i}"] = last_known(_point(c, F.col("__pos")))
        around[f"__after_{i}"] = next_known(_point(c, F.col("__pos")))
    return running(running(df, track, __pos=position()), track, **around)


def _neighbours_by_cell(df: DataFrame, names: list[str], track: Track) -> DataFrame:
    """The same with places counted inside each cell, then moved on by the rows before it."""
    totals = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(names):
        point = F.col(quoted(c)).isNotNull()
        at = F.when(point, F.col("__pos"))
        for end, by, rank in (("first", F.min_by, F.min), ("last", F.max_by, F.max)):
            totals.append(by(quoted(c), at).alias(f"__{end}_v_{i}"))
            totals.append(rank(at).alias(f"__{end}_p_{i}"))

    def along(cells: DataFrame, chain: Track) -> DataFrame:
        earlier = chain.window().rowsBetween(Window.unboundedPreceding, -1)
        moved = cells.withColumn(
            "__carry_rows", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
        )

        def point(end: str, i: int) -> Column:
            place = F.col(f"__{end}_p_{i}") + F.col("__carry_rows")
            found = F.struct(F.col(f"__{end}_v_{i}").alias("v"), place.alias("p"))
            return F.when(place.isNotNull(), found)

        count = range(len(names))
        firsts = moved.withColumns({f"__first_{i}": point("first", i) for i in count})
        points = {}
        for i in count:
            points[f"__carry_before_{i}"] = F.last(point("last", i), True).over(earlier)
            points[f"__carry_after_{i}"] = later_present(f"__first_{i}", chain.window())
        return firsts.withColumns(points)

    rows = through_cells(
        df, track, lambda cells, within: _neighbours(cells, names, within), totals, along
    )
    moved = {"__pos": F.col("__pos") + F.col("__carry_rows")}
    for i in range(len(names)):
        for side in ("before", "after"):
            own = F.col(f"__{side}_{i}")
            place = (own["p"] + F.col("__carry_rows")).alias("p")
            moved[f"__{side}_{i}"] = F.when(
                own.isNotNull(), F.struct(own["v"].alias("v"), place)
            ).otherwise(F.col(f"__carry_{side}_{i}"))
    return rows.withColumns(moved)


def _line(value: Column, i: int) -> Column:
    before, after = F.col(f"__before_{i}"), F.col(f"__after_{i}")
    share = (F.col("__pos") - before["p"]) / (after["p"] - before["p"])
    return (
        F.when(value.isNotNull(), value)
        .when(after.isNull(), before["v"])
        .otherwise(before["v"] + (after["v"] - before["v"]) * share)
    )


def flag(df: DataFrame, column: str, name: str = "is_missing") -> DataFrame:
    """Keep the gaps and say where they are."""
    return df.withColumn(name, F.col(quoted(column)).isNull())


def handle_missing(
    df: DataFrame, column: str, strategy: str = "interpolate", track: Track = DAILY
) -> DataFrame:
    if strategy == "interpolate":
        return interpolate(df, column, track)
    if strategy == "forward_fill":
        return ffill(df, column, track)
    if strategy == "flag":
        return flag(df, column)
    raise ValueError(f"missing-value strategy {strategy!r} is not one of interpolate, "
                     "forward_fill, flag")


def dedupe_first(df: DataFrame, key: Sequence[str], arrival: str | Sequence[str]) -> DataFrame:
    """First row per key in arrival order.

    The rank limit is applied on each input partition before the shuffle, so a key repeated any
    number of times costs one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*column_names(arrival))
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def session_number(df: DataFrame, track: Track = DAILY, name: str = "session") -> DataFrame:
    """Position in the series, from 0."""
    return running(df, track, __pos=position()).withColumn(name, F.col("__pos") - 1).drop("__pos")


def momentum_signals(df: DataFrame, value: str = "close", track: Track = DAILY) -> DataFrame:
    """``entry`` where the value rose, ``exit`` where it fell; neither on the first row."""
    now, before = F.col(quoted(value)), F.col("__prev")
    return (
        running(df, track, __prev=previous(now))
        .withColumn("entry", F.coalesce(now > before, F.lit(False)))
        .withColumn("exit", F.coalesce(now < before, F.lit(False)))
        .drop("__prev")
    )


def monotonic_check(df: DataFrame, date: str, stored: Track) -> DataFrame:
    """Rows dated before the row stored just ahead of them; equal dates pass.

    ``stored`` orders the rows by their stored position.
    """
    return running(df, stored, previous_date=previous(F.col(date))).where(
        F.col("previous_date") > F.col(date)
    )
