"""Running calculations along many series at once.

A ``Track`` says which columns name a series, which columns order its rows, and, for long
series, which time cell a row lies in. ``running`` evaluates running calculations on it.

Without a segment every series is one window partition. That suits daily bars: the key
(symbol, date) is unique, so a partition has at most one row per day.

With a segment a series may be any length. Rows are windowed inside (key, segment) cells, so a
series that holds a third of all rows is spread over its cells. One row of totals per cell is
aggregated map-side, carried along the series in a window over cells, and joined back on
(key, segment). The rows themselves cross the network once: the windows and the join share one
partitioning and one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.shared import land, new_path

_CELL = "__cell"
_FIRST = "__cell_first"


@dataclass(frozen=True)
class Track:
    """Key columns, order columns and (optionally) the cell of a row.

    ``segment`` must not decrease along the order, which must tell the rows of a key apart if
    equal ones may lie in two cells; ``even_cells`` builds one. Key and order columns must not be
    null.
    """

    key: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("date",)
    segment: Column | None = None

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy(*self.order)

    def so_far(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def position_key(self) -> Column:
        """One orderable value; a plain column keeps min_by/max_by in a hash aggregate."""
        return F.col(self.order[0]) if len(self.order) == 1 else F.struct(*self.order)


def even_cells(
    df: DataFrame, *order: str, name: str = "cell", place: str | None = None
) -> DataFrame:
    """Add a cell number that splits any amount of rows, for use as ``Track.segment``.

    The rows are sorted by ``order`` and landed; with n rows, a cell is a run of at most sqrt(n)
    of them, so neither the window inside a cell nor the one along the cells of a series grows
    with the table itself, however many rows fall on one moment. ``order`` should tell rows apart;
    where it does not, the landed copy fixes an order, which ``place`` names as a column. One
    column of whole numbers that is in order lets a ``Track`` over it use hash aggregates.

    The table is read twice, to sample it and to sort it.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranges.withColumn("__row", F.monotonically_increasing_id())
    rows = land(numbered, new_path(df.sparkSession, "cells"))
    share = max(1, isqrt(rows.count()))
    inside = F.col("__row").bitwiseAND((1 << 33) - 1)  # place in its sorted range
    cells = rows.withColumn(name, F.col("__row") - inside % share)
    return cells.drop("__row") if place is None else cells.withColumnRenamed("__row", place)


def later_present(name: str, window: WindowSpec) -> Column:
    """Next value of a column that is not null, after the row.

    ``lead`` walks the partition once; a frame that ends at unbounded following is summed up anew
    for every row.
    """
    return F.expr(f"lead({quoted(name)}) IGNORE NULLS").over(window)


def next_present(name: str, window: WindowSpec) -> Column:
    """First value of a column that is not null, from the row on."""
    return F.coalesce(F.col(quoted(name)), later_present(name, window))


@dataclass(frozen=True)
class Running:
    """One running calculation over ``value``, which its functions get as a column name.

    inside   value from the rows of the own cell (the whole series if there is one cell)
    total    what a cell hands on
    carried  what reaches a cell from the others; gets the column of cell totals
    merged   the two combined; gets (inside, carried) and, if it ``uses_first``, may ask whether
             the row is the first of its cell
    """

    value: Column
    inside: Callable[[str, Track], Column]
    total: Callable[[str, Track], Column]
    carried: Callable[[str, Track], Column]
    merged: Callable[[Column, Column], Column]
    uses_first: bool = False


def _rows_before(track: Track) -> WindowSpec:
    return track.window().rowsBetween(Window.unboundedPreceding, -1)


def _place_if_present(name: str, track: Track) -> Column:
    return F.when(F.col(name).isNotNull(), track.position_key())


def last_known(value: Column) -> Running:
    """Last value that is not null, up to and including the row."""
    return Running(
        value,
        inside=lambda v, t: F.last(v, True).over(t.so_far()),
        total=lambda v, t: F.max_by(v, _place_if_present(v, t)),
        carried=lambda s, t: F.last(s, True).over(_rows_before(t)),
        merged=lambda own, carry: F.coalesce(own, carry),
    )


def next_known(value: Column) -> Running:
    """First value that is not null, from the row onwards."""
    return Running(
        value,
        inside=lambda v, t: next_present(v, t.window()),
        total=lambda v, t: F.min_by(v, _place_if_present(v, t)),
        carried=lambda s, t: later_present(s, t.window()),
        merged=lambda own, carry: F.coalesce(own, carry),
    )


def previous(value: Column) -> Running:
    """Value of the row before; null on the first row of the series."""
    return Running(
        value,
        inside=lambda v, t: F.lag(v).over(t.window()),
        total=lambda v, t: F.max_by(v, t.position_key()),
        carried=lambda s, t: F.lag(s).over(t.window()),
        merged=lambda own, carry: F.when(F.col(_FIRST), carry).otherwise(own),
        uses_first=True,
    )


def last_before(value: Column) -> Running:
    """Last value that is not null, strictly before the row."""
    return Running(
        value,
        inside=lambda v, t: F.last(v, True).over(_rows_before(t)),
        total=lambda v, t: F.max_by(v, _place_if_present(v, t)),
        carried=lambda s, t: F.last(s, True).over(_rows_before(t)),
        merged=lambda own, carry: F.coalesce(own, carry),
    )


def first_known(value: Column) -> Running:
    """First value of the series that is not null, null on the rows before it."""
    return Running(
        value,
        inside=lambda v, t: F.first(v, True).over(t.so_far()),
        total=lambda v, t: F.min_by(v, _place_if_present(v, t)),
        carried=lambda s, t: F.first(s, True).over(_rows_before(t)),
        merged=lambda own, carry: F.coalesce(carry, own),
    )


def position() -> Running:
    """Number of the row in its series, from 1."""
    return Running(
        F.lit(1),
        inside=lambda v, t: F.row_number().over(t.window()).cast("long"),
        total=lambda v, t: F.count(v),
        carried=lambda s, t: F.sum(s).over(_rows_before(t)),
        merged=lambda own, carry: own + F.coalesce(carry, F.lit(0)),
    )


def running_sum(value: Column) -> Running:
    """Sum up to and including the row; nulls count as nothing."""
    return Running(
        value,
        inside=lambda v, t: F.sum(v).over(t.so_far()),
        total=lambda v, t: F.sum(v),
        carried=lambda s, t: F.sum(s).over(_rows_before(t)),
        merged=lambda own, carry: F.coalesce(own + carry, own, carry),
    )


def running_max(value: Column) -> Running:
    """Greatest value up to and including the row."""
    return Running(
        value,
        inside=lambda v, t: F.max(v).over(t.so_far()),
        total=lambda v, t: F.max(v),
        carried=lambda s, t: F.max(s).over(_rows_before(t)),
        merged=lambda own, carry: F.greatest(own, carry),
    )


def running(df: DataFrame, track: Track, **columns: Running) -> DataFrame:
    """Add (or replace) one column per running calculation."""
    kept = [quoted(c) for c in df.columns if c not in columns]
    names = {name: f"__v_{name}" for name in columns}
    valued = df.withColumns({names[name]: r.value for name, r in columns.items()})
    if track.segment is None:
        done = [r.inside(names[name], track).alias(name) for name, r in columns.items()]
        return valued.select(*kept, *done)

    celled = valued.withColumn(_CELL, track.segment)
    cell_key = [_CELL, *track.key]  # the number first: most comparisons of a sort end there
    within = replace(track, key=tuple(cell_key), segment=None)
    along = replace(track, order=(_CELL,), segment=None)

    own = {f"__own_{name}": r.inside(names[name], within) for name, r in columns.items()}
    if any(r.uses_first for r in columns.values()):
        own[_FIRST] = F.row_number().over(within.window()) == 1
    totals = celled.groupBy(*cell_key).agg(
        *[r.total(names[name], track).alias(f"__total_{name}") for name, r in columns.items()]
    )
    carried = totals.select(
        *cell_key,
        *[
            r.carried(f"__total_{name}", along).alias(f"__carry_{name}")
            for name, r in columns.items()
        ],
    )
    joined = celled.withColumns(own).join(carried, cell_key, "left")
    merged = [
        r.merged(F.col(f"__own_{name}"), F.col(f"__carry_{name}")).alias(name)
        for name, r in columns.items()
    ]
    return joined.select(*kept, *merged)


def through_cells(
    df: DataFrame,
    track: Track,
    inside: Callable[[DataFrame, Track], DataFrame],
    totals: Sequence[Column],
    along: Callable[[DataFrame, Track], DataFrame],
) -> DataFrame:
    """Rows with what ``inside`` adds per cell and what ``along`` adds from the other cells.

    For calculations of several dependent steps: however many there are, the table is read twice
    and its rows are shuffled twice, once for the rows and once for the totals.
    """
    cell_key = [_CELL, *track.key]
    within = replace(track, key=tuple(cell_key), segment=None)
    rows = inside(df.withColumn(_CELL, track.segment), within)
    chain = replace(track, order=(_CELL,), segment=None)
    summed = rows.groupBy(*cell_key).agg(*totals)
    carried = along(summed, chain)
    carries = [c for c in carried.columns if c.startswith("__carry_")]
    carried = carried.select(*cell_key, *carries)
    return rows.join(carried, cell_key, "left")


def quoted(name: str) -> str:
    """Column name as a reference; symbols such as ``BRK.B`` are legal in wide names."""
    return "`" + name.replace("`", "``") + "`"


def column_names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)
