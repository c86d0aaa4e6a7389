"""Shared steps: words of a text, landed tables, places in one global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.shared import land, new_path

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the copy, which outlives any executor."""
    return land(df, new_path(df.sparkSession, name))


def in_order(df: DataFrame, order: Sequence[Column], sums: dict[str, str] | None = None) -> DataFrame:
    """Rows with their place in one global order and running sums up to the row before.

    Adds ``__place`` (from 0, without gaps) and, for each item of ``sums``, a column named by the
    key with the sum of the column named by the value over all rows before. No task sees more
    than its range of the order: ranges are sorted and landed, each yields one row of totals, and
    only these totals (one row per partition) are added up in one place and broadcast.
    ``order`` should tell rows apart; rows that it does not are kept in an order of their own,
    which the landed copy fixes. ``df`` is read twice, so hand in something landed or cheap.
    """
    sums = sums or {}
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = landed(ranges.withColumn("__row", F.monotonically_increasing_id()), "ordered")
    cell = F.shiftright("__row", 33)
    rows = rows.withColumn("__cell", cell)
    totals = rows.groupBy("__cell").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(column).alias(f"__sum_{name}") for name, column in sums.items()],
    )
    before = Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "__cell",
        *[
            F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__before{c}")
            for c in totals.columns[1:]
        ],
    )
    placed = rows.join(F.broadcast(starts), "__cell")
    inside = Window.partitionBy("__cell").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    added = {"__place": F.col("__before__n") + F.col("__row").bitwiseAND((1 << 33) - 1)}
    for name, column in sums.items():
        own = F.coalesce(F.sum(column).over(inside), F.lit(0))
        added[name] = F.col(f"__before__sum_{name}") + own
    return placed.select(*df.columns, *[c.alias(name) for name, c in added.items()])
