"""Putting series on a common timeline.

A timeline is the sorted list of its days. Days are dates, so the list is bounded by the calendar
(a century of them is 150 kB) and is handed to the tasks as one value. Grids are never made by
crossing symbols with days: every observation knows how many timeline days follow it before the
next observation of its series, and emits exactly those rows. That takes one shuffle by series
and no join against the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from barloom.schemas import FIELDS
from barloom.track import later_present, next_present, quoted


def timeline(dates: DataFrame, date: str = "date") -> Column:
    """The distinct days of a date column, sorted, as one array value.

    Days are made distinct before they come together, so that takes one row per calendar day.
    A column of another type is refused: its values would not be bounded by the calendar.
    """
    if not isinstance(dates.schema[date].dataType, DateType):
        raise TypeError(f"column {date!r} is no date; cast it to one")
    days = dates.select(F.col(date).alias("date")).where("date IS NOT NULL").distinct()
    return days.agg(F.sort_array(F.collect_list("date"))).scalar()


def numbered(spark: SparkSession, days: Column) -> DataFrame:
    """The days of a timeline as rows (seq, date), numbered from 0."""
    return spark.range(0, 1, 1, 1).select(F.posexplode(days).alias("seq", "date"))


def first_of_day(
    df: DataFrame, key: str, date: str, values: Sequence[str], arrival: Sequence[str] = ()
) -> DataFrame:
    """One row per series and day: the first by ``arrival``, then by value, missing ones last.

    The first is found per task before the shuffle, so a day that repeats any number of times
    costs a row per task. A single value column without arrival takes a hash aggregate.
    """
    days = df.groupBy(F.col(quoted(key)), F.col(quoted(date)))
    if len(values) == 1 and not arrival:
        return days.agg(F.min(quoted(values[0])).alias(values[0]))
    order = [
        part.alias(f"{kind}_{i}")
        for i, c in enumerate([*arrival, *values])
        for kind, part in (("absent", F.col(quoted(c)).isNull()), ("c", F.col(quoted(c))))
    ]
    found = days.agg(F.min(F.struct(*order)).alias("__first"))
    shown = [F.col(f"__first.c_{len(arrival) + i}").alias(c) for i, c in enumerate(values)]
    return found.select(F.col(quoted(key)), F.col(quoted(date)), *shown)


def _spread(
    df: DataFrame,
    days: Column,
    key: str,
    date: str,
    values: Sequence[str],
    fill: str | None,
    arrival: Sequence[str],
    unique: bool,
) -> DataFrame:
    """One row per series and timeline day, with ``present`` telling the observed days."""
    if fill not in (None, "ffill", "ffill_bfill"):
        raise ValueError(f"fill {fill!r} is not one of ffill, ffill_bfill")
    if not unique:
        df = first_of_day(df, key, date, values, arrival)
    on, on_line = F.col("__on"), F.col("seq").isNotNull()
    places = numbered(df.sparkSession, days).withColumnRenamed("date", "__on")
    placed = (
        df.select(quoted(key), F.col(quoted(date)).alias("__on"), *map(quoted, values))
        .join(F.broadcast(places), "__on", "left")
        .withColumns({c: F.when(on_line, F.col(quoted(c))) for c in values})
        .withColumn("seq", F.coalesce("seq", F.lit(-1)))
    )
    w = Window.partitionBy(quoted(key)).orderBy("seq")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    opens = F.when(F.lag("seq").over(w).isNull(), F.lit(0)).otherwise(F.col("seq"))
    closes = F.coalesce(F.lead("seq").over(w), F.size(days))
    columns = {"__opens": F.greatest(opens, F.lit(0)), "__closes": closes}
    for c in values:
        before = F.last(quoted(c), True).over(past)
        both = F.coalesce(before, later_present(c, w))
        columns[c] = {None: F.col(quoted(c)), "ffill": before, "ffill_bfill": both}[fill]
    own_days = F.slice(
        days, F.col("__opens") + 1, F.greatest(F.col("__closes") - F.col("__opens"), F.lit(0))
    )
    rows = placed.withColumns(columns).withColumn("__day", F.explode(own_days))
    day = F.col("__day")
    shown = {None: day == on, "ffill": day >= on}.get(fill, F.lit(True))
    return rows.select(
        quoted(key),
        day.alias(date),
        *[F.when(shown, F.col(quoted(c))).alias(c) for c in values],
        ((day == on) & (F.col("seq") >= 0)).alias("present"),
    )


def outer_align(
    bars: DataFrame,
    dates: DataFrame | None = None,
    values: Sequence[str] = FIELDS,
    fill: str | None = None,
    key: str = "symbol",
    arrival: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Every symbol gets every date any symbol has.

    A repeated (symbol, date) counts once, with its first row by the ``arrival`` columns, then by
    value. ``unique`` says that none repeats, which spares an aggregate.

    ``dates`` is the set of those dates where it is cheaper to read than from ``bars``. With
    ``fill`` (``ffill`` or ``ffill_bfill``) gaps are repaired in the same pass.
    """
    days = timeline(bars if dates is None else dates)
    return _spread(bars, days, key, "date", values, fill, arrival, unique).drop("present")


def align_to_base(
    base_dates: DataFrame,
    series: DataFrame,
    fill: str | None = None,
    key: str = "series_id",
    values: Sequence[str] = ("value",),
    arrival: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Each series on exactly the base days.

    A repeated (series, date) counts once, with its first row by the ``arrival`` columns, then by
    value. ``unique`` says that none repeats, which spares an aggregate.

    Only the same day matches. An observation on a day outside the base is dropped and does not
    carry into the next base day. ``present`` is true where the day was observed, even if the
    observed value is missing. With ``fill`` gaps are repaired in the same pass.
    """
    return _spread(series, timeline(base_dates), key, "date", values, fill, arrival, unique)


def alignment_report(base_dates: DataFrame, series: DataFrame) -> DataFrame:
    """Per series how many base days it has and how many it lacks, without building the grid.

    A day counts once however often it was observed. Each task marks the days of a series in
    bitmaps over the timeline (4 kB for 32768 days), and only bitmaps are shuffled and merged.
    """
    days = timeline(base_dates)
    places = numbered(series.sparkSession, days)
    number = (F.col("seq") + 1).cast("long")  # null off the base, which marks nothing
    marked = series.select("series_id", "date").join(F.broadcast(places), "date", "left")
    marks = marked.groupBy("series_id", F.bitmap_bucket_number(number).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("marks")
    )
    matches = F.sum(F.bitmap_count("marks")).alias("matches")
    return marks.groupBy("series_id").agg(matches).withColumn(
        "misses", F.size(days) - F.col("matches")
    )


def attach_series(
    bars: DataFrame,
    series: DataFrame,
    ids: Sequence[str],
    base_dates: DataFrame | None = None,
    fill: str | None = "ffill_bfill",
    unique: bool = False,
) -> DataFrame:
    """Bars with one ``Value_<id>`` column per listed series, matched by day and filled.

    The attached side has one row per base day. A listed series without data gives an all-missing
    column. ``unique`` says that no (series, date) repeats.
    """
    base = bars.select("date") if base_dates is None else base_dates
    wanted = series.where(F.col("series_id").isin(list(ids)))
    aligned = align_to_base(base, wanted, fill, unique=unique)
    wide = aligned.groupBy("date").agg(
        *[
            F.max(F.when(F.col("series_id") == i, F.col("value"))).alias(f"Value_{i}")
            for i in ids
        ]
    )
    return bars.join(wide, "date", "left").select(
        *map(quoted, bars.columns), *[quoted(f"Value_{i}") for i in ids]
    )


def on_calendar(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Rows dated on a session."""
    return df.join(F.broadcast(_days(calendar, date)), date, "left_semi")


def off_calendar(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Rows not dated on a session."""
    return df.join(F.broadcast(_days(calendar, date)), date, "left_anti")


def _days(calendar: DataFrame, date: str) -> DataFrame:
    return calendar.select(F.col("date").alias(date)).distinct()


def roll_map(spark: SparkSession, sessions: Column) -> DataFrame:
    """For each day of the sessions' span the first session from it on and the last up to it."""
    span = F.sequence(F.array_min(sessions), F.array_max(sessions), F.expr("interval 1 day"))
    days = spark.range(0, 1, 1, 1).select(F.explode(span).alias("date"))
    marks = numbered(spark, sessions).withColumn("session", F.col("date"))
    w = Window.orderBy("date")
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    return days.join(F.broadcast(marks), "date", "left").select(
        "date",
        next_present("session", w).alias("next_session"),
        next_present("seq", w).alias("next_seq"),
        F.last("session", True).over(back).alias("last_session"),
        F.last("seq", True).over(back).alias("last_seq"),
    )


def roll_to_session(
    ranges: DataFrame, calendar: DataFrame, start: str = "start", end: str = "end"
) -> DataFrame:
    """Ranges moved inwards to sessions, with ``finding`` set where a range has no session.

    ``calendar`` must cover the ranges' sessions; days outside its span roll to its ends.
    """
    rolled = roll(ranges, timeline(calendar), start, end)
    empty = F.col("__first").isNull() | F.col("__last").isNull()
    finding = F.when(
        empty | (F.col("__first") > F.col("__last")), F.lit("no session in range")
    )
    return rolled.select(
        *map(quoted, ranges.columns),
        F.when(finding.isNull(), F.col("__first")).alias("first_session"),
        F.when(finding.isNull(), F.col("__last")).alias("last_session"),
        finding.alias("finding"),
    )


def roll(ranges: DataFrame, sessions: Column, start: str, end: str) -> DataFrame:
    """Adds the first and last session of each range and their numbers, by two equi-joins."""
    rolls = roll_map(ranges.sparkSession, sessions)
    starts = rolls.select(
        F.col("date").alias("__from"),
        F.col("next_session").alias("__first"),
        F.col("next_seq").alias("__first_seq"),
    )
    ends = rolls.select(
        F.col("date").alias("__to"),
        F.col("last_session").alias("__last"),
        F.col("last_seq").alias("__last_seq"),
    )
    from_day = F.greatest(F.col(start), F.array_min(sessions))
    to_day = F.least(F.col(end), F.array_max(sessions))
    return (
        ranges.withColumn("__from", F.when(F.col(start).isNotNull(), from_day))
        .withColumn("__to", F.when(F.col(end).isNotNull(), to_day))
        .join(F.broadcast(starts), "__from", "left")
        .join(F.broadcast(ends), "__to", "left")
    )


def first_session_from(calendar: DataFrame, day: str) -> DataFrame:
    """First session on or after one given day."""
    return calendar.where(F.col("date") >= F.lit(day).cast("date")).agg(
        F.min("date").alias("session")
    )


def last_session_until(calendar: DataFrame, day: str) -> DataFrame:
    """Last session on or before one given day."""
    return calendar.where(F.col("date") <= F.lit(day).cast("date")).agg(
        F.max("date").alias("session")
    )


def union_symbols(*frames: DataFrame) -> DataFrame:
    """Long frames of several symbols or sources as one."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
