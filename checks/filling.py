"""Fills, duplicates, row order. The ``_ticks`` queries split five long series into cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import fill
from barloom.track import Track, even_cells
from checks import adapters as a
from checks.adapters import rounded, s6, using
from checks.registry import query

SERIES = Track(("series_id",))

_BACK = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_AHEAD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def _sql(key, order):
    w = f"PARTITION BY {key} ORDER BY {order}"
    before = f"last_value(value IGNORE NULLS) OVER ({w} {_BACK})"
    after = f"first_value(value IGNORE NULLS) OVER ({w} {_AHEAD})"
    return before, after, w


def _line(view, key, order, columns):
    before, after, w = _sql(key, order)
    return using(view, f""", p AS (SELECT *, row_number() OVER ({w}) AS pos FROM {view}),
q AS (SELECT *, CASE WHEN value IS NOT NULL THEN pos END AS here FROM p),
n AS (SELECT *, {before} AS bv, {after} AS av,
    last_value(here IGNORE NULLS) OVER ({w} {_BACK}) AS bp,
    first_value(here IGNORE NULLS) OVER ({w} {_AHEAD}) AS ap FROM q)
SELECT {columns}, {s6('''CASE WHEN value IS NOT NULL THEN value WHEN av IS NULL THEN bv
    ELSE bv + (av - bv) * ((pos - bp) / CAST(ap - bp AS DOUBLE)) END''')} AS value FROM n""")


_B, _A, _ = _sql("series_id", "date")


@query(using("gapped_series", f"SELECT series_id, date, {_B} AS value FROM gapped_series"))
def ffill(spark, sf):
    return fill.ffill(a.gapped_series(spark, sf), "value", SERIES)


@query(using("gapped_series", f"SELECT series_id, date, {_A} AS value FROM gapped_series"))
def bfill(spark, sf):
    return fill.bfill(a.gapped_series(spark, sf), "value", SERIES)


@query(using("gapped_series", f"""SELECT series_id, date, coalesce({_B}, {_A}) AS value
FROM gapped_series"""))
def ffill_bfill(spark, sf):
    return fill.ffill_bfill(a.gapped_series(spark, sf), "value", SERIES)


@query(_line("gapped_series", "series_id", "date", "series_id, date"))
def interpolate(spark, sf):
    return rounded(fill.interpolate(a.gapped_series(spark, sf), "value", SERIES), "value")


@query(using("gapped_series", """SELECT series_id, date, value, value IS NULL AS is_missing
FROM gapped_series"""))
def flag_missing(spark, sf):
    return fill.handle_missing(a.gapped_series(spark, sf), "value", "flag")


@query(using("gapped_series", f"SELECT series_id, date, {_B} AS value FROM gapped_series"))
def handle_missing(spark, sf):
    return fill.handle_missing(a.gapped_series(spark, sf), "value", "forward_fill", SERIES)


@query(_line("gapped_series", "series_id", "date", "series_id, date"))
def handle_missing_default(spark, sf):
    """The default repair, a straight line."""
    return rounded(fill.handle_missing(a.gapped_series(spark, sf), "value", track=SERIES), "value")


@query("""SELECT * FROM (SELECT event_type, CAST(ts AS DATE) AS date, event_id, value FROM events)
QUALIFY row_number() OVER (PARTITION BY event_type, date ORDER BY event_id) = 1""")
def dedupe_first(spark, sf):
    events = a.table(spark, sf, "events").select(
        "event_type", F.to_date("ts").alias("date"), "event_id", "value"
    )
    return fill.dedupe_first(events, ["event_type", "date"], "event_id")


@query(using("bars", """SELECT symbol, date, "close",
    row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS session FROM bars"""))
def session_number(spark, sf):
    return fill.session_number(a.bars(spark, sf).select("symbol", "date", "close"))


_MOVES = """coalesce({v} > lag({v}) OVER w, false) AS entry,
    coalesce({v} < lag({v}) OVER w, false) AS "exit" """


@query(using("bars", f"""SELECT symbol, date, "close", {_MOVES.format(v='"close"')}
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)"""))
def momentum(spark, sf):
    return fill.momentum_signals(a.bars(spark, sf).select("symbol", "date", "close"))


@query("""SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS date, previous_date
FROM (SELECT *, CAST(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS DATE)
      AS previous_date FROM orders) WHERE previous_date > CAST(o_orderdate AS DATE)""")
def monotonic(spark, sf):
    """Orders dated before the customer's order stored ahead of them."""
    orders = a.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("date")
    )
    stored = Track(("o_custkey",), ("o_orderkey",), F.col("cell"))
    falling = fill.monotonic_check(even_cells(orders, "o_orderkey"), "date", stored)
    return falling.drop("cell")


def ticks_in_cells(spark, sf):
    return even_cells(a.ticks(spark, sf), "ts", "event_id", place="place")


def tick_track():
    return Track(("event_type",), ("place",), F.col("cell"))


_TB, _TA, _ = _sql("event_type", "ts, event_id")


@query(using("ticks", f"SELECT event_type, ts, event_id, {_TB} AS value FROM ticks"))
def ffill_ticks(spark, sf):
    return fill.ffill(ticks_in_cells(spark, sf), "value", tick_track()).drop("cell", "place")


@query(using("ticks", f"SELECT event_type, ts, event_id, {_TA} AS value FROM ticks"))
def bfill_ticks(spark, sf):
    return fill.bfill(ticks_in_cells(spark, sf), "value", tick_track()).drop("cell", "place")


@query(using("ticks", f"""SELECT event_type, ts, event_id, coalesce({_TB}, {_TA}) AS value
FROM ticks"""))
def ffill_bfill_ticks(spark, sf):
    return fill.ffill_bfill(ticks_in_cells(spark, sf), "value", tick_track()).drop("cell", "place")


@query(_line("ticks", "event_type", "ts, event_id", "event_type, ts, event_id"))
def interpolate_ticks(spark, sf):
    filled = fill.interpolate(ticks_in_cells(spark, sf), "value", tick_track())
    return rounded(filled, "value").drop("cell", "place")


@query("""SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type
    ORDER BY ts, event_id) - 1    AS session FROM events""")
def session_number_ticks(spark, sf):
    numbered = fill.session_number(ticks_in_cells(spark, sf), tick_track())
    return numbered.select("event_type", "event_id", "session")


@query(f"""SELECT event_type, event_id, value, {_MOVES.format(v="value")}
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def momentum_ticks(spark, sf):
    events = even_cells(a.table(spark, sf, "events"), "ts", "event_id", place="place")
    signals = fill.momentum_signals(events, "value", tick_track())
    return signals.select("event_type", "event_id", "value", "entry", "exit")
