"""Joins, calendars and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import align, clean
from barloom.sources import synthesize
from checks import adapters as a
from checks.registry import query
from checks.adapters import using


@query(using("gapped_bars", """
SELECT symbol, date, coalesce(
    last_value("close" IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value("close" IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS "close"
FROM gapped_bars"""))
def aligned_close(spark, sf):
    """Daily close per symbol on every day any symbol has, gaps filled."""
    closes = a.bars(spark, sf).select("symbol", "date", "close")
    days = a.event_days(spark, sf)
    return align.outer_align(closes, days, ["close"], fill="ffill_bfill", unique=True)


@query(using("gapped_bars", "SELECT * FROM gapped_bars"))
def outer_align(spark, sf):
    return a.gapped_bars(spark, sf)


@query(using("gapped_series", "SELECT * FROM gapped_series"))
def align_base(spark, sf):
    return align.align_to_base(a.base_days(spark, sf), a.series(spark, sf), unique=True)


@query(using("gapped_series", """
SELECT series_id, date, present, last_value(value IGNORE NULLS) OVER (
    PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM gapped_series"""))
def align_base_ffill(spark, sf):
    """Alignment and forward fill in one pass."""
    series = a.series(spark, sf)
    return align.align_to_base(a.base_days(spark, sf), series, fill="ffill", unique=True)


_ORDERS = """o AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
    o_totalprice AS value FROM orders)"""


@query(using("base_days", f""", {_ORDERS},
f AS (SELECT series_id, date, min(value) AS value FROM o GROUP BY 1, 2)
SELECT i.series_id, d.date, f.value, f.date IS NOT NULL AS present
FROM (SELECT DISTINCT series_id FROM o) i CROSS JOIN base_days d
LEFT JOIN f ON f.series_id = i.series_id AND f.date = d.date"""))
def align_base_repeats(spark, sf):
    """Single orders as observations: days repeat, and the least price of a day counts."""
    return align.align_to_base(a.base_days(spark, sf), _observations(spark, sf))


def _observations(spark, sf):
    return a.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("value"),
    )


@query(f"""WITH {_ORDERS}, e AS (SELECT *, row_number() OVER (PARTITION BY series_id, date
    ORDER BY -value) AS place FROM o), days AS (SELECT DISTINCT date FROM o)
SELECT i.series_id, d.date, e.value FROM (SELECT DISTINCT series_id FROM o) i CROSS JOIN days d
LEFT JOIN e ON e.series_id = i.series_id AND e.date = d.date AND place = 1""")
def outer_align_arrival(spark, sf):
    """Days repeat and the dearest order of a day comes first."""
    came = _observations(spark, sf).withColumn("came", -F.col("value"))
    return align.outer_align(came, values=["value"], key="series_id", arrival=["came"])


@query(using("gapped_series", """
SELECT series_id, CAST(count(*) FILTER (present) AS BIGINT) AS matches,
    CAST(count(*) FILTER (NOT present) AS BIGINT) AS misses
FROM gapped_series GROUP BY 1"""))
def alignment_report(spark, sf):
    return align.alignment_report(a.base_days(spark, sf), a.series(spark, sf))


@query(using("base_days", f""", {_ORDERS}
SELECT series_id, count(DISTINCT b.date) AS matches,
    (SELECT count(*) FROM base_days) - count(DISTINCT b.date) AS misses
FROM o LEFT JOIN base_days b ON b.date = o.date GROUP BY 1"""))
def alignment_report_repeats(spark, sf):
    """Days observed any number of times match once."""
    return align.alignment_report(a.base_days(spark, sf), _observations(spark, sf))


_FILLED = """SELECT series_id, date, coalesce(
    last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM gapped_series"""


@query(using("gapped_series", f"""
SELECT CAST(l.l_partkey AS VARCHAR) AS symbol, CAST(l.l_shipdate AS DATE) AS date,
    l.l_extendedprice AS price,
    {", ".join(f'''p{i}.value AS "Value_{p}"''' for i, p in enumerate(a.PRIORITIES))}
FROM lineitem l
{" ".join(f'''LEFT JOIN ({_FILLED}) p{i}
    ON p{i}.series_id = '{p}' AND p{i}.date = CAST(l.l_shipdate AS DATE)'''
          for i, p in enumerate(a.PRIORITIES))}"""))
def attach_series(spark, sf):
    """Every shipped line with the day's value of each order series."""
    lines = a.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("price"),
    )
    return align.attach_series(
        lines, a.series(spark, sf), a.PRIORITIES, a.base_days(spark, sf), unique=True
    )


@query(using("calendar", "SELECT * FROM calendar"))
def trading_calendar(spark, sf):
    return a.calendar(spark, sf).withColumn("seq", F.col("seq").cast("bigint"))


@query(using("calendar", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) IN (SELECT date FROM calendar)"""))
def on_calendar(spark, sf):
    return align.on_calendar(_orders(spark, sf), a.calendar(spark, sf))


@query(using("calendar", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT date FROM calendar)"""))
def off_calendar(spark, sf):
    return align.off_calendar(_orders(spark, sf), a.calendar(spark, sf))


def _orders(spark, sf):
    return a.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date")
    )


_ROLLED = """rolled AS (SELECT r.*,
    (SELECT min(date) FROM calendar c WHERE c.date >= r."start") AS f,
    (SELECT max(date) FROM calendar c WHERE c.date <= r."end") AS l FROM ranges r)"""


@query(using("ranges calendar", f""", {_ROLLED}
SELECT symbol, "start", "end",
    CASE WHEN f <= l THEN f END AS first_session, CASE WHEN f <= l THEN l END AS last_session,
    CASE WHEN f <= l THEN NULL ELSE 'no session in range' END AS finding
FROM rolled"""))
def roll_session(spark, sf):
    """Each customer's range of orders moved inwards to sessions."""
    return align.roll_to_session(a.ranges(spark, sf), a.calendar(spark, sf))


@query(using("calendar", """
SELECT min(date) FILTER (date >= DATE '1996-12-25') AS first_session,
    max(date) FILTER (date <= DATE '2000-01-02') AS last_session FROM calendar"""))
def session_ends(spark, sf):
    """First session from a day on, last session up to a day."""
    sessions = a.calendar(spark, sf)
    first = align.first_session_from(sessions, "1996-12-25").scalar()
    last = align.last_session_until(sessions, "2000-01-02").scalar()
    return spark.range(1).select(first.alias("first_session"), last.alias("last_session"))


_SPEC = """spec AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
    CAST(min(l_shipdate) AS DATE) AS "start", CAST(max(l_shipdate) AS DATE) AS "end",
    CASE WHEN s_nationkey < 8 THEN 'cash' WHEN s_nationkey < 16 THEN 'linear'
         WHEN s_nationkey < 20 THEN 'square' END AS data_type,
    abs(s_acctbal) AS start_value, 0.25::DOUBLE AS growth_rate
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY l_suppkey, s_nationkey, s_acctbal)"""


@query(using("calendar", f""", {_SPEC},
placed AS (SELECT s.*, c.date, c.seq - min(c.seq) OVER (PARTITION BY s.symbol) AS i
    FROM spec s JOIN calendar c ON c.date BETWEEN s."start" AND s."end"
    WHERE coalesce(data_type, '') <> 'square'),
priced AS (SELECT symbol, date, CASE WHEN coalesce(data_type, 'linear') = 'linear'
    THEN start_value + i * growth_rate ELSE start_value END AS p FROM placed)
SELECT symbol, date, p AS "open", p AS high, p AS low, p AS "close",
    CAST(10000 AS BIGINT) AS volume FROM priced"""))
def synthetic(spark, sf):
    """A made-up symbol per supplier, started at the account balance."""
    return synthesize(_spec(spark, sf), a.calendar(spark, sf))[0]


def _spec(spark, sf):
    spans = a.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end")
    )
    nation = F.col("s_nationkey")
    kind = F.when(nation < 8, "cash").when(nation < 16, "linear").when(nation < 20, "square")
    suppliers = a.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("s_suppkey").cast("string").alias("symbol"),
        kind.alias("data_type"),
        F.abs("s_acctbal").alias("start_value"),
        F.lit(0.25).alias("growth_rate"),
    )
    return spans.join(suppliers, "l_suppkey").drop("l_suppkey")


@query(using("calendar", f""", {_SPEC}
SELECT symbol, data_type, 'unsupported data type' AS finding FROM spec
WHERE data_type = 'square'
UNION ALL SELECT symbol, coalesce(data_type, 'linear'), 'no sessions in range'
FROM spec s WHERE coalesce(data_type, '') <> 'square' AND NOT EXISTS
    (SELECT 1 FROM calendar c WHERE c.date BETWEEN s."start" AND s."end")"""))
def synthetic_findings(spark, sf):
    return synthesize(_spec(spark, sf), a.calendar(spark, sf))[1]


@query(using("bars panel", """
SELECT symbol, date, "close" FROM bars UNION ALL SELECT symbol, date, "close" FROM panel"""))
def union_symbols(spark, sf):
    return align.union_symbols(
        a.bars(spark, sf).select("symbol", "date", "close"),
        clean.select_ohlcv(a.panel(spark, sf)).select("symbol", "date", "close"),
    )
