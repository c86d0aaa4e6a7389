"""The driver tables seen as bars, series, timelines and calendars, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.align import align_to_base, outer_align
from barloom.operators.clean import series_to_ohlcv
from barloom.sources import bars_from_ticks, nyse_holidays, trading_calendar

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# Layout of the driver tables; naming it saves a look into the files.
LAYOUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUT[name]).parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})


def bars(spark: SparkSession, sf: str) -> DataFrame:
    """One symbol per user: prices of a day are the values of its events."""
    return bars_from_ticks(table(spark, sf, "events"), "user_id", "ts", "value")


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.to_date("ts").alias("date")).distinct()


def daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("date"))
        .agg(F.round(F.sum("value"), 2).alias("value"))
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One symbol per event type, priced at the day's total value."""
    return series_to_ohlcv(daily_totals(spark, sf), keep_value=False)


def series(spark: SparkSession, sf: str) -> DataFrame:
    """One series per order priority: the highest price of the day."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date")
        )
        .agg(F.max("o_totalprice").alias("value"))
    )


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order, ``actual`` once it is finished."""
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "F", "actual").otherwise("estimate").alias("data_flag"),
    )


def base_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions from the first to the last ship date."""
    span = table(spark, sf, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end")
    )
    return trading_calendar(span, nyse_holidays(spark, 1990, 2030))


def ranges(spark: SparkSession, sf: str) -> DataFrame:
    """One date range per customer: first to last order."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("symbol"))
        .agg(
            F.to_date(F.min("o_orderdate")).alias("start"),
            F.to_date(F.max("o_orderdate")).alias("end"),
        )
    )


def gapped_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Every symbol on every day, missing where it had no event."""
    return outer_align(bars(spark, sf), event_days(spark, sf), unique=True)


def gapped_series(spark: SparkSession, sf: str) -> DataFrame:
    return align_to_base(base_days(spark, sf), series(spark, sf), unique=True).drop("present")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Single events in five long series; values under 5 count as missing."""
    return table(spark, sf, "events").select(
        "event_type",
        "ts",
        "event_id",
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )


# Tables named in the SQL below, each built from the driver's views.
VIEWS = {
    "bars": """SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date,
        arg_min(value, ts) AS "open", max(value) AS high, min(value) AS low,
        arg_max(value, ts) AS "close", count(*) AS volume
        FROM events GROUP BY 1, 2""",
    "event_days": "SELECT DISTINCT CAST(ts AS DATE) AS date FROM events",
    "panel": """SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
        round(sum(value), 2) AS "close" FROM events GROUP BY 1, 2""",
    "series": """SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
        max(o_totalprice) AS value FROM orders GROUP BY 1, 2""",
    "tagged": """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker,
        o_totalprice AS value,
        CASE WHEN o_orderstatus = 'F' THEN 'actual' ELSE 'estimate' END AS data_flag
        FROM orders""",
    "base_days": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem",
    "days": """SELECT CAST(d AS DATE) AS date, dayofweek(d) AS dow, month(d) AS m,
        dayofmonth(d) AS dom, year(d) AS y
        FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate),
              INTERVAL 1 DAY)) AS d FROM lineitem)""",
    "sessions": """SELECT date FROM days WHERE dow BETWEEN 1 AND 5 AND NOT (
        (m = 1 AND dow = 1 AND dom BETWEEN 15 AND 21 AND y >= 1998)
        OR (m = 2 AND dow = 1 AND dom BETWEEN 15 AND 21)
        OR (m = 5 AND dow = 1 AND dom >= 25)
        OR (m = 9 AND dow = 1 AND dom <= 7)
        OR (m = 11 AND dow = 4 AND dom BETWEEN 22 AND 28)
        OR (m = 1 AND (dom = 1 OR (dom = 2 AND dow = 1)))
        OR (m = 7 AND (dom = 4 OR (dom = 5 AND dow = 1) OR (dom = 3 AND dow = 5)))
        OR (m = 12 AND (dom = 25 OR (dom = 26 AND dow = 1) OR (dom = 24 AND dow = 5)))
        OR date IN (DATE '1995-04-14', DATE '1996-04-05', DATE '1997-03-28', DATE '1998-04-10',
                    DATE '1999-04-02', DATE '2000-04-21', DATE '2001-04-13',
                    DATE '2001-09-11', DATE '2001-09-12', DATE '2001-09-13', DATE '2001-09-14'))""",
    "calendar": """SELECT date, row_number() OVER (ORDER BY date) - 1 AS seq,
        lag(date) OVER (ORDER BY date) AS prev_day, lead(date) OVER (ORDER BY date) AS next_day
        FROM sessions""",
    "ranges": """SELECT CAST(o_custkey AS VARCHAR) AS symbol,
        CAST(min(o_orderdate) AS DATE) AS "start", CAST(max(o_orderdate) AS DATE) AS "end"
        FROM orders GROUP BY 1""",
    "gapped_bars": """SELECT s.symbol, d.date, b."open", b.high, b.low, b."close", b.volume
        FROM (SELECT DISTINCT symbol FROM bars) s CROSS JOIN event_days d
        LEFT JOIN bars b ON b.symbol = s.symbol AND b.date = d.date""",
    "gapped_series": """SELECT i.series_id, d.date, s.value, s.date IS NOT NULL AS present
        FROM (SELECT DISTINCT series_id FROM series) i CROSS JOIN base_days d
        LEFT JOIN series s ON s.series_id = i.series_id AND s.date = d.date""",
    "ticks": """SELECT event_type, ts, event_id, CASE WHEN value >= 5 THEN value END AS value
        FROM events""",
    "rets": """SELECT symbol, date, "close",
        "close" / lag("close") OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret FROM panel""",
}

NEEDS = {
    "sessions": ["days"],
    "calendar": ["days", "sessions"],
    "gapped_bars": ["bars", "event_days"],
    "gapped_series": ["series", "base_days"],
    "rets": ["panel"],
}


def using(names: str, body: str) -> str:
    """``body`` with the named views (and what they need) in front of it."""
    wanted: list[str] = []
    for name in names.split():
        for n in [*NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted) + "\n" + body


def s6(expression: str) -> str:
    return f"(round({expression}, 6) + CAST(0 AS DOUBLE))"
