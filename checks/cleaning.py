"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import (
    day,
    day_in_zone,
    flatten_header,
    normalize_symbol,
    strip_header,
    text_before_underscore,
    wide_name,
)
from barloom.operators import clean
from barloom.schemas import FIELDS
from barloom.shared import land, new_path
from barloom.sources import bars_from_ticks
from checks import adapters as a
from checks.adapters import using
from checks.registry import query


@query("""SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
    o_totalprice AS "open", o_totalprice AS high, o_totalprice AS low, o_totalprice AS "close",
    CAST(0 AS BIGINT) AS volume, o_totalprice AS value FROM orders""")
def prj_series_to_ohlcv(spark, sf):
    orders = a.tagged(spark, sf).withColumnRenamed("ticker", "series_id")
    return clean.series_to_ohlcv(orders)


@query(using("gapped_series", """, f AS (SELECT series_id, date, last_value(value IGNORE NULLS)
    OVER (PARTITION BY series_id ORDER BY date
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM gapped_series)
SELECT series_id AS symbol, date, v AS "open", v AS high, v AS low, v AS "close",
    CAST(0 AS BIGINT) AS volume FROM f"""))
def prj_repaired_ohlcv(spark, sf):
    return clean.repaired_series_to_ohlcv(a.gapped_series(spark, sf), "forward_fill")


@query(using("bars", 'SELECT symbol, date, "open", high, low, "close", volume FROM bars'))
def prj_select_ohlcv(spark, sf):
    return clean.select_ohlcv(a.bars(spark, sf).withColumn("spread", F.col("high") - F.col("low")))


@query(using("bars", f"""SELECT date, {", ".join(
    f'''max(CASE WHEN symbol = '{s}' THEN "{f}" END) AS "{wide_name(f, s)}"'''
    for s in a.EVENT_TYPES for f in FIELDS)}
FROM (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, arg_min(value, ts) AS "open",
    max(value) AS high, min(value) AS low, arg_max(value, ts) AS "close", count(*) AS volume
    FROM events GROUP BY 1, 2) GROUP BY date"""))
def prj_to_wide(spark, sf):
    return clean.to_wide(_type_bars(spark, sf), a.EVENT_TYPES)


def _type_bars(spark, sf):
    return bars_from_ticks(a.table(spark, sf, "events"), "event_type", "ts", "value")


@query("SELECT c_custkey, upper(trim('  ' || lower(c_name) || ' ')) AS symbol FROM customer")
def prj_normalize_symbol(spark, sf):
    raw = F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))
    return a.table(spark, sf, "customer").select("c_custkey", normalize_symbol(raw).alias("symbol"))


@query("SELECT p_partkey, p_name FROM part")
def prj_drop_unnamed(spark, sf):
    parts = a.table(spark, sf, "part").select("p_partkey", "p_name")
    return clean.drop_unnamed(parts.withColumn("Unnamed: 0", F.col("p_partkey") - 1))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def prj_drop_duplicate_columns(spark, sf):
    suppliers = a.table(spark, sf, "supplier")
    return clean.drop_duplicate_columns(
        suppliers.select(
            "s_suppkey", "s_name", "s_acctbal", F.lower("s_name").alias("s_name"),
            (F.col("s_suppkey") * 2).alias("s_suppkey"),
        )
    )


@query("""SELECT p_partkey AS date, p_retailprice AS spy_close, p_size AS spy_volume FROM part""")
def prj_flatten_headers(spark, sf):
    parts = a.table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    return clean.flatten_headers(parts, [("Date", ""), ("SPY", "Close"), ("SPY", "Volume")])


@query("""SELECT p_partkey, lower(p_brand || CASE WHEN p_type <> '' THEN '_' || p_type ELSE '' END)
    AS name FROM part""")
def prj_flatten_cells(spark, sf):
    return a.table(spark, sf, "part").select(
        "p_partkey", flatten_header(F.col("p_brand"), F.col("p_type")).alias("name")
    )


@query("""SELECT s_suppkey, trim(' (''' || s_name || ''')" ', ' ''"()') AS name FROM supplier""")
def prj_clean_headers(spark, sf):
    dirty = F.concat(F.lit(" ('"), F.col("s_name"), F.lit("')\" "))
    return a.table(spark, sf, "supplier").select("s_suppkey", strip_header(dirty).alias("name"))


@query("""SELECT split_part(name, '_', 1) AS symbol, arg_max(name, p_partkey) AS column_name
FROM (SELECT p_partkey, lower(replace(p_brand, '#', '')) || '_' || lower(p_type) AS name FROM part)
GROUP BY 1""")
def prj_symbol_column(spark, sf):
    """Of the column names that share a prefix the last wins."""
    name = F.concat_ws("_", F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lower("p_type"))
    cells = a.table(spark, sf, "part").select(name.alias("name"), "p_partkey")
    return clean.symbol_column(cells, place="p_partkey")


@query("""SELECT DISTINCT CAST(ts AS DATE) AS date, max(value) OVER
    (PARTITION BY event_type, CAST(ts AS DATE)) AS value FROM events
WHERE event_type = 'view'""")
def prj_target_series(spark, sf):
    return clean.target_series(_type_bars(spark, sf), ("VIEW", "High"))


@query(using("bars", """SELECT symbol, date, "open", high, low, "close", volume FROM bars"""))
def prj_cast_ohlcv(spark, sf):
    texts = a.bars(spark, sf).select(
        "symbol", "date", *[F.col(f).cast("string").alias(f) for f in FIELDS]
    )
    return clean.cast_ohlcv(texts)


@query("""SELECT o_orderkey, try_cast(CASE WHEN o_orderstatus = 'P' THEN 'abc'
    ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS DOUBLE) AS value FROM orders""")
def prj_coerce_numeric(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "abc").otherwise(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".5"))
    )
    texts = a.table(spark, sf, "orders").select("o_orderkey", text.alias("value"))
    return clean.coerce_numeric(texts, ["value"])


@query("""SELECT event_id, CAST(ts AS DATE) AS ntz_day, CAST(ts AS DATE) AS text_day,
    CAST(ts - INTERVAL 5 HOUR AS DATE) AS zone_day FROM events""")
def prj_normalize_day(spark, sf):
    """Day of a timestamp, of text with a zone, and of an instant on a wall clock."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00"))
    return a.table(spark, sf, "events").select(
        "event_id",
        day(F.col("ts")).alias("ntz_day"),
        day(text).alias("text_day"),
        day_in_zone(F.col("ts").cast("timestamp"), "America/New_York").alias("zone_day"),
    )


@query("""SELECT c.c_custkey, CAST(c.c_nationkey AS VARCHAR) AS symbol,
    CASE WHEN n.n_regionkey < 3 THEN n.n_name ELSE CAST(c.c_nationkey AS VARCHAR) END AS alias
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def prj_with_alias(spark, sf):
    names = a.table(spark, sf, "nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").cast("string").alias("symbol"), F.col("n_name").alias("alias")
    )
    customers = a.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("symbol")
    )
    return clean.with_alias(customers, names)


@query(using("tagged", """SELECT date, value AS "2-HIGH" FROM tagged
WHERE ticker = '2-HIGH' AND data_flag = 'actual'"""))
def prj_series_as_column(spark, sf):
    return clean.series_as_column(a.tagged(spark, sf), "2-HIGH")


@query("SELECT p_partkey, split_part(lower(p_type) || '_x', '_', 1) AS prefix FROM part")
def prj_prefix(spark, sf):
    name = F.concat(F.lower("p_type"), F.lit("_x"))
    return a.table(spark, sf, "part").select(
        "p_partkey", text_before_underscore(name).alias("prefix")
    )


@query(using("tagged", "SELECT * FROM tagged WHERE ticker = '1-URGENT'"))
def flt_ticker(spark, sf):
    return clean.filter_ticker(a.tagged(spark, sf), "1-URGENT")


@query(using("tagged", "SELECT * FROM tagged WHERE data_flag = 'actual'"))
def flt_actual(spark, sf):
    return clean.filter_actual(a.tagged(spark, sf))


@query(using("tagged", """, asked AS (SELECT o_orderpriority AS ticker,
    DATE '1996-03-01' AS s, CAST(max(o_orderdate) AS DATE) - 400 AS e FROM orders GROUP BY 1)
SELECT t.* FROM tagged t JOIN asked USING (ticker) WHERE t.date BETWEEN s AND e"""))
def flt_window(spark, sf):
    """Each ticker inside its own requested range."""
    requests = a.tagged(spark, sf).groupBy(F.col("ticker").alias("symbol")).agg(
        F.lit("1996-03-01").alias("start"),
        F.date_format(F.date_sub(F.max("date"), 400), "yyyy-MM-dd").alias("end"),
    )
    stored = land(clean.resolve_requests(requests), new_path(spark, "requests"))
    return clean.filter_window(a.tagged(spark, sf), stored, "ticker")


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 1 THEN DATE '2020-01-01'
    ELSE DATE '1999-02-03' END AS "start",
    CASE WHEN c_nationkey < 5 THEN current_date ELSE DATE '2001-05-06' END AS "end"
FROM customer""")
def flt_resolve_requests(spark, sf):
    """Absent start and open end of a request."""
    nation = F.col("c_nationkey")
    requests = a.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(nation != 1, "1999-02-03").alias("start"),
        F.when(nation < 3, "current").when(nation >= 5, "2001-05-06").alias("end"),
    )
    return clean.resolve_requests(requests)


@query("SELECT DISTINCT o_orderpriority AS ticker FROM orders")
def flt_tickers(spark, sf):
    return clean.tickers(a.tagged(spark, sf))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS symbol,
    c_custkey IN (SELECT user_id FROM events) AS configured FROM customer""")
def flt_configured(spark, sf):
    """Customers with settings (here: that are users), and those without."""
    customers = a.table(spark, sf, "customer")
    requested = customers.select(F.col("c_custkey").cast("string").alias("symbol"))
    users = a.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("symbol"))
    keep, report = clean.configured_only(requested, users)
    return keep.withColumn("configured", F.lit(True)).union(
        report.withColumn("configured", F.lit(False))
    )


@query(using("bars", 'SELECT symbol, date, "close" FROM bars'))
def sort_by_date(spark, sf):
    return clean.sort_by_date(a.bars(spark, sf).select("symbol", "date", "close"))


@query(using("bars", 'SELECT symbol, date, "close" FROM bars ORDER BY date, symbol LIMIT 5'))
def preview(spark, sf):
    closes = a.bars(spark, sf).select("symbol", "date", "close")
    return clean.preview(closes, ["date", "symbol"])


@query("""SELECT event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts) <= 5""")
def preview_each(spark, sf):
    events = a.table(spark, sf, "events").select("event_type", "ts", "value")
    return clean.preview_each(events, "event_type", ["ts"])
