"""Counts and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import quality
from barloom.shared import new_path
from barloom.track import Track, even_cells
from checks import adapters as a
from checks.adapters import using
from checks.registry import query


@query("""SELECT 'orders' AS dataset, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def agg_row_counts(spark, sf):
    return quality.row_counts(
        orders=a.table(spark, sf, "orders"), lineitem=a.table(spark, sf, "lineitem")
    )


@query(using("gapped_bars", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count("{c}") AS n_present,
    count("{c}") = 0 AS all_missing, count("{c}") > 0 AS any_present FROM gapped_bars"""
    for c in ("symbol", "date", "open", "high", "low", "close", "volume"))))
def agg_missing_profile(spark, sf):
    return quality.missing_profile(a.gapped_bars(spark, sf))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def agg_emptiness(spark, sf):
    """Customers without a bar."""
    asked = a.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return quality.emptiness(asked, a.bars(spark, sf))


@query(using("tagged", """SELECT date, ticker, count(*) AS n_rows FROM tagged
GROUP BY 1, 2 HAVING count(*) > 1"""))
def agg_duplicate_keys(spark, sf):
    return quality.duplicate_keys(a.tagged(spark, sf), ["date", "ticker"])


@query("""SELECT 'ohlcv' AS "check", 'open' AS subject, 'column is missing' AS detail
UNION ALL SELECT 'ohlcv', 'volume', 'type is not integer'
UNION ALL SELECT 'ohlcv', CAST(o_custkey AS VARCHAR),
    'date falls to ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p
      FROM orders) WHERE p > o_orderdate""")
def val_ohlcv(spark, sf):
    """Orders as bars that lack a column, have a wrong type, and are out of order."""
    price = F.col("o_totalprice")
    orders = a.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("date"), price.alias("high"),
        price.alias("low"), price.alias("close"), price.alias("volume"),
    )
    stored = Track(("o_custkey",), ("o_orderkey",), F.col("cell"))
    return quality.check_ohlcv(even_cells(orders, "o_orderkey"), stored)


@query("""SELECT event_type AS symbol, 'Close' AS column_name, 2::BIGINT AS n_uses
FROM events GROUP BY 1""")
def val_header_lines(spark, sf):
    """One file per symbol, each with a header that names a column twice."""
    path = new_path(spark, "headers")
    events = a.table(spark, sf, "events")
    body = events.select(
        "event_type",
        F.concat_ws(",", F.to_date("ts"), "value", "event_id", "value").alias("value"),
    )
    heads = events.select("event_type").distinct().withColumn(
        "value", F.lit("Date,Close,Volume,Close")
    )
    body.union(heads).write.partitionBy("event_type").text(path)
    symbol = F.regexp_extract("file", "event_type=([^/]+)/", 1).alias("symbol")
    return quality.check_header_lines(spark, path).select(symbol, "column_name", "n_uses")


@query("""SELECT 'lines' AS dataset, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders""")
def val_reconcile_counts(spark, sf):
    """Differing counts are all listed; equal ones would give no row."""
    return quality.reconcile_counts(
        lines=a.table(spark, sf, "lineitem"), orders=a.table(spark, sf, "orders")
    )


@query("SELECT 'c_name' AS column_name FROM customer HAVING count(try_cast(c_name AS DOUBLE)) = 0")
def val_numeric(spark, sf):
    from barloom.operators.clean import coerce_numeric

    columns = ["c_name", "c_acctbal", "c_custkey"]
    numbers = coerce_numeric(a.table(spark, sf, "customer"), columns)
    return quality.check_numeric(numbers, columns)


@query("""SELECT symbol, finding FROM (
    SELECT CAST(c_custkey AS VARCHAR) AS symbol, 'no rows' AS finding FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT symbol, 'date falls' FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderdate, lag(o_orderdate) OVER
        (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders) WHERE p > o_orderdate)""")
def val_generated(spark, sf):
    asked = a.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    stored = a.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"), "o_orderkey",
        F.to_date("o_orderdate").alias("date"),
    )
    track = Track(("symbol",), ("o_orderkey",), F.col("cell"))
    return quality.check_generated(asked, even_cells(stored, "o_orderkey"), track)


_TEXT = """SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN '2020-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END
        AS "start",
    CASE o_orderpriority WHEN '1-URGENT' THEN 'current' WHEN '2-HIGH' THEN 'later'
        ELSE '1998-06-30' END AS "end" FROM orders"""


@query(f"""SELECT *, CASE WHEN try_strptime("start", '%Y-%m-%d') IS NULL THEN 'start is no date'
    WHEN "end" <> 'current' AND try_strptime("end", '%Y-%m-%d') IS NULL THEN 'end is no date'
    WHEN "end" <> 'current' AND "start" > "end" THEN 'start after end' END AS finding
FROM ({_TEXT}) WHERE finding IS NOT NULL""")
def val_ranges(spark, sf):
    priority = F.col("o_orderpriority")
    texts = a.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "2020-13-01")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("start"),
        F.when(priority == "1-URGENT", "current")
        .when(priority == "2-HIGH", "later")
        .otherwise("1998-06-30")
        .alias("end"),
    )
    return quality.check_ranges(texts)


@query("""SELECT p_name AS alias, count(*) AS n_uses FROM part GROUP BY 1 HAVING count(*) > 1""")
def val_aliases(spark, sf):
    aliases = a.table(spark, sf, "part").select(
        F.col("p_brand").alias("source"), F.col("p_partkey").cast("string").alias("symbol"),
        F.col("p_name").alias("alias"),
    )
    return quality.check_aliases(aliases)


@query("""SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol,
    CASE WHEN c_nationkey < 5 THEN 'spread' ELSE 'close' END AS field FROM customer
WHERE c_nationkey < 5 OR c_custkey NOT IN (SELECT user_id FROM events)""")
def val_targets(spark, sf):
    """Customers asked for among the users; some with a field no bar has."""
    field = F.when(F.col("c_nationkey") < 5, "Spread").otherwise("Close")
    asked = a.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("symbol"), field.alias("field")
    )
    return quality.check_targets(asked, a.bars(spark, sf))


@query("""SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, count(*) AS n_rows,
    'repeated key' AS finding FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def val_keys(spark, sf):
    keyed = a.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return quality.check_keys(keyed, ["o_custkey", "date"])


@query("""SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n_rows,
    'repeated key' AS finding FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def val_tick_keys(spark, sf):
    """Ticks that share symbol and time. By the microsecond there are none here, by the hour some."""
    events = a.table(spark, sf, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    )
    return quality.check_keys(events, ["user_id", "hour"])
