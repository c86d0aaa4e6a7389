"""Sinks and whole runs: what was written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom import sinks
from barloom.operators import quality, risk
from barloom.plans import generated_run, holding_run, market_run
from barloom.shared import new_path
from barloom.sources import nyse_holidays, trading_calendar
from checks import adapters as a
from checks.adapters import rounded, s6, using
from checks.portfolios import _AB, _FIGURES, _STATS, _panel
from checks.reading import (
    _TYPE_BARS,
    _bar_requests,
    _provide,
    _upper_bars,
    two_header_csv,
    type_bars,
)
from checks.registry import query

_BAR_TYPES = (
    "symbol string, date date, open double, high double, low double, close double, volume bigint"
)


@query(using("bars", """SELECT symbol, date, "open", high, low, "close", volume FROM bars"""))
def sink_dual(spark, sf):
    """The rows of the CSV copy that the Parquet copy has as well."""
    folder = new_path(spark, "dual")
    kept = sinks.write_dual(a.bars(spark, sf), folder, "bars")
    text = spark.read.schema(_BAR_TYPES).option("header", True).csv(f"{folder}/bars.csv")
    return text.intersectAll(kept)


@query(using("series", "SELECT * FROM series"))
def sink_checked(spark, sf):
    return sinks.write_checked(a.series(spark, sf), new_path(spark, "checked"))


@query("""SELECT n_name AS name, 'name occurs again' AS detail FROM nation""")
def sink_checked_refused(spark, sf):
    """A frame that has a column per nation twice is refused and nothing is written."""
    names = [r.n_name for r in a.table(spark, sf, "nation").select("n_name").distinct().collect()]
    twice = a.series(spark, sf).select("*", *[F.lit(0).alias(n) for n in names + names])
    found = quality.check_duplicate_columns(spark, twice.columns)
    try:
        sinks.write_checked(twice, new_path(spark, "refused"))
    except quality.FindingsError:
        return found.select(F.col("subject").alias("name"), "detail")
    raise AssertionError("a repeated column was written")


@query("""SELECT n.n_name AS alias, CAST(o_orderdate AS DATE) AS "Date", o_orderkey, o_totalprice
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation n ON n_nationkey = c_nationkey""")
def sink_by_alias(spark, sf):
    path = new_path(spark, "alias")
    orders = (
        a.table(spark, sf, "orders")
        .join(a.table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(a.table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice",
            F.col("n_name").alias("alias"),
        )
    )
    sinks.write_by_alias(orders, path)
    schema = "Date date, o_orderkey bigint, o_totalprice double, alias string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query(using("bars", """SELECT date, symbol AS ticker, "open", high, low, "close", volume
FROM bars"""))
def sink_table(spark, sf):
    named = a.bars(spark, sf).withColumnRenamed("symbol", "ticker")
    untidy = named.select("*", F.col("volume").cast("string").alias("volume"))
    sinks.replace_table(untidy, "yahoo_data", new_path(spark, "table"))
    return spark.table("yahoo_data")


@query(using("series", "SELECT count(*) AS n_rows, 0::BIGINT AS n_findings FROM series"))
def sink_reconcile(spark, sf):
    series = a.series(spark, sf).withColumnRenamed("series_id", "ticker").withColumn(
        "data_flag", F.lit("actual")
    )
    table, text = new_path(spark, "table"), new_path(spark, "csv")
    findings = sinks.write_and_reconcile(series, "fred_data", text, table)
    return spark.table("fred_data").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", findings.agg(F.count(F.lit(1))).scalar().alias("n_findings")
    )


@query(using("rets", f""", {_STATS}, {_AB}
SELECT st.* EXCLUDE (start_date, end_date), CAST(st.start_date AS VARCHAR) AS start_date,
    benchmark, alpha, beta FROM st JOIN ab USING (symbol)"""))
def sink_metrics_json(spark, sf):
    path = new_path(spark, "metrics")
    marks = ["view", "click"]
    report = rounded(
        risk.metrics_report(_panel(spark, sf), None, marks), *_FIGURES, "alpha", "beta"
    )
    sinks.write_metrics_json(report, marks, path)
    figures = ("start_value", "end_value", *_FIGURES)
    schema = (
        "metadata struct<ticker string, start_date string>, "
        f"metrics struct<{', '.join(f'{f} double' for f in figures)}>, "
        "benchmark_comparison array<struct<benchmark string, alpha double, beta double>>"
    )
    return spark.read.schema(schema).json(path).select(
        F.col("metadata.ticker").alias("symbol"), "metadata.start_date", "metrics.*",
        F.inline("benchmark_comparison"),
    )


def _filled(column):
    w = "PARTITION BY s.symbol ORDER BY d.date ROWS BETWEEN"
    return f"""coalesce(last_value(b.{column} IGNORE NULLS) OVER ({w} UNBOUNDED PRECEDING
    AND CURRENT ROW), first_value(b.{column} IGNORE NULLS) OVER ({w} CURRENT ROW
    AND UNBOUNDED FOLLOWING)) AS {column}"""


@query(f"""WITH span AS (SELECT min(date) lo, max(date) hi
    FROM (SELECT CAST(ts AS DATE) AS date FROM events)
    WHERE dayofweek(date) BETWEEN 1 AND 5
    AND date NOT IN (DATE '2024-01-01', DATE '2024-01-15')),
b AS (SELECT t.* FROM ({_TYPE_BARS}) t, span
    WHERE date BETWEEN lo AND hi AND (dayofmonth(date) + length(symbol)) % 3 <> 0),
v AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(sum(value), 2) AS value
    FROM events GROUP BY 1, 2),
f AS (SELECT s.symbol, d.date, {", ".join(map(_filled, ('"open"', "high", "low", '"close"', "volume")))}
    FROM (SELECT DISTINCT symbol FROM b) s CROSS JOIN (SELECT DISTINCT date FROM b) d
    LEFT JOIN b ON b.symbol = s.symbol AND b.date = d.date)
SELECT upper(f.symbol) AS symbol, f.* EXCLUDE (symbol), x.value AS "Value_click",
    y.value AS "Value_view"
FROM f LEFT JOIN v x ON x.series_id = 'click' AND x.date = f.date
LEFT JOIN v y ON y.series_id = 'view' AND y.date = f.date""")
def run_market(spark, sf):
    """Ranges rolled, bars fetched, gaps filled, repeated days cut to their first row, two series
    attached, all saved. The provider lacks days and gives every bar twice, first the right one."""
    span = a.table(spark, sf, "events").agg(
        F.to_date(F.min("ts")).alias("start"), F.to_date(F.max("ts")).alias("end")
    )
    sessions = trading_calendar(span, nyse_holidays(spark, 2020, 2030))
    asked = _bar_requests(spark, sf)
    gapped = _upper_bars(spark, sf).where((F.dayofmonth("date") + F.length("symbol")) % 3 != 0)
    wrong = gapped.withColumns({"close": F.lit(0.0), "volume": F.lit(None).cast("bigint")})
    twice = gapped.withColumn("turn", F.lit(0)).union(wrong.withColumn("turn", F.lit(1)))
    return market_run(
        asked,
        asked.withColumn("symbol", F.trim("symbol")),
        ["click", "view"],
        sessions,
        _provide(twice, "symbol", "date", "turn"),
        _provide(a.daily_totals(spark, sf), "series_id"),
        new_path(spark, "run"),
    )


_HOLDING = f"""WITH rets AS (SELECT symbol, date, "close",
    "close" / lag("close") OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret
    FROM (SELECT symbol, date, 100 * high / first_value(high) OVER (ORDER BY date) AS "close"
          FROM ({_TYPE_BARS}) WHERE symbol = 'view')), {_STATS}
SELECT * REPLACE ({s6("start_value")} AS start_value, {s6("end_value")} AS end_value) FROM st"""


@query(_HOLDING)
def run_holding(spark, sf):
    """Buy and hold of one (symbol, field) target."""
    figures = holding_run(type_bars(spark, sf), ["VIEW", "high"])
    return rounded(figures, "start_value", "end_value", *_FIGURES)


@query(_HOLDING)
def run_holding_csv(spark, sf):
    """The same from a CSV with two header lines."""
    figures = holding_run(two_header_csv(spark, sf), ["VIEW", "high"], spark=spark)
    return rounded(figures, "start_value", "end_value", *_FIGURES)


_NATIONS = """spec AS (SELECT n_name AS symbol, CAST(min(o_orderdate) AS DATE) AS "start",
    CAST(max(o_orderdate) AS DATE) AS "end", max(o_totalprice) AS start_value,
    CASE WHEN n_regionkey = 1 THEN 'cash' ELSE 'linear' END AS data_type
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name, n_regionkey)"""


@query(using("calendar gapped_series", f""", {_NATIONS},
placed AS (SELECT s.*, c.date, c.seq - min(c.seq) OVER (PARTITION BY s.symbol) AS i
    FROM spec s JOIN calendar c ON c.date BETWEEN s."start" AND s."end"),
rows AS (SELECT symbol, date, CASE WHEN data_type = 'cash' THEN start_value
    ELSE start_value + i * 0.25::DOUBLE END AS v, 10000 AS volume FROM placed
    UNION ALL SELECT series_id, date, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id
        ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0 FROM gapped_series)
SELECT symbol, date, v AS "open", v AS high, v AS low, v AS "close",
    CAST(volume AS BIGINT) AS volume FROM rows"""))
def run_generated(spark, sf):
    """Made-up symbols per nation and repaired series, one output per alias, read back."""
    return _generated(spark, sf)[0]


@query("SELECT r_name AS symbol, 'no settings' AS finding FROM region")
def run_generated_skipped(spark, sf):
    """Regions are asked for as well and have no settings."""
    return _generated(spark, sf)[1]


def _generated(spark, sf):
    orders, customers = a.table(spark, sf, "orders"), a.table(spark, sf, "customer")
    nations = a.table(spark, sf, "nation")
    spec = (
        orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
        .join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
        .groupBy(F.col("n_name").alias("symbol"), "n_regionkey")
        .agg(
            F.to_date(F.min("o_orderdate")).alias("start"),
            F.to_date(F.max("o_orderdate")).alias("end"),
            F.max("o_totalprice").alias("start_value"),
        )
        .withColumn("data_type", F.when(F.col("n_regionkey") == 1, "cash").otherwise("linear"))
        .withColumn("growth_rate", F.lit(0.25))
    )
    regions = a.table(spark, sf, "region").select(F.col("r_name").alias("symbol"))
    return generated_run(
        spec.select("symbol").union(regions),
        spec,
        a.calendar(spark, sf),
        a.gapped_series(spark, sf),
        new_path(spark, "generated"),
        "forward_fill",
    )
