"""Sources: tables are written in the layout that the source reads, and read back."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem, FileType, LocalFileSystem
from pyspark.sql import functions as F

from barloom.operators import clean
from barloom.schemas import FIELDS
from barloom.shared import drop, hadoop_path, new_path
from barloom.sinks import write_by_alias
from barloom.sources import (
    bars_from_ticks,
    fetch_answers,
    fetch_bars,
    load_sources,
    read_series,
    read_symbol_dir,
    read_tagged,
    read_through,
    read_two_header,
    read_wide,
    source_findings,
)
from checks import adapters as a
from checks.adapters import using
from checks.registry import query as registered

_TYPE_BARS = """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, arg_min(value, ts) AS "open",
    max(value) AS high, min(value) AS low, arg_max(value, ts) AS "close", count(*) AS volume
    FROM events GROUP BY 1, 2"""


def type_bars(spark, sf):
    return bars_from_ticks(a.table(spark, sf, "events"), "event_type", "ts", "value")


def _csv(df, name):
    path = new_path(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path


@registered(using("series", "SELECT * FROM series"))
def source_series(spark, sf):
    path = new_path(spark, "series")
    series = a.series(spark, sf).select(
        F.col("date").alias("Date"), F.col("value").alias("Value"), "series_id"
    )
    series.write.partitionBy("series_id").option("header", True).csv(path)
    return read_series(spark, path, "series_id")


@registered(_TYPE_BARS)
def source_wide(spark, sf):
    wide = clean.to_wide(type_bars(spark, sf), a.EVENT_TYPES)
    return read_wide(spark, _csv(wide, "wide")).where("volume IS NOT NULL")


@registered(using("tagged", "SELECT * FROM tagged"))
def source_tagged(spark, sf):
    return read_tagged(spark, _csv(a.tagged(spark, sf), "tagged"))


@registered(_TYPE_BARS)
def source_two_header(spark, sf):
    return read_two_header(spark, two_header_csv(spark, sf)).where("volume IS NOT NULL")


def two_header_csv(spark, sf):
    path = new_path(spark, "two-header")
    wide = clean.to_wide(type_bars(spark, sf), a.EVENT_TYPES)
    cells = [(s, f) for s in a.EVENT_TYPES for f in FIELDS]
    heads = [
        ",".join(["Symbol", *[f"(' {s}" for s, _ in cells]]),
        ",".join(["Field", *[f"{f.capitalize()}')" for _, f in cells]]),
    ]
    spark.createDataFrame([(h,) for h in heads], "value string").coalesce(1).write.text(path)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in wide.columns])
    wide.select(line.alias("value")).write.mode("append").text(path)
    return path


@registered(_TYPE_BARS)
def source_two_header_folder(spark, sf):
    """A file a quarter, each with its columns in another order."""
    path = new_path(spark, "two-header")
    _permuted(spark, sf, path, lambda s, f: (f"(' {s}", f"{f.capitalize()}')"))
    return read_two_header(spark, path).where("volume IS NOT NULL")


@registered(_TYPE_BARS)
def source_wide_folder(spark, sf):
    """The same with one header line."""
    path = new_path(spark, "wide")
    _permuted(spark, sf, path, lambda s, f: (f"{f.capitalize()}_{s}",))
    return read_wide(spark, path).where("volume IS NOT NULL")


def _permuted(spark, sf, path, names):
    wide = clean.to_wide(type_bars(spark, sf), a.EVENT_TYPES)
    for quarter in range(1, 5):
        cells = [(s, f) for s in a.EVENT_TYPES[quarter:] + a.EVENT_TYPES[:quarter] for f in FIELDS]
        cells = cells[::-1] if quarter % 2 else cells
        heads = [",".join(["Date", *row]) for row in zip(*[names(s, f) for s, f in cells], strict=True)]
        values = [F.col(f"{f.capitalize()}_{s}").cast("string") for s, f in cells]
        line = F.concat_ws(",", F.col("date").cast("string"), *[F.coalesce(v, F.lit("")) for v in values])
        body = wide.where(F.quarter("date") == quarter).select(F.lit(len(heads)).alias("n"), line.alias("value"))
        lines = spark.createDataFrame(list(enumerate(heads)), "n int, value string").union(body)
        lines.coalesce(1).sortWithinPartitions("n").select("value").write.mode("append").text(path)


@registered(_TYPE_BARS)
def source_symbol_dir(spark, sf):
    path = new_path(spark, "symbols")
    write_by_alias(type_bars(spark, sf).withColumnRenamed("symbol", "alias"), path)
    return read_symbol_dir(spark, path, folder_of="alias")[0]


@registered("SELECT r_name AS symbol FROM region")
def source_symbol_dir_missing(spark, sf):
    """Requested symbols without a file: here the regions, asked for among the event types."""
    path = new_path(spark, "symbols")
    write_by_alias(type_bars(spark, sf).withColumnRenamed("symbol", "alias"), path)
    regions = a.table(spark, sf, "region").select(F.col("r_name").alias("symbol"))
    asked = regions.union(a.table(spark, sf, "events").select("event_type").distinct())
    return read_symbol_dir(spark, path, asked, "alias")[1]


@registered(using("tagged", f""", b AS ({_TYPE_BARS})
SELECT symbol, date, "open", high, low, "close", volume, 'yahoo' AS source,
    NULL::DOUBLE AS value, NULL::VARCHAR AS data_flag FROM b WHERE symbol IN ('view', 'click')
UNION ALL SELECT ticker, date, NULL, NULL, NULL, NULL, NULL, 'fred', value, data_flag
FROM tagged WHERE ticker = '2-HIGH'"""))
def source_list(spark, sf):
    """Typed sources as one table; the one that does not exist is skipped."""
    loaded = load_sources(spark, _sources(spark, sf))
    return loaded.where("volume IS NOT NULL OR source = 'fred'")


def _sources(spark, sf):
    wide = clean.to_wide(type_bars(spark, sf), a.EVENT_TYPES)
    return [
        {"type": "yahoo", "tickers": ["view", "click"], "file_path": _csv(wide, "wide")},
        {"type": "fred", "ticker": "2-HIGH", "file_path": _csv(a.tagged(spark, sf), "tag")},
        {"type": "fred", "ticker": "1-URGENT", "file_path": new_path(spark, "absent")},
    ]


@registered("""SELECT DISTINCT 'fred' AS type, o_orderpriority AS symbols,
    'AnalysisException' AS finding FROM orders""")
def source_list_skipped(spark, sf):
    """A source for every order priority, none of which can be opened, next to those that can."""
    names = [r.o_orderpriority for r in a.table(spark, sf, "orders").select("o_orderpriority").distinct().collect()]
    absent = [{"type": "fred", "ticker": n, "file_path": new_path(spark, "absent")} for n in names]
    return source_findings(spark, [*_sources(spark, sf)[:2], *absent])


@registered(using("series", "SELECT * FROM series"))
def source_series_files(spark, sf):
    """One file per series, which names it; the way of ``ID_start_end.csv``."""
    path = new_path(spark, "series-files")
    series = a.series(spark, sf).select(
        F.col("date").alias("Date"), F.col("value").alias("Value"), "series_id"
    )
    for name in a.PRIORITIES:
        one = series.where(F.col("series_id") == name).drop("series_id").coalesce(1)
        one.write.option("header", True).csv(f"{path}/{name}")
        files, folder = hadoop_path(spark, f"{path}/{name}")
        (part,) = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName()[:4] == "part"]
        files.rename(part, hadoop_path(spark, f"{path}/{name}_1990-01-01_2030-12-31.csv")[1])
        drop(spark, f"{path}/{name}")
    return read_series(spark, f"{path}/*.csv")


class FolderProvider:
    """Stands for a data provider: serves one folder of Parquet per symbol."""

    def __init__(self, path: str, key: str):
        self.path, self.key = path, key

    def __call__(self, symbol, start, end):
        path = re.sub(r"^file:/+", "/", self.path)
        found = FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)
        files, folder = found[0], f"{found[1]}/{self.key}={symbol}"
        if files.get_file_info(folder).type == FileType.NotFound:
            return pd.DataFrame()
        rows = pq.read_table(folder, filesystem=files).to_pandas()
        days = pd.to_datetime(rows["date"]).dt.date
        return rows[(days >= start) & (days <= end)]


def _provide(df, key, *order):
    """A provider of the rows, each symbol's in the given order."""
    path = new_path(df.sparkSession, "provider")
    dealt = df.repartition(key).sortWithinPartitions(key, *order) if order else df
    dealt.drop(*order[1:]).write.partitionBy(key).parquet(path)
    return FolderProvider(path, key)


def _bar_requests(spark, sf):
    """All event types, untidily spelled, over the span of the events."""
    asked = a.table(spark, sf, "events").groupBy("event_type").agg(
        F.to_date(F.min("ts")).alias("start"), F.to_date(F.max("ts")).alias("end")
    )
    return asked.select(F.concat(F.lit(" "), "event_type").alias("symbol"), "start", "end")


def _upper_bars(spark, sf):
    return type_bars(spark, sf).withColumn("symbol", F.upper("symbol"))


@registered(f'SELECT upper(symbol) AS symbol, date, "open", high, low, "close", volume '
            f"FROM ({_TYPE_BARS})")
def source_fetch_bars(spark, sf):
    provider = _provide(_upper_bars(spark, sf), "symbol")
    return fetch_bars(_bar_requests(spark, sf), provider, new_path(spark, "fetched"))[0]


@registered(f"""SELECT upper(symbol) AS symbol, min(date) AS "start", max(date) AS "end",
    'ok' AS status, '' AS message, count(*) AS "rows" FROM ({_TYPE_BARS}) GROUP BY 1
UNION ALL SELECT r_name, DATE '2024-01-01', DATE '2024-01-31', 'empty', '', 0 FROM region""")
def source_fetch_status(spark, sf):
    """One status row per request; regions are asked for and have no data."""
    provider = _provide(_upper_bars(spark, sf), "symbol")
    regions = a.table(spark, sf, "region").select(
        F.col("r_name").alias("symbol"),
        F.lit("2024-01-01").cast("date").alias("start"),
        F.lit("2024-01-31").cast("date").alias("end"),
    )
    asked = _bar_requests(spark, sf).union(regions)
    return fetch_bars(asked, provider, new_path(spark, "fetched"))[1]


@registered(using("series", """SELECT series_id AS symbol, date, value, NULL::VARCHAR AS status,
    NULL::BIGINT AS "rows" FROM series
UNION ALL SELECT series_id, NULL, NULL, 'ok', count(*) FROM series GROUP BY 1"""))
def source_fetch_format(spark, sf):
    """All series through the data source, in pieces, with the row that ends each answer."""
    provider = _provide(a.series(spark, sf), "series_id")
    asked = a.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("symbol")).agg(
        F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end")
    )
    answers = fetch_answers(asked, InPieces(provider), "series")
    return answers.select("symbol", "date", "value", "status", "rows")


class InPieces:
    """A provider whose answers come in frames of a thousand rows."""

    def __init__(self, provider):
        self.provider = provider

    def __call__(self, symbol, start, end):
        whole = self.provider(symbol, start, end)
        for at in range(0, len(whole), 1000):
            yield whole[at : at + 1000]


@registered(using("series", "SELECT * FROM series"))
def source_read_through(spark, sf):
    """Three years are fetched first, then the last of them again with all years after it."""
    provider = _provide(a.series(spark, sf), "series_id")
    spans = a.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("symbol")).agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("end")
    )
    early = spans.select(
        "symbol", F.col("first").alias("start"), F.add_months("first", 36).alias("end")
    )
    late = spans.select("symbol", F.add_months("first", 24).alias("start"), "end")
    landed = new_path(spark, "landed")
    read_through(early, provider, landed)
    return read_through(early.union(late), provider, landed)


@registered(_TYPE_BARS)
def source_ticks(spark, sf):
    """Daily bars of single events; ties in time are broken by the event number."""
    return bars_from_ticks(a.table(spark, sf, "events"), "event_type", "ts", "value", "event_id")
