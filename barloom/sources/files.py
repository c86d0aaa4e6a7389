"""CSV layouts read into the long schemas."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import (
    day,
    series_id_of_file,
    strip_header,
    symbol_of_file,
    text_before_underscore,
    to_number,
)
from barloom.lines import csv_cells, first_day, header_lines, read_lines
from barloom.operators.clean import filter_ticker
from barloom.schemas import FIELDS, TAGGED

log = logging.getLogger(__name__)


def _named(spark: SparkSession, columns: str, path, folder_of: str | None, name_of):
    """Headed CSV files and the name they carry: in the file name, or in a ``<column>=`` folder."""
    schema = columns if folder_of is None else f"{columns}, `{folder_of}` string"
    raw = spark.read.schema(schema).option("header", True).csv(path)
    name = name_of(F.col("_metadata.file_name")) if folder_of is None else F.col(folder_of)
    return raw, name


def read_series(
    spark: SparkSession, path: str | list[str], folder_of: str | None = None
) -> DataFrame:
    """``Date,Value`` files, one series each; an empty cell is missing.

    A series is named by its file (``ID.csv``, ``ID_start_end.csv``) or, with ``folder_of``, by
    its partition folder.
    """
    raw, name = _named(spark, "Date string, Value string", path, folder_of, series_id_of_file)
    return raw.select(
        name.alias("series_id"),
        day(F.col("Date")).alias("date"),
        to_number(F.col("Value")).alias("value"),
    )


#: Where a file has the fields of a symbol: the number of each cell.
_PLACES = "array<struct<symbol: string, " + ", ".join(f"{f}: int" for f in FIELDS) + ">>"


def _places(heads: DataFrame, rows: int, symbol: Column, field: Column) -> DataFrame:
    """(file, heads, places): the header lines of each file, and the cells of each symbol.

    ``symbol`` and ``field`` are told from the column ``name``, the cells of ``rows`` header lines
    above one another.
    Of a field that a file names twice for a symbol the first cell counts.
    """
    cells = F.arrays_zip(*[csv_cells(F.col("heads")[i]).alias(f"h{i}") for i in range(rows)])
    named = heads.select("file", F.posexplode(cells).alias("place", "name")).where("place > 0")
    named = named.select("file", "place", symbol.alias("symbol"), field.alias("field"))
    known = named.where(F.col("field").isin(list(FIELDS)) & (F.col("symbol") != ""))
    of_symbol = known.groupBy("file", "symbol").agg(
        *[F.min(F.when(F.col("field") == f, F.col("place"))).alias(f) for f in FIELDS]
    )
    of_file = of_symbol.groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("symbol", *FIELDS))).alias("places")
    )
    return heads.join(of_file, "file", "left").withColumn(
        "places", F.coalesce("places", F.array().cast(_PLACES))
    )


def _bars_of_lines(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """Long bars of the lines of many files, each read by the header of its own file.

    A file without a header is read by the one that all others have; if theirs differ, or there
    is none, that is an error when rows are read.
    """
    shared = placed.agg(
        F.when(F.count_distinct("places") == 1, F.any_value("places"))
    ).scalar()
    none = F.raise_error(F.concat(F.lit("no header for "), "file")).cast(_PLACES)
    rows = lines.join(placed, "file", "left").where(
        ~F.coalesce(F.array_contains("heads", F.col("value")), F.lit(False))
    )
    cells = F.col("cells")
    bars = rows.select(
        first_day(F.col("value")).alias("date"),
        csv_cells(F.col("value")).alias("cells"),
        F.explode(F.coalesce("places", shared, none)).alias("bar"),
    )

    def number(field: str) -> Column:
        return to_number(F.btrim(F.get(cells, F.col(f"bar.{field}")), F.lit(' "')))

    return bars.select(
        "bar.symbol", "date", *[number(f).alias(f) for f in FIELDS[:-1]],
        number("volume").try_cast("bigint").alias("volume"),
    )


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """First column the day, the others ``Field_TICKER``; ``Value_<id>`` columns are left out.

    Files of a folder may have different columns, or the same ones in another order: each is read
    by its own first line. Lines that repeat it are left out.
    """
    lines = read_lines(spark, path)
    heads = header_lines(lines, 1)
    name = F.btrim(F.col("name.h0"), F.lit(' "'))
    symbol = F.regexp_extract(name, "^[^_]*_(.*)$", 1)
    return _bars_of_lines(lines, _places(heads, 1, symbol, F.lower(text_before_underscore(name))))


def read_two_header(spark: SparkSession, path: str) -> DataFrame:
    """Two header rows, symbol above field; the first column is the day.

    Header cells are stripped of quotes, brackets and blanks. Files of a folder may have different
    columns: each is read by its own two first lines. Lines without a day are left out.
    """
    lines = read_lines(spark, path)
    heads = header_lines(lines, 2)
    symbol, field = (strip_header(F.col(f"name.h{i}")) for i in range(2))
    dated = lines.where(first_day(F.col("value")).isNotNull())
    return _bars_of_lines(dated, _places(heads, 2, symbol, F.lower(field)))


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """Long ``date,ticker,value,data_flag`` file; an absent file is an error."""
    raw = (
        spark.read.schema("date string, ticker string, value string, data_flag string")
        .option("header", True)
        .csv(path)
    )
    return raw.select(
        day(F.col("date")).alias("date"),
        "ticker",
        to_number(F.col("value")).alias("value"),
        "data_flag",
    ).to(TAGGED)


def read_symbol_dir(
    spark: SparkSession,
    folder: str,
    requests: DataFrame | None = None,
    folder_of: str | None = None,
    stored: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """OHLCV files of one symbol each, and the requested symbols without one.

    A symbol is named by its file (``<symbol>.csv``) or, with ``folder_of``, by its partition
    folder. With ``stored`` the columns stored_file, stored_block and stored_row tell where a row
    lies: rows of a file are ordered by the last two.
    """
    columns = "Date string, " + ", ".join(f"{f} string" for f in FIELDS)
    raw, name = _named(spark, columns, folder, folder_of, symbol_of_file)
    bars = raw.select(
        name.alias("symbol"),
        day(F.col("Date")).alias("date"),
        *[to_number(F.col(f)).alias(f) for f in FIELDS[:-1]],
        to_number(F.col("volume")).try_cast("bigint").alias("volume"),
        *_stored_place(stored),
    )
    if requests is None:
        return bars, None
    missing = requests.select("symbol").distinct().join(
        bars.select("symbol").distinct(), "symbol", "left_anti"
    )
    wanted = bars.join(requests.select("symbol").distinct(), "symbol", "left_semi")
    return wanted, missing


def _stored_place(stored: bool) -> list[Column]:
    if not stored:
        return []
    return [
        F.col("_metadata.file_path").alias("stored_file"),
        F.col("_metadata.file_block_start").alias("stored_block"),
        F.monotonically_increasing_id().alias("stored_row"),
    ]


def _open(
    spark: SparkSession, sources: Sequence[Mapping]
) -> tuple[list[DataFrame], list[tuple[str, str, str]]]:
    frames, skipped = [], []
    for entry in sources:
        try:
            frames.append(_load(spark, entry))
        except (AnalysisException, ValueError, KeyError) as problem:
            log.error("source %s skipped: %s", entry.get("file_path"), problem)
            named = entry.get("ticker") or ",".join(entry.get("tickers") or [])
            skipped.append((str(entry.get("type")), named, type(problem).__name__))
    return frames, skipped


def source_findings(spark: SparkSession, sources: Sequence[Mapping]) -> DataFrame:
    """The sources that ``load_sources`` skips: type, symbols and kind of error."""
    return spark.createDataFrame(
        _open(spark, sources)[1], "type string, symbols string, finding string"
    )


def load_sources(spark: SparkSession, sources: Sequence[Mapping]) -> DataFrame:
    """Several typed sources as one long table with a ``source`` column.

    Each entry has ``type`` (``yahoo``: wide bars, ``fred``: tagged series), ``file_path``, and
    ``tickers`` or ``ticker``. A source that cannot be opened is logged and skipped;
    ``source_findings`` lists those.
    """
    frames, _ = _open(spark, sources)
    if not frames:
        raise RuntimeError("none of the sources could be opened")
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def _load(spark: SparkSession, entry: Mapping) -> DataFrame:
    tickers = list(entry.get("tickers") or [entry["ticker"]])
    if entry["type"] == "yahoo":
        frame = read_wide(spark, entry["file_path"])
        frame = filter_ticker(frame, tickers, "symbol")
    elif entry["type"] == "fred":
        frame = filter_ticker(read_tagged(spark, entry["file_path"]), tickers, "ticker")
        frame = frame.withColumnRenamed("ticker", "symbol")
    else:
        raise ValueError(f"unknown source type {entry['type']!r}")
    return frame.withColumn("source", F.lit(entry["type"]))
