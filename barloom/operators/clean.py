"""Projections and filters on the long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import (
    clean_double,
    end_or_today,
    flatten_name,
    normalize_symbol,
    parse_day,
    text_before_underscore,
    to_number,
    wide_name,
)
from barloom.operators.fill import handle_missing
from barloom.schemas import FIELDS
from barloom.track import Track, quoted

# Fixed value: first day of a request that names none.
DEFAULT_START = "2020-01-01"


def series_to_ohlcv(series: DataFrame, keep_value: bool = True) -> DataFrame:
    """A single value as a bar: all four prices are the value, the volume is 0."""
    value = [F.col("value")] if keep_value else []
    return series.select(
        F.col("series_id").alias("symbol"),
        "date",
        *[F.col("value").alias(f) for f in FIELDS[:-1]],
        F.lit(0).cast("bigint").alias("volume"),
        *value,
    )


def repaired_series_to_ohlcv(
    series: DataFrame, strategy: str = "interpolate", track: Track = Track(("series_id",))
) -> DataFrame:
    """``series_to_ohlcv`` after gap repair, without the value column."""
    return series_to_ohlcv(handle_missing(series, "value", strategy, track), keep_value=False)


def select_ohlcv(bars: DataFrame, keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    return bars.select(*keys, *FIELDS)


def cast_ohlcv(bars: DataFrame) -> DataFrame:
    prices = {f: F.col(f).cast("double") for f in FIELDS[:-1]}
    return bars.withColumns({**prices, "volume": F.col("volume").cast("bigint")})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to numbers; what is no number becomes missing."""
    return df.withColumns({c: to_number(F.col(quoted(c)).cast("string")) for c in columns})


def to_wide(
    bars: DataFrame, symbols: Sequence[str], fields: Sequence[str] = FIELDS
) -> DataFrame:
    """One row per day, one ``Field_TICKER`` column per field of each listed symbol."""
    picked = [
        F.max(F.when(F.col("symbol") == s, F.col(f))).alias(wide_name(f, s))
        for s in symbols
        for f in fields
    ]
    return bars.where(F.col("symbol").isin(list(symbols))).groupBy("date").agg(*picked)


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Without the index column that a careless CSV round trip adds."""
    return df.drop("Unnamed: 0")


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """The first of each group of equally named columns."""
    first = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_position.select(
        *[F.col(f"c{i}").alias(name) for name, i in sorted(first.items(), key=lambda kv: kv[1])]
    )


def flatten_headers(df: DataFrame, headers: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename by position: two header cells become ``symbol_field`` in lower case."""
    return df.toDF(*[flatten_name(symbol, field) for symbol, field in headers])


def symbol_column(
    cells: DataFrame, symbol: str | None = None, name: str = "name", place: str = "position"
) -> DataFrame:
    """For each symbol the last column whose name starts with it, as rows (prefix, name).

    ``cells`` lists column names with their place. With ``symbol`` only that symbol's.
    """
    picked = cells.groupBy(text_before_underscore(F.col(name)).alias("symbol")).agg(
        F.max_by(name, place).alias("column_name")
    )
    return picked if symbol is None else picked.where(F.col("symbol") == symbol.lower())


def column_of_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """The single column of a flattened wide frame that answers for ``symbol``."""
    matches = [c for c in df.columns if c.split("_")[0] == symbol.lower()]
    if not matches:
        raise ValueError(f"no column of {df.columns} belongs to symbol {symbol!r}")
    return df.select(quoted(matches[-1]))


def target_series(bars: DataFrame, target: str | Sequence[str]) -> DataFrame:
    """(date, value) of one field of one symbol; a bare symbol means its close."""
    symbol, field = (target, "close") if isinstance(target, str) else tuple(target)
    if field.lower() not in FIELDS:
        raise ValueError(f"field {field!r} is not one of {FIELDS}")
    return bars.where(F.lower("symbol") == symbol.lower()).select(
        "date", F.col(field.lower()).alias("value")
    )


def target_of(parameters: dict) -> str | Sequence[str]:
    """The target asset of a strategy's settings."""
    try:
        return parameters["parameters"]["target_asset"]
    except KeyError:
        raise KeyError("the strategy needs parameters.target_asset") from None


def with_alias(df: DataFrame, aliases: DataFrame, key: str = "symbol") -> DataFrame:
    """Display name from the alias table, the id itself where there is none."""
    names = aliases.select(F.col("symbol").alias(key), F.col("alias").alias("__alias"))
    return (
        df.join(names, key, "left")
        .withColumn("alias", F.coalesce("__alias", key))
        .drop("__alias")
    )


def series_as_column(tagged: DataFrame, ticker: str, actual_only: bool = True) -> DataFrame:
    """(date, <ticker>) of one ticker."""
    rows = filter_ticker(tagged, ticker)
    rows = filter_actual(rows) if actual_only else rows
    return rows.select("date", F.col("value").alias(ticker))


def filter_ticker(df: DataFrame, ticker: str | Sequence[str], column: str = "ticker") -> DataFrame:
    wanted = [ticker] if isinstance(ticker, str) else list(ticker)
    return df.where(F.col(column).isin(wanted))


def filter_actual(tagged: DataFrame, enabled: bool = True) -> DataFrame:
    return tagged.where(F.col("data_flag") == "actual") if enabled else tagged


def resolve_requests(requests: DataFrame) -> DataFrame:
    """Text start and end to dates: no start means 2020, no end or ``current`` means today."""
    return requests.withColumns(
        {
            "start": F.coalesce(parse_day(F.col("start")), F.lit(DEFAULT_START).cast("date")),
            "end": end_or_today(F.col("end")),
        }
    )


def filter_window(
    df: DataFrame, requests: DataFrame, key: str = "symbol", date: str = "date"
) -> DataFrame:
    """Rows inside the closed date range requested for their symbol.

    ``requests`` has resolved dates and one row per symbol; others have no rows here. As a stored
    table its size is known, and a small one is broadcast by Spark.
    """
    ranges = requests.select(
        F.col("symbol").alias(key), F.col("start").alias("__start"), F.col("end").alias("__end")
    )
    return (
        df.join(ranges, key)
        .where(F.col(date).between(F.col("__start"), F.coalesce("__end", F.current_date())))
        .select(*map(quoted, df.columns))
    )


def tickers(df: DataFrame, column: str = "ticker") -> DataFrame:
    return df.select(column).distinct()


def configured_only(
    requested: DataFrame, settings: DataFrame, key: str = "symbol"
) -> tuple[DataFrame, DataFrame]:
    """Requested symbols that have settings, and those that have none."""
    known = settings.select(key).distinct()
    return requested.join(known, key, "left_semi"), requested.join(known, key, "left_anti")


def normalized(df: DataFrame, column: str = "symbol") -> DataFrame:
    return df.withColumn(column, normalize_symbol(F.col(column)))


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_double(F.col(quoted(c))) for c in columns})


def sort_by_date(df: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    return df.orderBy(key, date)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows of the whole table (a top-k: no full sort)."""
    return df.orderBy(*order).limit(n)


def preview_each(df: DataFrame, key: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows per key; each input partition passes on at most ``n`` rows of a key."""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(w))
    return ranked.where(F.col("__rank") <= n).drop("__rank")
