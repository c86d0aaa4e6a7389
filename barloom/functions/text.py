"""Names of symbols, series and wide columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters stripped from both ends of a header cell.
HEADER_JUNK = " '\"()"


def normalize_symbol(c: Column) -> Column:
    return F.upper(F.trim(c))


def strip_header(c: Column) -> Column:
    return F.btrim(c, F.lit(HEADER_JUNK))


def flatten_header(symbol: Column, field: Column) -> Column:
    """Two header cells as one lower-case name; an empty second cell adds nothing."""
    return F.lower(F.concat_ws("_", symbol, F.when(field != "", field)))


def flatten_name(symbol: str, field: str) -> str:
    """``flatten_header`` for a name that is known before the read."""
    return f"{symbol}_{field}".lower() if field else symbol.lower()


def text_before_underscore(c: Column) -> Column:
    return F.substring_index(c, "_", 1)


def wide_name(field: str, symbol: str) -> str:
    """Column name of one field of one symbol in a wide table, such as ``Close_SPY``."""
    return f"{field.capitalize()}_{symbol}"


def _plain(file_name: Column) -> Column:
    """A file name without the escapes that Spark gives it."""
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def series_id_of_file(file_name: Column) -> Column:
    """``ID_start_end.csv`` or ``ID.csv`` -> ``ID``."""
    return F.regexp_extract(
        _plain(file_name), r"^(.*?)(_\d{4}-\d{2}-\d{2}_\d{4}-\d{2}-\d{2})?\.[A-Za-z]+(\.gz)?$", 1
    )


def symbol_of_file(file_name: Column) -> Column:
    return F.regexp_extract(_plain(file_name), r"^(.*?)\.[A-Za-z]+(\.gz)?$", 1)
