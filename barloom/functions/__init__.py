"""Column expressions used by the operators."""

from barloom.functions.dates import day, day_in_zone, end_or_today, parse_day
from barloom.functions.numbers import clean_double, ratio, to_number, whole_units
from barloom.functions.text import (
    flatten_header,
    flatten_name,
    normalize_symbol,
    series_id_of_file,
    strip_header,
    symbol_of_file,
    text_before_underscore,
    wide_name,
)

__all__ = [
    "clean_double",
    "day",
    "day_in_zone",
    "end_or_today",
    "flatten_header",
    "flatten_name",
    "normalize_symbol",
    "parse_day",
    "ratio",
    "series_id_of_file",
    "strip_header",
    "symbol_of_file",
    "text_before_underscore",
    "to_number",
    "whole_units",
    "wide_name",
]
