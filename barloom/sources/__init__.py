"""Where bars, series and calendars come from."""

from barloom.sources.calendars import nyse_holidays, trading_calendar
from barloom.sources.fetching import FetchSource, fetch_answers, fetch_bars, fetch_option, read_through, register
from barloom.sources.files import (
    load_sources,
    read_series,
    read_symbol_dir,
    read_tagged,
    read_two_header,
    read_wide,
    source_findings,
)
from barloom.sources.generated import bars_from_ticks, synthesize

__all__ = [
    "FetchSource",
    "bars_from_ticks",
    "fetch_answers",
    "fetch_bars",
    "fetch_option",
    "load_sources",
    "nyse_holidays",
    "read_series",
    "read_symbol_dir",
    "read_tagged",
    "read_through",
    "read_two_header",
    "read_wide",
    "register",
    "source_findings",
    "synthesize",
    "trading_calendar",
]
