"""Calendar days from text and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date that means "up to today".
OPEN_END = "current"


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` as a date; null if it is not one."""
    return F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d")
    )


def day(c: Column) -> Column:
    """Calendar day of a date or timestamp, or of text holding one.

    A zone in the text is dropped and the wall-clock time kept. Text that is no timestamp gives
    null.
    """
    return F.to_date(c.try_cast("timestamp_ntz"))


def day_in_zone(instant: Column, zone: str) -> Column:
    """Calendar day on the wall clock of ``zone`` at an instant."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz")))


def end_or_today(text: Column) -> Column:
    """End date of a request: absent or ``current`` means today."""
    return F.when(text.isNull() | (text == OPEN_END), F.current_date()).otherwise(parse_day(text))
