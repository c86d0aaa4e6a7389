"""Trading sessions."""

from __future__ import annotations

from calendar import monthcalendar
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: First year that the rules and special closings below cover.
FIRST_YEAR = 1981

# Days since then on which the New York exchange stayed shut outside its rules.
SPECIAL_CLOSINGS = (
    "1985-09-27",
    "1994-04-27",
    "2001-09-11",
    "2001-09-12",
    "2001-09-13",
    "2001-09-14",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29",
    "2012-10-30",
    "2018-12-05",
    "2025-01-09",
)


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th such weekday (Monday is 0) of a month; the last one for n = -1."""
    weeks = [w[weekday] for w in monthcalendar(year, month) if w[weekday]]
    return date(year, month, weeks[n if n < 0 else n - 1])


def _observed(day: date) -> date:
    """A Saturday holiday is kept on Friday, a Sunday one on Monday."""
    return day + timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def _good_friday(year: int) -> date:
    """Two days before Easter, by the Gregorian computus."""
    golden, (century, in_century) = year % 19, divmod(year, 100)
    moon = (century - (century + 8) // 25 + 1) // 3
    epact = (19 * golden + century - century // 4 - moon + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * (in_century // 4) - epact - in_century % 4) % 7
    late = (golden + 11 * epact + 22 * weekday) // 451
    return date(year, 3, 22) + timedelta(days=epact + weekday - 7 * late - 2)


def _closed_days(year: int) -> list[date]:
    new_year = date(year, 1, 1)
    days = [
        _nth_weekday(year, 2, 0, 3),
        _good_friday(year),
        _nth_weekday(year, 5, 0, -1),
        _observed(date(year, 7, 4)),
        _nth_weekday(year, 9, 0, 1),
        _nth_weekday(year, 11, 3, 4),
        _observed(date(year, 12, 25)),
    ]
    if new_year.weekday() != 5:
        days.append(_observed(new_year))
    if year >= 1998:
        days.append(_nth_weekday(year, 1, 0, 3))
    if year >= 2022:
        days.append(_observed(date(year, 6, 19)))
    return days


def nyse_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Weekdays (as ``date``) on which the New York exchange is closed, by its rules.

    Years before FIRST_YEAR, when other rules held, are refused.
    """
    if first_year < FIRST_YEAR:
        raise ValueError(f"no holidays are known before {FIRST_YEAR}")
    years = range(first_year, last_year + 1)
    days = {d.isoformat() for year in years for d in _closed_days(year)}
    days.update(d for d in SPECIAL_CLOSINGS if int(d[:4]) in years)
    listed = F.split(F.lit(",".join(sorted(days))), ",").cast("array<date>")
    return spark.range(0, 1, 1, 1).select(F.explode(listed).alias("date"))


def trading_calendar(span: DataFrame, holidays: DataFrame) -> DataFrame:
    """Sessions in the closed range [start, end] of the one-row table ``span``.

    Weekdays that are no holiday, numbered from 0, each with its neighbour sessions. The size is
    bounded by the days of the range, so the numbering may use one window.
    """
    days = span.select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date")
    ).where(F.weekday("date") < 5)
    w = Window.orderBy("date")
    return days.join(holidays.select("date"), "date", "left_anti").select(
        "date",
        (F.row_number().over(w) - 1).alias("seq"),
        F.lag("date").over(w).alias("prev_day"),
        F.lead("date").over(w).alias("next_day"),
    )
