"""Numeric conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_double(c: Column) -> Column:
    """NaN becomes null, so that missing has one form."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def to_number(c: Column) -> Column:
    """Number in a text, null where there is none (a Java suffix as in ``1d`` is no number)."""
    return F.when(~c.rlike(r"[0-9.][dDfF]\s*$"), clean_double(c.try_cast("double")))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient; missing where the divisor is zero."""
    return F.try_divide(top, bottom)


def whole_units(c: Column) -> Column:
    """Whole part, truncated towards zero; missing where it is too large."""
    return c.try_cast("bigint")
