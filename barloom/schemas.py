"""Fixed schemas of the long tables every operator works on."""

from __future__ import annotations

from pyspark.sql import types as T

FIELDS = ("open", "high", "low", "close", "volume")

SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
    ]
)

BARS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

TAGGED = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("data_flag", T.StringType()),
    ]
)

CALENDAR = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("prev_day", T.DateType()),
        T.StructField("next_day", T.DateType()),
    ]
)

REQUESTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("start", T.DateType()),
        T.StructField("end", T.DateType()),
        T.StructField("alias", T.StringType()),
    ]
)

ALIASES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("alias", T.StringType()),
    ]
)

WEIGHTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("weight", T.DoubleType()),
    ]
)

SPEC = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("start", T.DateType()),
        T.StructField("end", T.DateType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("start_value", T.DoubleType()),
        T.StructField("growth_rate", T.DoubleType()),
    ]
)

VALUES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# The stored tables with a declared layout, and their keys.
TABLES = {
    "yahoo_data": (
        T.StructType(
            [T.StructField("date", T.DateType()), T.StructField("ticker", T.StringType())]
            + BARS.fields[2:]
        ),
        ("date", "ticker"),
    ),
    "fred_data": (TAGGED, ("date", "ticker")),
    "synthetic_cash": (VALUES, ("date",)),
    "synthetic_linear": (VALUES, ("date",)),
}
