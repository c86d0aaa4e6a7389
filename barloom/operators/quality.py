"""Checks. Each gives a table of findings, empty when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import parse_day, strip_header
from barloom.functions.dates import OPEN_END
from barloom.lines import csv_cells, header_lines, read_lines
from barloom.operators.fill import monotonic_check
from barloom.schemas import FIELDS
from barloom.track import Track, quoted

FINDING = "check string, subject string, detail string"


class FindingsError(ValueError):
    """Raised by ``assert_clean``."""


def assert_clean(findings: DataFrame) -> None:
    """Raise if there is any finding, showing the first few."""
    shown = findings.take(5)
    if shown:
        raise FindingsError("; ".join(str(row.asDict()) for row in shown))


def row_counts(**datasets: DataFrame) -> DataFrame:
    """Rows of each dataset."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        for name, df in datasets.items()
    ]
    whole = counts[0]
    for one in counts[1:]:
        whole = whole.union(one)
    return whole


def reconcile_counts(**datasets: DataFrame) -> DataFrame:
    """The counts of all datasets, if they are not all equal."""
    counts = row_counts(**datasets)
    ends = counts.agg((F.min("n_rows") < F.max("n_rows")).alias("differ"))
    return counts.where(ends.scalar())


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column how many values are present and whether all or any are, in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(quoted(c)).alias(f"__n{i}") for i, c in enumerate(names)],
    )
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("n_present"))
            for i, c in enumerate(names)
        ]
    )
    return counted.select(F.col("__rows").alias("n_rows"), F.explode(per_column).alias("c")).select(
        "c.column_name",
        "n_rows",
        "c.n_present",
        (F.col("c.n_present") == 0).alias("all_missing"),
        (F.col("c.n_present") > 0).alias("any_present"),
    )


def emptiness(requests: DataFrame, data: DataFrame, key: str = "symbol") -> DataFrame:
    """Requested symbols without a single row."""
    return requests.select(key).distinct().join(data.select(key).distinct(), key, "left_anti")


def missing_series(df: DataFrame, key: str = "series_id", value: str = "value") -> DataFrame:
    """Series without a single present value, which no repair can fill."""
    counted = df.groupBy(F.col(key).alias("symbol")).agg(F.count(value).alias("n"))
    return counted.where("n = 0").select("symbol", F.lit("no values").alias("finding"))


def first_last(df: DataFrame, key: str, value: str, date: str = "date") -> DataFrame:
    """First and last value of each series in time order."""
    return df.groupBy(key).agg(
        F.min_by(value, date).alias("first_value"), F.max_by(value, date).alias("last_value")
    )


def span_years(df: DataFrame, key: str, date: str = "date") -> DataFrame:
    """Years between the first and last day of each series, never below one."""
    return df.groupBy(key).agg(years_between(date).alias("years"))


def years_between(date: str, value: str | None = None) -> Column:
    """Years from the first to the last day, of those with a value if one is named; at least one."""
    day = F.col(quoted(date))
    if value is not None:
        day = F.when(F.col(quoted(value)).isNotNull(), day)
    days = F.datediff(F.max(day), F.min(day))
    return F.greatest(days / F.lit(365.25), F.lit(1.0))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that repeat, and incomplete keys, with their number of rows."""
    incomplete = F.lit(False)
    for c in key:
        incomplete = incomplete | F.col(c).isNull()
    problem = F.when(incomplete, F.lit("missing key")).when(
        F.col("n_rows") > 1, F.lit("repeated key")
    )
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("finding", problem)
        .where("finding IS NOT NULL")
    )


def _found(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, FINDING)


def check_ohlcv(bars: DataFrame, stored: Track | None = None, date: str = "date") -> DataFrame:
    """Fields there, price and volume types right, dates typed and not falling.

    Types are read from the schema. Order is checked along ``stored``, which holds the stored
    position of the rows; without it rows have no order to check.
    """
    types = {f.name: f.dataType for f in bars.schema.fields}
    rows = [("ohlcv", c, "column is missing") for c in FIELDS if c not in types]
    if not isinstance(types.get("close", T.DoubleType()), T.FractionalType):
        rows.append(("ohlcv", "close", "type is not floating"))
    if not isinstance(types.get("volume", T.LongType()), T.IntegralType):
        rows.append(("ohlcv", "volume", "type is not integer"))
    if not isinstance(types.get(date), (T.DateType, T.TimestampType, T.TimestampNTZType)):
        rows.append(("ohlcv", date, "type is not a date"))
    findings = _found(bars.sparkSession, rows)
    if stored is None or date not in types:
        return findings
    falling = monotonic_check(bars, date, stored).select(
        F.lit("ohlcv").alias("check"),
        F.concat_ws(" ", *stored.key).alias("subject"),
        F.concat(F.lit("date falls to "), F.col(date).cast("string")).alias("detail"),
    )
    return findings.union(falling)


def check_duplicate_columns(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Names that occur more than once among ``names``.

    Of a CSV pass the header line, or use ``check_header_lines``: Spark renames equal columns.
    """
    repeated = [n for i, n in enumerate(names) if n in names[:i]]
    rows = [("duplicate columns", n, "name occurs again") for n in dict.fromkeys(repeated)]
    return _found(spark, rows)


def check_header_lines(spark: SparkSession, path: str) -> DataFrame:
    """Names that occur more than once in the header line of a CSV file, for all files at once.

    The header is the first line of a file, unless that begins with a date; no other line is
    looked at. Commas inside quotes part no cells.
    """
    heads = header_lines(read_lines(spark, path))
    cells = csv_cells(F.col("heads")[0])
    return (
        heads.select("file", F.explode(cells).alias("name"))
        .groupBy("file", strip_header(F.col("name")).alias("column_name"))
        .agg(F.count(F.lit(1)).alias("n_uses"))
        .where("n_uses > 1 AND column_name <> ''")
    )


def check_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns without a single number."""
    return missing_profile(df, columns).where("all_missing").select("column_name")


def check_generated(
    requested: DataFrame, bars: DataFrame, stored: Track, date: str = "date"
) -> DataFrame:
    """Requested symbols without bars, and bars stored out of order."""
    key = stored.key[0]
    empty = emptiness(requested, bars, key).select(
        F.col(key).alias("symbol"), F.lit("no rows").alias("finding")
    )
    falling = monotonic_check(bars, date, stored).select(
        F.col(key).alias("symbol"), F.lit("date falls").alias("finding")
    )
    return empty.union(falling)


def check_ranges(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Ranges with an unreadable date or with the start after the end."""
    first, last = F.col(start), F.col(end)
    open_end = last == OPEN_END
    problem = (
        F.when(first.isNotNull() & (first != "") & parse_day(first).isNull(), "start is no date")
        .when(
            last.isNotNull() & (last != "") & ~open_end & parse_day(last).isNull(),
            "end is no date",
        )
        .when(~open_end & (parse_day(first) > parse_day(last)), "start after end")
    )
    return ranges.withColumn("finding", problem).where("finding IS NOT NULL")


def check_aliases(aliases: DataFrame) -> DataFrame:
    """Aliases given more than once, over all sources."""
    return (
        aliases.groupBy("alias")
        .agg(F.count(F.lit(1)).alias("n_uses"))
        .where("n_uses > 1")
    )


def check_targets(targets: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested (symbol, field) pairs that the bars do not hold."""
    fields = F.explode(F.array(*[F.lit(f) for f in FIELDS if f in bars.columns]))
    there = bars.select(F.lower("symbol").alias("symbol")).distinct().select(
        "symbol", fields.alias("field")
    )
    asked = targets.select(F.lower("symbol").alias("symbol"), F.lower("field").alias("field"))
    return asked.distinct().join(there, ["symbol", "field"], "left_anti")


