"""Bars that are computed rather than read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.align import roll, timeline

# Fixed value: volume of every generated bar.
SYNTHETIC_VOLUME = 10000


def bars_from_ticks(
    ticks: DataFrame, symbol: str, ts: str, value: str, tiebreak: str | None = None
) -> DataFrame:
    """Daily bars of single trades or quotes.

    Partial aggregation before the shuffle leaves one row per (symbol, day) and task, however hot
    a symbol is. Where (symbol, ts) is not unique name a ``tiebreak`` column: the order is then a
    struct, which costs a sort-based aggregate instead of a hash-based one.
    """
    at = F.col(ts) if tiebreak is None else F.struct(ts, tiebreak)
    days = ticks.groupBy(F.col(symbol).alias("symbol"), F.to_date(ts).alias("date")).agg(
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
    return days.withColumn("symbol", F.col("symbol").cast("string"))


def synthesize(spec: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars of made-up symbols, and the findings about specs that give none.

    ``linear`` grows by ``growth_rate`` per session from ``start_value``, ``cash`` stays at it;
    missing settings default to linear, 1.0 and 0.01. The range of a spec becomes session
    numbers by equi-joins on its two ends, and every spec row emits its own sessions.
    """
    whole = spec.withColumns(
        {
            "data_type": F.coalesce("data_type", F.lit("linear")),
            "start_value": F.coalesce("start_value", F.lit(1.0)),
            "growth_rate": F.coalesce("growth_rate", F.lit(0.01)),
        }
    )
    sessions = timeline(calendar)
    rolled = roll(whole, sessions, "start", "end").withColumn(
        "finding",
        F.when(~F.col("data_type").isin("linear", "cash"), F.lit("unsupported data type")).when(
            F.coalesce(F.col("__first_seq") > F.col("__last_seq"), F.lit(True)),
            F.lit("no sessions in range"),
        ),
    )
    findings = rolled.where("finding IS NOT NULL").select("symbol", "data_type", "finding")
    count = F.greatest(F.col("__last_seq") - F.col("__first_seq") + 1, F.lit(0))
    own_sessions = F.slice(sessions, F.col("__first_seq") + 1, count)
    price = F.when(
        F.col("data_type") == "linear",
        F.col("start_value") + F.col("step").cast("double") * F.col("growth_rate"),
    ).otherwise(F.col("start_value"))
    bars = (
        rolled.where("finding IS NULL")
        .select("*", F.posexplode(own_sessions).alias("step", "date"))
        .select(
            "symbol",
            "date",
            *[price.alias(c) for c in ("open", "high", "low", "close")],
            F.lit(SYNTHETIC_VOLUME).cast("bigint").alias("volume"),
        )
    )
    return bars, findings
