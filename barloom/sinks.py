"""Outputs. The Parquet copy is written first and the others are made from it."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.clean import drop_duplicate_columns, drop_unnamed
from barloom.operators.quality import (
    assert_clean,
    check_duplicate_columns,
    check_keys,
    reconcile_counts,
)
from barloom.schemas import TABLES
from barloom.shared import drop, hadoop_path, land, new_path
from barloom.track import quoted

log = logging.getLogger(__name__)

ROWS_PER_FILE = 5_000_000


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_dual(df: DataFrame, folder: str, name: str = "merged_data") -> DataFrame:
    """``<name>.parquet`` and ``<name>.csv`` of the same rows; gives back the Parquet copy.

    The frame is computed once: the CSV is made from the written Parquet.
    """
    kept = land(drop_unnamed(df), f"{folder}/{name}.parquet")
    _csv(kept, f"{folder}/{name}.csv")
    return kept


def write_checked(df: DataFrame, folder: str, name: str = "validated_data") -> DataFrame:
    """``write_dual`` for a frame whose column names are all different; else an error."""
    assert_clean(check_duplicate_columns(df.sparkSession, df.columns))
    return write_dual(df, folder, name)


def write_by_alias(df: DataFrame, folder: str, date: str = "date") -> None:
    """One output folder per alias, with the day labelled ``Date``.

    The rebalance hint groups an alias's rows into few files and splits an alias that is large;
    the rows of a file are in order of the day.
    """
    named = df.withColumnRenamed(date, "Date")
    (
        named.hint("rebalance", "alias")
        .sortWithinPartitions("alias", "Date")
        .write.mode("overwrite")
        .partitionBy("alias")
        .option("header", True)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(folder)
    )


def replace_table(
    df: DataFrame, table: str, path: str | None = None, key: Sequence[str] | None = None
) -> None:
    """Replace a catalog table; the old one stays until the new one is whole.

    The rows are written to a table of their own, which then takes the name of the old one. A job
    that fails on the way leaves the old table as it was. ``path`` makes the table an external
    one, whose rows lie in a folder of their own below ``path``; that of the table replaced goes.
    Frames that were read from the old table have to be read anew.

    Equally named columns are cut to the first. The four stored tables have a declared layout and
    key, which are enforced: columns are cast and put in order, and a missing or repeated key is
    an error before the table changes. The rows are landed for that, so that those checked are
    those stored.
    """
    layout = TABLES.get(table.split(".")[-1])
    kept = drop_duplicate_columns(df)
    if layout is not None:
        schema, declared = layout
        kept = kept.select(
            *[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
        key = declared if key is None else key
    spark, checked = kept.sparkSession, None
    if key is not None:
        checked = new_path(spark, "checked")
        kept = land(kept, checked)
        assert_clean(check_keys(kept, key))
    _swap(kept, table, path)
    if checked is not None:
        drop(spark, checked)


def _swap(df: DataFrame, table: str, path: str | None) -> None:
    """Write a staged table and give it the name of another."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    staged, before = f"{table}__staged_{mark}", f"{table}__before_{mark}"
    folder = None if path is None else f"{path.rstrip('/')}/{mark}"
    writer = df.write.format("parquet")
    try:
        (writer if folder is None else writer.option("path", folder)).saveAsTable(staged)
    except Exception:
        _discard(spark, staged, folder)
        raise
    replaces = spark.catalog.tableExists(table)
    old_folder = _folder_below(spark, table, path) if replaces else None
    if replaces:
        _rename(spark, table, before)
    try:
        _rename(spark, staged, table)
    except Exception:
        if replaces:
            _rename(spark, before, table)
        _discard(spark, staged, folder)
        raise
    if replaces:
        _discard(spark, before, old_folder)


def _sql_name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def _rename(spark: SparkSession, table: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {_sql_name(table)} RENAME TO {_sql_name(name)}")


def _discard(spark: SparkSession, table: str, folder: str | None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_sql_name(table)}")
    if folder is not None:
        drop(spark, folder)


def _folder_below(spark: SparkSession, table: str, path: str | None) -> str | None:
    """Where the rows of a table lie, if that is a folder below ``path``."""
    if path is None:
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_sql_name(table)}")
    place = described.where("col_name = 'Location'").first().data_type
    files, root = hadoop_path(spark, path)
    root = files.makeQualified(root).toString().rstrip("/")
    own = hadoop_path(spark, place)[1]
    return place if files.makeQualified(own.getParent()).toString().rstrip("/") == root else None


def write_and_reconcile(
    df: DataFrame, table: str, csv_path: str, path: str | None = None
) -> DataFrame:
    """Write a table and a CSV of it, and give the counts back if they differ.

    A difference is a warning; errors of the writes are raised. The frame is computed once.
    """
    spark, copy = df.sparkSession, new_path(df.sparkSession, "frame")
    frame = land(drop_duplicate_columns(df), copy)
    replace_table(frame, table, path)
    written = spark.table(table)
    _csv(written, csv_path)
    file = spark.read.option("header", True).csv(csv_path)
    counts = reconcile_counts(frame=frame, table=written, file=file)
    findings = spark.createDataFrame(counts.collect(), counts.schema)  # three counts at most
    drop(spark, copy)
    if not findings.isEmpty():
        log.warning("row counts of table %s and %s differ", table, csv_path)
    return findings


def metrics_documents(report: DataFrame, benchmarks: Sequence[str]) -> DataFrame:
    """One JSON document per ticker: metadata, metrics, and the comparison per benchmark.

    A group holds one row per listed benchmark.
    """
    figures = [
        "start_value", "end_value", "total_profit", "total_return", "cagr_pct", "volatility",
        "sharpe", "sortino", "max_drawdown",
    ]
    compared = F.sort_array(F.collect_list(F.struct("benchmark", "alpha", "beta")))
    return report.groupBy("symbol", "start_date", "end_date", *figures).agg(
        compared.alias("benchmark_comparison")
    ).select(
        F.struct(
            F.col("symbol").alias("ticker"),
            "start_date",
            "end_date",
            F.array(*[F.lit(b) for b in benchmarks]).alias("benchmarks"),
        ).alias("metadata"),
        F.struct(*figures).alias("metrics"),
        "benchmark_comparison",
    )


def write_metrics_json(report: DataFrame, benchmarks: Sequence[str], path: str) -> None:
    """JSON lines, one document per ticker, so that no document grows with the tickers."""
    metrics_documents(report, benchmarks).write.mode("overwrite").json(path)
