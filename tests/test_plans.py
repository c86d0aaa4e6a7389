"""What the plans must look like, whatever the size of the tables."""

import os
import re

import pytest
from helpers import closes, d
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barloom.operators import align, clean, fill, risk
from barloom.track import Track, even_cells

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Columns that rows are shuffled by, without broadcasts and subqueries."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", re.sub(r"#\d+L?", "", plan(df)))


@needs_tables
def test_filter_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["target_stats"](spark, SF))
    assert "EqualTo(event_type,view)" in text
    assert "props" not in text and "user_id" not in text
    text = plan(entry.queries()["flt_ticker"](spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


@pytest.fixture(scope="module")
def bars(spark):
    return closes(spark, "A", ("2020-01-01", 1), ("2020-01-03", 3))


def test_align_and_fill_share_one_shuffle(spark, bars):
    days = spark.createDataFrame([(d("2020-01-01"),)], "date date")
    filled = align.outer_align(bars, days, ["close"], "ffill_bfill")
    assert exchanges(filled).count("symbol") == 1


def test_figures_need_one_shuffle(bars):
    assert exchanges(risk.strategy_stats(bars, "close")) == ["symbol"]


def test_rows_are_shuffled_once_by_cell(spark, bars):
    ticks = spark.range(100).select(
        F.lit("A").alias("k"), F.col("id").alias("n"), F.col("id").cast("double").alias("v")
    )
    track = Track(("k",), ("n",), F.col("cell"))
    text = plan(fill.ffill(even_cells(ticks, "n"), "v", track))
    assert text.count("Exchange hashpartitioning(__cell") == 2  # rows, and totals after combining
    assert "partial_max_by" in text


def test_top_n_is_cut_before_the_shuffle(bars):
    assert plan(clean.preview_each(bars, "symbol", ["date"], 2)).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(clean.preview(bars, ["date"]))
