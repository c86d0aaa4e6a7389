"""Lines of CSV files with the file and place they come from, and the header lines of each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import day
from barloom.functions.text import HEADER_JUNK


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, row, value): lines that are not blank; ``row`` orders those of a block."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    return lines.where(F.trim("value") != "")


def csv_cells(line: Column) -> Column:
    """Cells of a line. Commas inside quotes part none; the quotes stay on the cells."""
    quoted_commas = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return F.when(F.contains(line, F.lit('"')), F.split(line, quoted_commas)).otherwise(
        F.split(line, ",")
    )


def first_day(line: Column) -> Column:
    """The day in the first cell of a line, null if it is none."""
    return day(F.btrim(F.substring_index(line, ",", 1), F.lit(HEADER_JUNK)))


def header_lines(lines: DataFrame, rows: int = 1) -> DataFrame:
    """(file, heads): the first ``rows`` lines of every file as an array of texts.

    A header lies at the beginning of a file, before its first line with a day. Files that begin
    with such a line, or with fewer lines than that, have none. Only lines without a day are
    ranked, and of those each task hands on ``rows`` per file.
    """
    top = lines.where("block = 0").withColumn("day", first_day(F.col("value")))
    dated = top.where("day IS NOT NULL").groupBy("file").agg(F.min("row").alias("body"))
    place = Window.partitionBy("file").orderBy("row")
    undated = top.where("day IS NULL").withColumn("n", F.row_number().over(place))
    heads = undated.where(F.col("n") <= rows).join(dated, "file", "left")
    heads = heads.where("body IS NULL OR row < body").groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("row", "value"))).alias("heads")
    )
    return heads.where(F.size("heads") == rows).select("file", F.col("heads.value").alias("heads"))
