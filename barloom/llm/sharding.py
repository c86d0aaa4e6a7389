"""Hilbert-curve ordering of documents, cut into shards for multidimensional file pruning.

Metadata dimensions are quantised to equal shares of the rows; the cell of a row in that grid has
a place on a Hilbert curve, along which neighbouring cells lie close in every dimension. Rows are
put into the order of the curve and cut into runs of equal numbers of rows, so a shard covers a
narrow range of each dimension, and its minima and maxima let a reader skip it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from barloom.llm.common import in_order, landed
from barloom.shared import land as landed_at

#: Bits of each dimension of the grid.
BITS = 8
SHARDS = 16


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of grid cells, rows x dimensions, by Gray-code rotations.

    Going from the highest bit down, each dimension's bit either flips the lower bits of the first
    dimension or exchanges them with its own; a Gray code of what results, read with the bits of
    the dimensions interleaved, is the place.
    """
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(len(x)):
            is_set = (x[d] >> bit) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips = np.where((x[-1] >> bit) & 1 == 1, flips ^ ((1 << bit) - 1), flips)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(len(x)):
            place = (place << 1) | (((x[d] ^ flips) >> bit) & 1)
    return place


@F.pandas_udf(LongType())
def _curve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for columns in batches:
        yield pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns], axis=1)))


def quantised(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(value, step): steps of equal shares of the rows, in the order of the values, null first.

    One row per distinct value; a value that holds many rows takes several steps' room and gets
    the first of them.
    """
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    placed = in_order(landed(counts, "values"), [F.col(column)], {"__rows": "__n"})
    total = placed.agg(F.sum("__n")).first()[0] or 1
    step = F.floor(F.col("__rows") * F.lit(1 << bits) / F.lit(total)).cast("long")
    return placed.select(F.col(column).alias("__value"), step.alias("__step"))


def ordered(rows: DataFrame, dimensions: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """Rows with ``__place``, their number in the order of the curve, from 0.

    ``ties`` order the rows of a grid cell. ``rows`` are read several times: hand in landed ones.
    """
    steps, found = [], rows
    for d, name in enumerate(dimensions):
        grid = quantised(rows, name).toDF(f"__value{d}", f"__step{d}")
        found = found.join(grid, F.col(name).eqNullSafe(F.col(f"__value{d}"))).drop(f"__value{d}")
        steps.append(f"__step{d}")
    curved = landed(found.withColumn("__curve", _curve(*steps)).drop(*steps), "curve")
    return in_order(curved, [F.col("__curve"), *ties]).drop("__curve")


def _described(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("__size", (F.octet_length(text) + 1).cast("long")).withColumn(
        "__crc", F.crc32(text.cast("binary"))
    )


def _cut(rows: DataFrame, dimensions: Sequence[str], shards: int) -> DataFrame:
    ties = [F.col(c) for c in ("__crc", "doc_id", "__size")]
    placed = ordered(rows, dimensions, ties)
    n = max(rows.count(), 1)
    cut = placed.withColumn("__shard", F.expr(f"CAST(__place * {shards} DIV {n} AS INT)"))
    return cut.withColumn("__slot", F.expr(f"__place - (__shard * {n}L + {shards - 1}) DIV {shards}"))


def assign(
    docs: DataFrame, shards: int = SHARDS, dimensions: Sequence[str] = ("source", "lang", "__size")
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document.

    The law is ``rows``: shard s gets the rows from ceil(s * n / shards) on, so shards differ by
    one row at most; ``slot`` numbers a shard's rows from 0. ``size`` is the UTF-8 length plus 1,
    of a null text 1 with the checksum of the empty text. Rows of a grid cell are ordered by the
    checksum of the text, so equal texts with equal metadata lie side by side, then by doc_id and
    size; null comes first everywhere. Repeated rows take a place each. With fewer rows than
    shards, some shards are empty; an empty table gives no rows.
    """
    own = [c for c in dimensions if not c.startswith("__")]
    facts = landed(_described(docs).select("doc_id", "__size", "__crc", *own), "facts")
    return _cut(facts, dimensions, shards).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
    )


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS,
    dimensions: Sequence[str] = ("source", "lang", "__size"),
) -> DataFrame:
    """Write the shards as Parquet, one folder ``curve_shard`` each, and return what a reader prunes by.

    That table, also in ``folder``/ranges, has a row per shard: rows, bytes, and the least and
    greatest value of every dimension. If the documents have a column of that name, the folders
    get one more underscore in front.
    """
    name = "curve_shard"
    while name in docs.columns:
        name = f"_{name}"
    spark = docs.sparkSession
    rows = _cut(landed(_described(docs), "described"), dimensions, shards)
    dealt = rows.repartition(shards, "__shard").sortWithinPartitions("__shard", "__place")
    kept = dealt.select(*docs.columns, "__size", F.col("__shard").alias(name))
    kept.write.mode("overwrite").partitionBy(name).parquet(f"{folder}/shards")
    edges = [f(d).alias(f"{n}_{d.lstrip('_')}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))]
    ranges = spark.read.parquet(f"{folder}/shards").groupBy(F.col(name).alias("curve_shard")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("__size").alias("bytes"), *edges
    )
    return landed_at(ranges, f"{folder}/ranges")
