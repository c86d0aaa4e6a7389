"""Near-duplicate vectors by random-hyperplane sign hashing.

The signs of a vector's products with random hyperplanes make up a bucket in each of several
tables. Vectors that meet in a bucket are compared exactly, links join components.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of, cells
from barloom.llm.common import landed
from barloom.llm.graph import components

THRESHOLD = 0.9
#: Chance that a pair right at the threshold meets in at least one table; closer pairs do better.
RECALL = 0.995
#: Buckets are meant to hold about so many vectors.
IN_BUCKET = 16
#: Larger buckets are cut into blocks of so many, each pair of blocks a task's work of its own.
BLOCK = 2048
ROWS = 512  # of a similarity matrix at a time
SEED = 20


def tables_and_bits(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a bucket follow the number of vectors, the number of tables follows the recall."""
    bits = min(60, max(4, int(log2(max(vectors, 1) / IN_BUCKET)) if vectors > IN_BUCKET else 4))
    same = 1 - acos(threshold) / pi
    return ceil(log(1 / (1 - recall)) / same**bits), bits


def units(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows of length 1 in double precision."""
    rows = np.stack(vectors).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def buckets(rows: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket of each row in each table. The hyperplanes depend on the dimension alone."""
    planes = np.random.default_rng((SEED, rows.shape[1])).standard_normal((rows.shape[1], tables * bits))
    signs = (rows @ planes >= 0).reshape(len(rows), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _hashing(tables: int, bits: int):
    def hashed(batches: Batches) -> Batches:
        schema = {"x": pa.int64(), "dim": pa.int32(), "buckets": pa.list_(pa.int64())}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
            lists = batch.column(1)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i, x in enumerate(ids):
                vector = values[ends[i] : ends[i + 1]]
                by_size.setdefault(len(vector), []).append((x, vector))
            for size, rows in by_size.items():
                found = buckets(units([v for _, v in rows]), tables, bits)
                yield batch_of(schema, [(x, size, b) for (x, _), b in zip(rows, found, strict=True)])

    return hashed


COUNT, EDGE = 0, 1
FOUND = {"kind": pa.int8(), "u": pa.int64(), "v": pa.int64()}


def _comparing(tables: int, bits: int, threshold: float):
    """Pairs of a bucket, or of two blocks of one, that are close and met in no earlier table.

    Yields how many vectors each one is linked to and the links that connect them, never all.
    """

    def compared(batches: Batches) -> Batches:
        for (table, _, _, first, second), held in cells(batches, 5):
            ids, sizes, blocks, vectors = zip(*held, strict=True)
            if len(ids) < 2:
                continue
            rows, weight, block = units(vectors), np.array(sizes), np.array(blocks)
            links, parts, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
            met = None
            for at in range(0, len(ids), ROWS):
                close = rows[at : at + ROWS] @ rows.T >= threshold
                close &= np.arange(len(ids)) > np.arange(at, at + len(close))[:, None]
                if first != second:
                    close &= block[at : at + ROWS, None] != block
                one, two = np.nonzero(close)
                one += at
                if not len(one):
                    continue
                if met is None:
                    met = buckets(rows, tables, bits)
                new = np.ones(len(one), dtype=bool)
                for earlier in range(table):
                    new &= met[one, earlier] != met[two, earlier]
                one, two = one[new], two[new]
                np.add.at(links, one, weight[two])
                np.add.at(links, two, weight[one])
                for a in np.unique(one):
                    near = two[one == a]
                    for part in np.unique(parts[near]):
                        if part != parts[a]:
                            edges.append((EDGE, ids[a], ids[near[parts[near] == part][0]]))
                    parts[np.isin(parts, parts[np.append(near, a)])] = parts[a]
            out = [(COUNT, ids[i], int(links[i])) for i in np.nonzero(links)[0]] + edges
            if out:
                yield batch_of(FOUND, out)

    return compared


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers, not all of them zero."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def groups(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Two vectors are linked when they are found and their cosine is at least ``threshold``;
    ``n_links`` counts the other rows linked directly, ``component_id`` is the least vec_id that
    links reach, ``kept`` says whether that is the row's own. Equal vectors are one class,
    compared once, so copies are counted and not paired. Vectors that are null, empty or zero or
    hold null or non-finite components are linked with nothing, and so are rows without vec_id
    (component null, not kept). Vectors of different dimensions are not linked. Rows with the same
    vec_id share a component. An empty table gives no rows.
    """
    part = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(part, F.col("embedding")).alias("v"))
    classes = rows.where(F.col("v").isNotNull()).groupBy("v").agg(
        F.min("vec_id").alias("x"), F.count(F.lit(1)).alias("size")
    )
    classes = landed(classes.select("x", "size", "v"), "classes")
    tables, bits = tables_and_bits(classes.count(), threshold, recall)

    hashed = classes.select("x", "v").mapInArrow(
        _hashing(tables, bits), "x long, dim int, buckets array<long>"
    )
    places = landed(hashed, "buckets").select("x", "dim", F.posexplode("buckets").alias("t", "bucket"))
    key = ["t", "dim", "bucket"]
    full = places.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    full = full.select(*key, F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int").alias("k"))
    own = F.pmod(F.xxhash64("x"), F.col("k")).cast("int")
    met = places.join(full, key).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    )
    met = met.join(classes, "x").select(
        *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "x",
        "size", "own", "v",
    )
    dealt = met.repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j", "x")
    found = landed(
        dealt.mapInArrow(_comparing(tables, bits, threshold), "kind byte, u long, v long"), "found"
    )
    tied = components(found.where(F.col("kind") == EDGE).select("u", "v"))
    counted = found.where(F.col("kind") == COUNT).groupBy(F.col("u").alias("x")).agg(
        F.sum("v").alias("links")
    )
    known = classes.join(counted, "x", "left").join(
        tied.withColumnRenamed("node", "x"), "x", "left"
    ).select(
        "v",
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "x").alias("component_id"),
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(known, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
