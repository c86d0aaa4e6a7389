"""Exact top-k inner products over all vectors.

The vectors are dealt to the nearest of some routing vectors, the entries of a root page with
covering radii; each part is cut into blocks, and each block gets a tree of pages, built once and
landed as rows. A query first searches its own part. The score of its k-th best there rules out
the parts that the triangle inequality puts too far away; the others are searched with that score
as the floor. One task searches several blocks of a part for many queries, one block after
another, and what it has found in one bounds the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import mtree
from barloom.llm.batches import Batches, batch_of, cells
from barloom.llm.common import landed

#: Vectors of a block, and most entries of the root page; further vectors make more blocks a part.
BLOCK, ROUTES = 4096, 1024
#: Blocks that one task searches one after another.
RUN = 8
#: Numbers in the queries that one task answers from a run of blocks.
NUMBERS = 1 << 20
SCALE = 1024

PAGES = {
    "p": pa.int32(), "run": pa.int32(), "sub": pa.int32(), "kind": pa.int32(), "number": pa.int64(),
    "id": pa.int64(), "parent": pa.int64(), "radius": pa.float64(), "apart": pa.float64(),
    "numbers": pa.list_(pa.float64()),
}
PAGE_ROWS = (
    "p int, run int, sub int, kind int, number long, id long, parent long, radius double, "
    "apart double, numbers array<double>"
)
QUERY, PIVOT, ENTRIES, VECTOR = 0, 1, 2, 3  # kinds of rows, in the order in which tasks need them
FOUND = {"q": pa.int64(), "row": pa.int64(), "x": pa.int64(), "score": pa.int64()}
FOUND_ROWS = "q long, row long, x long, score long"


def whole(vector: Column) -> Column:
    """floor(1024 x) of each component as a double, or null where the vector takes no part.

    From 2 ** 53 on all doubles are whole.
    """
    finite = F.lit(float("inf"))
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    sound = F.forall(scaled, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < finite), F.lit(False)))
    floored = F.transform(
        scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    )
    return F.when(sound, floored)


def _square(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    for i in range(len(lists)):
        row = values[ends[i] : ends[i + 1]]
        out[i, : len(row)] = row
    return out


def _routing(routes: np.ndarray, top: float):
    """The nearest routing vector of each vector, and how far it is."""

    def routed(batches: Batches) -> Batches:
        schema = {
            "row": pa.int64(), "x": pa.int64(), "p": pa.int32(), "far": pa.float64(),
            "v": pa.list_(pa.float64()),
        }
        squares = (routes * routes).sum(axis=1)
        for batch in batches:
            rows = _matrix(batch.column(2), routes.shape[1] - 1)
            points = mtree.lifted(rows, top)
            nearest = (squares - 2 * points @ routes.T).argmin(axis=1)
            apart = points - routes[nearest]
            far = np.sqrt((apart * apart).sum(axis=1))
            ids = [batch.column(i).to_pylist() for i in range(2)]
            yield batch_of(schema, list(zip(*ids, nearest, far, rows, strict=True)))

    return routed


def _paging(top: float):
    """Tree of every block as rows: a page's pivot, its entries, and the vectors themselves."""

    def rows_of(key: tuple[int, int, int], held: list[tuple]) -> Iterator[tuple]:
        numbers, ids, vectors = zip(*held, strict=True)
        rows = np.stack(vectors)
        for page in mtree.build(mtree.lifted(rows, top)):
            place = (page.number, None, page.parent, page.radius, page.apart)
            yield (*key, PIVOT, *place, page.pivot)
            entries = page.children if page.entries is None else page.entries
            yield (*key, ENTRIES, *place, np.append(page.distances, entries).astype(float))
        for i, (number, x, row) in enumerate(zip(numbers, ids, rows, strict=True)):
            yield (*key, VECTOR, i, x, number, 0.0, 0.0, row)

    def paged(batches: Batches) -> Batches:
        for key, held in cells(batches, 3):
            yield batch_of(PAGES, list(rows_of(key, held)))

    return paged


def _opened(rows: list[tuple], top: float) -> mtree.Search:
    pages, ids, numbers, vectors, pivots = {}, [], [], [], {}
    for kind, number, x, parent, radius, apart, values in rows:
        if kind == PIVOT:
            pivots[number] = values
        elif kind == ENTRIES:
            half = len(values) // 2
            entries = values[half:].astype(np.int64)
            pages[number] = mtree.Page(
                number, parent, pivots[number], radius, apart, entries, values[:half]
            )
        else:
            ids.append(x)
            numbers.append(parent)
            vectors.append(values)
    for page in pages.values():
        above = pages.get(page.parent)
        if above is not None and above.entries is not None:
            above.children, above.entries = above.entries.tolist(), None
    ordered = [pages[i] for i in sorted(pages)]
    return mtree.Search(ordered, np.array(ids), np.array(numbers), np.stack(vectors), top)


def _asked(rows: list[tuple], k: int) -> mtree.Best:
    _, numbers, _, floors, known, _, vectors = zip(*rows, strict=True)
    floored = np.array(known) > 0
    return mtree.Best(np.stack(vectors), np.array(numbers), np.array(floors), floored, k)


def _answering(top: float, k: int):
    """Runs of blocks: the queries, then the trees, one block after another."""

    def answers(best: mtree.Best) -> pa.RecordBatch:
        out = []
        for q, (scores, ids, rows) in zip(best.rows.tolist(), best.found, strict=True):
            out += [(q, *one) for one in zip(rows.tolist(), ids.tolist(), scores.tolist(), strict=True)]
        return batch_of(FOUND, out)

    def answered(batches: Batches) -> Batches:
        run, best = None, None
        for (*key, _), held in cells(batches, 4):
            if key != run:
                if best is not None:
                    yield answers(best)
                run, best = key, None
            if held[0][0] == QUERY:
                best = _asked(held, k)
            elif best is not None:
                _opened(held, top).nearest(best)
        if best is not None:
            yield answers(best)

    return answered


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "x", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but the
    query's own: rows that repeat a vec_id are each a candidate and, as it may be, a query.
    Components count as floor(1024 x), scores are exact; those beyond the range of a long count as
    its end. Rows without vec_id, and vectors that are null or hold null or non-finite components
    (also after scaling), take no part. Shorter vectors count as filled up with zeros. Ties go to
    the smaller vec_id. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    sound = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("x"),
        whole(F.col("embedding")).alias("v"),
    )
    rows = landed(sound.where("x IS NOT NULL AND v IS NOT NULL"), "vectors")
    count, top, width = rows.agg(
        F.count(F.lit(1)), F.max(_square(F.col("v"))), F.max(F.size("v"))
    ).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, 1)

    # The root page: routing vectors from a bounded sample, then all vectors to the nearest.
    routes = min(ROUTES, -(-count // BLOCK))
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(routes).collect()
    pivots = np.zeros((len(picked), width))
    for i, row in enumerate(picked):
        pivots[i, : len(row["v"])] = row["v"]
    lifted = mtree.lifted(pivots, top)
    routed = landed(
        rows.mapInArrow(_routing(lifted, top), "row long, x long, p int, far double, v array<double>"),
        "routed",
    )
    parts = routed.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    blocks_of = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int")
    parts = landed(parts.select("p", "radius", blocks_of.alias("k")), "parts")
    few = F.broadcast(parts.select("p", "k"))  # ROUTES rows at most
    sub = F.pmod(F.xxhash64("row"), F.col("k")).cast("int")
    blocks = routed.join(few, "p").withColumn("sub", sub).select(
        "p", F.floor(F.col("sub") / RUN).cast("int").alias("run"), "sub", "row", "x", "v"
    )
    dealt = blocks.repartition("p", "sub").sortWithinPartitions("p", "sub", "row")
    pages = landed(dealt.mapInArrow(_paging(top), PAGE_ROWS), "pages")

    asked = routed.where(F.col("x") % every == 0).select("row", "p", "v")
    share = float(max(1, NUMBERS // width))

    def searched(visits: DataFrame) -> DataFrame:
        """Visits (row, v, floor, p) answered in all blocks of the part p."""
        load = visits.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / F.lit(share)).cast("int").alias("chunks"))
        load = F.broadcast(load.join(few, "p"))
        trees = pages.join(load.select("p", "chunks"), "p").select(
            "p", "run", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            "sub", "kind", "number", "id", "parent", "radius", "apart", "numbers",
        )
        runs = F.ceil(F.col("k") / F.lit(float(RUN))).cast("int")
        queries = visits.join(load, "p").select(
            "p", F.explode(F.sequence(F.lit(0), runs - 1)).alias("run"),
            F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int").alias("chunk"),
            F.lit(-1).alias("sub"), F.lit(QUERY).alias("kind"), F.col("row").alias("number"),
            F.lit(None).cast("long").alias("id"),
            F.coalesce("floor", F.lit(0)).cast("long").alias("parent"),
            F.col("floor").isNotNull().cast("double").alias("radius"), F.lit(0.0).alias("apart"),
            F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))).alias("numbers"),
        )
        vectors_ = F.when(
            F.col("kind") == VECTOR,
            F.concat("numbers", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("numbers"))),
        ).otherwise(F.col("numbers"))
        key = ["p", "run", "chunk"]
        each = trees.withColumn("numbers", vectors_).union(queries).repartition(*key)
        ordered = each.sortWithinPartitions(*key, "sub", "kind", "number")
        return ordered.mapInArrow(_answering(top, k), FOUND_ROWS)

    no_floor = F.lit(None).cast("long")
    first = landed(_best(searched(asked.withColumn("floor", no_floor)), k).drop("rank"), "first")
    floors = first.groupBy(F.col("q").alias("row")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor")
    )
    # How far a query is from every routing vector: one row of at most ROUTES numbers per query.
    radii = {r["p"]: r["radius"] for r in parts.collect()}
    reach = np.array([radii.get(i, -1.0) for i in range(len(lifted))])

    def visiting(batches: Batches) -> Batches:
        schema = {
            "row": pa.int64(), "v": pa.list_(pa.float64()), "floor": pa.int64(),
            "ps": pa.list_(pa.int32()),
        }
        for batch in batches:
            ids, homes, floors_, own = (batch.column(i).to_pylist() for i in (0, 1, 2, 3))
            rows_ = _matrix(batch.column(3), width)
            out = []
            for i, home, floor, v, row in zip(ids, homes, floors_, own, rows_, strict=True):
                far = mtree.distances(np.append(row, 0.0), lifted)
                limit = np.inf
                if floor is not None:
                    extent = float((row * row).sum()) + top
                    limit = np.sqrt(max(extent - 2.0 * floor, 0) + mtree.SLACK * (extent + 1))
                    limit *= 1 + mtree.SLACK
                near = ~(far - reach > limit) & (reach >= 0)
                near[home] = False
                out.append((i, v, floor, np.nonzero(near)[0].astype(np.int32)))
            yield batch_of(schema, out)

    widened = asked.join(floors, "row", "left").select("row", "p", "floor", "v").mapInArrow(
        visiting, "row long, v array<double>, floor long, ps array<int>"
    )
    visits = landed(widened, "visits").select("row", "v", "floor", F.explode("ps").alias("p"))
    found = _best(first.union(searched(visits)), k)
    queries = routed.where(F.col("x") % every == 0).select(F.col("row").alias("q"), F.col("x").alias("query_id"))
    return found.join(queries, "q").select("query_id", "rank", F.col("x").alias("vec_id"), "score")
