"""Packing documents into token-budget batches inside optimal length buckets.

A dynamic program over the histogram of all lengths chooses the bucket boundaries that need the
least padding. Inside a bucket every document is padded to the boundary, documents are dealt in
hash order, and a batch holds as many as the token budget allows.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_order, landed, word_count

BUCKETS = 16
BUDGET = 65536


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, documents) per length that occurs, in order; ``lengths`` has a column __tokens.

    N different lengths take N (N - 1) / 2 tokens at least, so their number grows with the root
    of the tokens: at most some 4.5 million for 10 ** 13 of them.
    """
    counted = lengths.groupBy("__tokens").agg(F.count(F.lit(1)).alias("n")).toArrow()
    return sorted(zip(*[c.to_pylist() for c in counted.columns], strict=True))


def boundaries(bins: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Index of the last length of each bucket, so that padded tokens are fewest.

    cost[j] after k buckets = min over i < j of cost[i] after k - 1, plus the documents of lengths
    i + 1 to j times length j. Padding is that sum less the tokens themselves, which are the same
    for every choice. As a function of length j each i is a line whose slope is the number of
    documents before; slopes fall and lengths rise with the index, so the least line is found by
    going along their lower hull once: a pass per bucket, in whole numbers, however many lengths.
    Fewer buckets are used where more would not help.
    """
    if not bins:
        return []
    lengths = [length for length, _ in bins]
    count = [0, *accumulate(n for _, n in bins)]
    size = len(bins)
    cost: list[int | None] = [0, *[None] * size]  # of the first j lengths; None: not with so few buckets
    chosen, best = [], None
    for k in range(min(buckets, size)):
        then: list[int | None] = [None] * (size + 1)
        start = np.zeros(size + 1, dtype=np.int32)
        hull: list[tuple[int, int, int]] = []  # documents before, cost, index
        at = 0
        for j in range(1, size + 1):
            if cost[j - 1] is not None:
                line = (count[j - 1], cost[j - 1], j - 1)
                while len(hull) >= 2 and _never_least(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            if not hull:
                continue
            length = lengths[j - 1]
            while at + 1 < len(hull) and _at(hull[at + 1], length) < _at(hull[at], length):
                at += 1
            then[j] = count[j] * length + _at(hull[at], length)
            start[j] = hull[at][2]
        chosen.append(start)
        cost = then
        if cost[size] is not None and (best is None or cost[size] < best[0]):
            best = (cost[size], k + 1)
    ends, j = [], size
    for start in reversed(chosen[: best[1]]):
        ends.append(j - 1)
        j = int(start[j])
    return ends[::-1]


def _at(line: tuple[int, int, int], length: int) -> int:
    return line[1] - line[0] * length


def _never_least(left: tuple, middle: tuple, right: tuple) -> bool:
    """Whether the middle one of three lines lies above the others everywhere; slopes fall."""
    return (right[1] - left[1]) * (middle[0] - left[0]) <= (middle[1] - left[1]) * (right[0] - left[0])


def pack(
    docs: DataFrame, tokens: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET
) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, padded_tokens, batch, slot.

    ``tokens`` is the length in tokens, by default the words of ``text``. ``batch`` numbers the
    batches of a bucket, ``slot`` the places in a batch, both from 0 without gaps; all batches of
    a bucket but its last are full. A batch holds floor(budget / padded_tokens) documents, at
    least one, so a document longer than the budget is a batch of its own. Null and empty texts
    have length 0. Rows that repeat a doc_id take a place each; which of them takes which does not
    show. An empty table gives no rows.
    """
    length = word_count(F.col("text")) if tokens is None else F.coalesce(tokens, F.lit(0))
    facts = landed(docs.select("doc_id", length.cast("long").alias("__tokens")), "lengths")
    bins = histogram(facts)
    ends = boundaries(bins, buckets)
    counts = np.concatenate([[0], np.cumsum([b[1] for b in bins])])
    plan, low = [], 0  # greatest length, documents before the bucket
    for end in ends:
        plan.append((bins[end][0], int(counts[low])))
        low = end + 1

    def of_bucket(values: list[int]) -> Column:
        return F.element_at(
            F.array(*[F.lit(v).cast("long") for v in values or [0]]), F.col("__bucket") + 1
        )

    lasts = F.array(*[F.lit(p[0]).cast("long") for p in plan or [(0,)]])
    passed = F.size(F.filter(lasts, lambda last: last < F.col("__tokens")))
    rows = facts.withColumn("__bucket", passed)
    order = [F.col("__bucket"), F.xxhash64("doc_id"), F.col("doc_id"), F.col("__tokens")]
    placed = in_order(rows, order)
    padded = of_bucket([p[0] for p in plan])
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(padded, F.lit(1))))
    inside = F.col("__place") - of_bucket([p[1] for p in plan])
    return placed.select(
        "doc_id", F.col("__tokens").alias("n_tokens"), F.col("__bucket").alias("bucket"),
        padded.alias("padded_tokens"), F.floor(inside / room).alias("batch"),
        (inside % room).alias("slot"),
    )
