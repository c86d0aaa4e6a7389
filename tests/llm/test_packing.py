import itertools
import math
import random
from collections import Counter

import plain
from pyspark.sql import functions as F

from barloom.llm import packing


def padded(bins, ends):
    total, low = 0, 0
    for end in ends:
        total += sum(b[1] for b in bins[low : end + 1]) * bins[end][0]
        low = end + 1
    return total


def program(bins, buckets):
    """Least padded tokens, by trying every last boundary of every prefix."""
    cost = [0, *[math.inf] * len(bins)]
    best = math.inf
    for _ in range(buckets):
        cost = [
            min((cost[i] + sum(b[1] for b in bins[i:j]) * bins[j - 1][0] for i in range(j)), default=math.inf)
            for j in range(len(bins) + 1)
        ]
        best = min(best, cost[-1])
    return best


def test_boundaries_need_the_least_padding():
    rng = random.Random(4)
    for size in (1, 2, 5, 9):
        for _ in range(6):
            bins = [(i, rng.choice([1, 1, 2, 20, 10**12])) for i in sorted(rng.sample(range(50), size))]
            for buckets in (1, 2, 3, 4, 12):
                ends = packing.boundaries(bins, buckets)
                ways = itertools.chain.from_iterable(
                    itertools.combinations(range(size - 1), k) for k in range(min(buckets, size))
                )
                assert padded(bins, ends) == min(padded(bins, [*way, size - 1]) for way in ways)
                assert len(ends) <= buckets and ends[-1] == size - 1
    assert packing.boundaries([]) == []


def test_boundaries_of_many_lengths():
    rng = random.Random(9)
    bins = [(i, rng.randint(1, 9)) for i in sorted(rng.sample(range(3000), 90))]
    for buckets in (1, 3, 16):
        assert padded(bins, packing.boundaries(bins, buckets)) == program(bins, buckets)
    many = [(i, 1 + i % 7) for i in range(1, 40_000)]
    assert len(packing.boundaries(many, 16)) == 16


def test_documents_are_packed_with_the_least_padding(spark):
    """Against a program over the documents themselves, lengths above 512 included."""
    rng = random.Random(12)
    lengths = [rng.choice([0, 1, 2, 5, 40, 300, 513, 700, 701, 2000, 2100, 3333]) + rng.randrange(3) for _ in range(120)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    bins = sorted(Counter(lengths).items())
    for buckets in (2, 5):
        rows = packing.pack(docs, buckets=buckets).collect()
        assert sum(r.padded_tokens for r in rows) == program(bins, buckets)
        assert all(r.n_tokens <= r.padded_tokens for r in rows)


def test_batches(spark):
    rng = random.Random(6)
    texts = [(i, " ".join("w" * rng.choice([3, 10, 40, 200]))) for i in range(300)]
    texts += [(1000, None), (1001, ""), (1002, "a " * 5000), (1003, "b"), (1003, "b"), (None, "c d")]
    docs = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, bucket int, slot int")
    rows = packing.pack(docs, buckets=4, budget=500).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted(
        (str(i), len(plain.words(t))) for i, t in texts
    )
    assert len({r.bucket for r in rows}) <= 4
    for bucket in {r.bucket for r in rows}:
        own = [r for r in rows if r.bucket == bucket]
        room = max(1, 500 // max(own[0].padded_tokens, 1))
        assert {r.padded_tokens for r in own} == {max(r.n_tokens for r in own)}
        assert sorted(r.batch * room + r.slot for r in own) == list(range(len(own)))
        assert all(r.slot < room for r in own)


def test_same_again_and_empty(spark):
    docs = spark.createDataFrame([(i, "a " * (i % 9)) for i in range(100)], "doc_id long, text string")
    first = sorted(plain.rows(packing.pack(docs)))
    assert sorted(plain.rows(packing.pack(docs.repartition(7)))) == first
    assert packing.pack(docs.limit(0)).count() == 0


def test_own_tokens(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "x", None)], "doc_id long, text string, size int")
    assert sorted(r.n_tokens for r in packing.pack(docs, F.col("size")).collect()) == [0, 5]
