import zlib

import numpy as np
import pytest

from barloom.llm import sharding
from barloom.shared import new_path


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1)
    cells = grid.reshape(-1, dimensions)
    place = sharding.hilbert_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def documents(spark, n):
    rows = [(i, f"text {i % 17} " * (1 + i % 23), f"s{i % 5}", "en" if i % 3 else "fr", 1) for i in range(n)]
    rows += [(None, None, None, None, 1), (3, "", "s1", None, 2), (3, "", "s1", None, 2), (4, "ü" * 99999, "s1", "de", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard int")


def plain_index(cell, bits):
    """Place of one cell on the curve, bit by bit over single numbers."""
    x, n = list(cell), len(cell)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    digits = "".join(str((v ^ t) >> bit & 1) for bit in range(bits - 1, -1, -1) for v in x)
    return int(digits, 2)


def plain_shards(rows, shards, bits=sharding.BITS):
    """(doc_id, size, crc, shard, slot) of every row by a sort of all rows in one place."""
    facts = []
    for r in rows:
        raw = (r.text or "").encode()
        facts.append((r.doc_id, len(raw) + 1, zlib.crc32(raw), (r.source, r.lang, len(raw) + 1)))
    steps = []
    for d in range(3):
        values = sorted((f[3][d] for f in facts), key=lambda v: (v is not None, v))
        first = {}
        for before, value in enumerate(values):
            first.setdefault(value, before * (1 << bits) // len(values))
        steps.append(first)
    low = -(1 << 70)

    def place(f):
        cell = [steps[d][f[3][d]] for d in range(3)]
        return plain_index(cell, bits), f[2], low if f[0] is None else f[0], f[1]

    out, used = [], {}
    for i, f in enumerate(sorted(facts, key=place)):
        shard = i * shards // len(facts)
        out.append((f[0], f[1], f[2], shard, used.setdefault(shard, 0)))
        used[shard] += 1
    return sorted(map(str, out))


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_every_row_like_a_plain_index_and_a_sort(spark, shards):
    docs = documents(spark, 300)
    got = sharding.assign(docs, shards)
    found = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got.collect()]
    assert sorted(map(str, found)) == plain_shards(docs.collect(), shards)


def test_law(spark):
    docs = documents(spark, 500)
    rows = sharding.assign(docs, 7).collect()
    texts = docs.collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(t.doc_id), len((t.text or "").encode()) + 1, zlib.crc32((t.text or "").encode())) for t in texts
    )
    held = [sorted(r.slot for r in rows if r.shard == s) for s in range(7)]
    assert all(h == list(range(len(h))) for h in held)
    assert max(map(len, held)) - min(map(len, held)) <= 1
    again = sharding.assign(docs.repartition(3), 7).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_fewer_rows_than_shards(spark):
    docs = documents(spark, 0)
    assert sorted((r.shard, r.slot) for r in sharding.assign(docs).collect()) == [(0, 0), (4, 0), (8, 0), (12, 0)]
    assert sharding.assign(docs.limit(0)).count() == 0


def test_written_shards_can_be_skipped(spark):
    docs, folder = documents(spark, 400), new_path(spark, "shards")
    ranges = sharding.write_shards(docs, folder, 8).collect()
    written = spark.read.parquet(f"{folder}/shards")
    assert written.count() == docs.count() and sum(r.rows for r in ranges) == docs.count()
    # A shard spans a part of the sources and sizes only.
    spans = [(r.min_source, r.max_source) for r in ranges]
    assert sum(a <= "s2" <= b for a, b in spans) < len(spans)
    assert sum(r.min_size <= 20 <= r.max_size for r in ranges) < len(spans)


def test_written_shards_beside_a_column_of_that_name(spark):
    docs, folder = documents(spark, 50).withColumnRenamed("shard", "curve_shard"), new_path(spark, "shards")
    ranges = sharding.write_shards(docs, folder, 4)
    assert sorted(r.curve_shard for r in ranges.collect()) == [0, 1, 2, 3]
    written = spark.read.parquet(f"{folder}/shards")
    assert written.select("curve_shard").distinct().count() == docs.select("curve_shard").distinct().count()
