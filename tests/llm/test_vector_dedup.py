import math

import numpy as np
import plain
import pytest

from barloom.llm import vector_dedup


def vectors(n, dimensions, seed):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = rng.normal(size=dimensions)
        for _ in range(rng.choice([1, 1, 2, 4, 8])):
            out.append(base * rng.uniform(0.1, 10) + rng.normal(size=dimensions) * rng.choice([0, 0.05, 0.3]))
    return [[float(x) for x in v] for v in out[:n]]


def brute(rows):
    sound = [(n, i, v) for n, (i, v) in enumerate(rows)
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for k, a in enumerate(sound) for b in sound[k + 1 :]
             if len(a[2]) == len(b[2]) and plain.cosine(a[2], b[2]) >= 0.9]
    count = dict.fromkeys(range(len(rows)), 0)
    for a, b in links:
        count[a[0]] += 1
        count[b[0]] += 1
    part = plain.grouped([i for i, _ in rows if i is not None], [(a[1], b[1]) for a, b in links])
    return sorted((str(i), count[n], str(part.get(i)), i is not None and part[i] == i) for n, (i, _) in enumerate(rows))


def found(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, size int, component string")


@pytest.mark.parametrize("block", [2048, 5])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rows = list(enumerate(vectors(250, 12, 3)))
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [float("nan")] * 12), (2004, [None] + [1.0] * 11),
             (2005, [float("inf")] + [1.0] * 11), (2006, [1.0, 0.0]), (2007, [1.0, 0.1]), (None, rows[7][1]),
             (2008, [1e200] * 12), (2009, [1e-200] * 12), (2010, [1.0] * 12), (2006, [1.0, 0.0])]
    assert found(vector_dedup.groups(frame(spark, rows), recall=0.9999)) == brute(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    tables, bits = vector_dedup.tables_and_bits(50_000, 0.9, 0.95)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(400, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.9 * a + math.sqrt(1 - 0.81) * b
    met = (vector_dedup.buckets(a, tables, bits) == vector_dedup.buckets(c, tables, bits)).any(axis=1)
    assert met.mean() >= 0.9


def test_empty(spark):
    assert vector_dedup.groups(frame(spark, [])).count() == 0
    assert found(vector_dedup.groups(frame(spark, [(4, None)]))) == [("4", 0, "4", True)]
