import math

import numpy as np
import pytest

from barloom.llm import mtree, topk


def brute(rows, every, k):
    sound = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(float(x) * 1024) for x in v):
            continue
        sound.append((i, [math.floor(1024 * float(x)) for x in v]))
    out = []
    for at, (q, v) in enumerate(sound):
        if q % every == 0:
            scored = [
                (-min(max(sum(a * b for a, b in zip(v, w, strict=False)), mtree.LOWEST), mtree.HIGHEST), i)
                for j, (i, w) in enumerate(sound) if j != at
            ]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def vectors(n, dimensions, seed, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimensions))
    rows = centres[rng.integers(0, clusters, n)] + 0.2 * rng.normal(size=(n, dimensions))
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, p int")


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize(("block", "numbers", "page"), [(4096, 1 << 20, 256), (40, 24, 8)])
def test_like_brute_force(spark, monkeypatch, block, numbers, page):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "NUMBERS", numbers)
    monkeypatch.setattr(topk, "ROUTES", 3)
    monkeypatch.setattr(topk, "RUN", 2)
    monkeypatch.setattr(mtree, "PAGE", page)
    rows = vectors(400, 8, 1)
    rows += [(1000 + i, rows[5][1]) for i in range(100)]  # copies: ties go to the smaller id
    rows += [(2000, None), (2010, [None] * 8), (2020, [float("nan")] * 8), (2030, [float("inf")] * 8)]
    rows += [(2040, [0.0] * 8), (2050, [-0.5, 2.0]), (2060, []), (None, rows[0][1])]
    rows += [(10, rows[11][1]), (10, rows[10][1]), (1, rows[20][1]), (1, rows[20][1])]  # repeated ids
    got = topk.top_k(frame(spark, rows), every=10)
    assert found(got) == brute(rows, 10, 10)


def test_few_and_none(spark):
    few = [(100, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.25, 1.0])]
    assert found(topk.top_k(frame(spark, few))) == brute(few, 100, 10)
    assert topk.top_k(frame(spark, few).limit(0)).count() == 0
    assert topk.top_k(frame(spark, [(100, [1.0])])).count() == 0
    assert topk.top_k(frame(spark, [(1, [1.0]), (2, [1.0])])).count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(0, [60000.0, 3.0] * 20), *((i, [59999.0 + i / 1024, i * 7.0] * 20) for i in range(1, 80))]
    wide = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    assert found(topk.top_k(wide)) == brute(rows, 100, 10)


def test_every_finite_row_is_a_candidate(spark):
    """Vectors whose squared length or products leave the range of a long, next to small ones."""
    rows = [(100, [1.5, 0.25]), (1, [3e6, 3e6]), (2, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [-1e30, 5.0]),
            (4, [1e300, 1.0]), (5, [0.001, -7.0]), (200, [1e17, -1e17]), (300, [2.0**44, 3.0]), (6, [1.7e308, 0.0])]
    rows += [(1000 + i, [i * 1e5, -i * 3.0]) for i in range(1, 40)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(topk.top_k(wide, k=60))
    assert got == brute(rows, 100, 60)
    assert {r[2] for r in got if r[0] == 100} >= {1, 2, 3, 4, 5, 200, 300}


@pytest.mark.parametrize("many", [1, 64])
def test_pages_bound_what_they_hold_and_spare_products(monkeypatch, many):
    monkeypatch.setattr(mtree, "PAGE", 32)
    rows = np.floor(np.array([v for _, v in vectors(3000, 6, 2, clusters=40)]) * 1024)
    top = float((rows * rows).sum(axis=1).max())
    points = mtree.lifted(rows, top)
    pages = mtree.build(points)
    held = []
    for page in pages:
        assert len(page.distances) <= mtree.PAGE
        if page.entries is not None:
            held += page.entries.tolist()
            assert mtree.distances(page.pivot, points[page.entries]).max() <= page.radius + 1e-9
        for child in page.children:
            gap = np.linalg.norm(page.pivot - pages[child].pivot)
            assert gap == pytest.approx(pages[child].apart)
    assert sorted(held) == list(range(len(rows)))
    numbers = np.arange(len(rows))
    search = mtree.Search(pages, numbers + 7, numbers, rows, top)
    asked = np.linspace(0, 2999, many).astype(int)
    best = mtree.Best(rows[asked], asked, np.zeros(many, np.int64), np.zeros(many, bool), 10)
    search.nearest(best)
    for q, (scores, ids, _) in zip(asked, best.found, strict=True):
        want = sorted((-s, i + 7) for i, s in enumerate(rows @ rows[q]) if i != q)[:10]
        assert list(zip(scores.tolist(), ids.tolist(), strict=True)) == [(int(-s), i) for s, i in want]
    assert search.reached < many * len(rows) * 0.6


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(4)
    for scale in (1e3, 1e8, 1e12, 1e25):
        q, x = (np.floor(rng.normal(size=(n, 5)) * scale) for n in (3, 6))
        q[0] = [1, 2, 3, 4, 5]
        want = [[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in x] for u in q]
        got = mtree.products(q, x)
        assert got.tolist() == [[min(max(s, mtree.LOWEST), mtree.HIGHEST) for s in line] for line in want]


def test_copies_alone_make_a_tree():
    pages = mtree.build(mtree.lifted(np.ones((500, 3)), 3.0))
    assert all(len(p.distances) <= mtree.PAGE for p in pages)
