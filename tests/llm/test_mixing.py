import hashlib
import math
import random

import plain
import pytest
from pyspark.sql import functions as F

from barloom.llm import mixing


def key(doc_id, quality):
    u = (int(hashlib.md5(f"mix:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:12], 16) + 1) / (2**48 + 2)
    return -math.log(u) / {1: 2.0, 0: 0.5}.get(quality, 1.0)


def brute(rows, labels):
    """(doc_id, size, source_size, target, taken) per row; rows: (doc_id, text, source)."""
    quality = {}
    for i, q in labels:
        if q is not None:
            quality[i] = max(q, quality.get(i, q))
    sources = sorted({r[2] for r in rows if r[2] is not None}) + [None] * any(r[2] is None for r in rows)
    size = {s: sum(len(plain.words(r[1])) for r in rows if r[2] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total, fixed = sum(size.values()), set()
    while True:
        free = [s for s in sources if s not in fixed]
        left = total - sum(3 * size[s] for s in fixed)
        share = left / max(sum(weight[s] for s in free), 1)
        over = {s for s in free if 3 * size[s] <= weight[s] * share}
        if not over:
            break
        fixed |= over
    target = {s: 3.0 * size[s] if s in fixed else min(3.0 * size[s], weight[s] * share) for s in sources}
    out = []
    for s in sources:
        own = sorted(((key(r[0], quality.get(r[0])), -1 if r[0] is None else r[0], len(plain.words(r[1])), r[0])
                      for r in rows if r[2] == s))
        epochs = int(target[s] // size[s]) if size[s] else 0
        rest, before = target[s] - epochs * size[s], 0
        for _, _, n, i in own:
            more = n > 0 and 2 * before + n <= 2 * rest
            out.append((str(i), n, size[s], target[s], n * (epochs + more)))
            before += n
    return sorted(out)


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, epochs int")
    marks = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int")
    return mixing.labelled(docs, marks), marks


def weight():
    return mixing.quality_weight(F.col("__quality"))


def corpus(seed, n=400, sources=5):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 30), "s0" if rng.random() < 0.4 else f"s{rng.randrange(sources)}") for i in range(n)]
    labels = [(i, rng.choice([0, 1])) for i in range(0, n, 2)] + [(4, 1), (4, 0), (6, None), (None, 1)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows, labels = corpus(seed)
    rows += [(900, None, "empty"), (901, "", "empty"), (902, "a b", None), (903, "x " * 5000, "s1"), (None, "y", "s2"),
             (904, "rare", "é"), (904, "rare", "é"), (905, "t", "Z")]
    docs, marks = tables(spark, rows, labels)
    mix = mixing.mix(docs, weight())
    got = [(str(r.doc_id), r.size, r.source_size, r.target, r.taken) for r in mix.documents.collect()]
    want = brute(rows, labels)
    assert len(got) == len(want)
    for a, b in zip(sorted(got), want, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3]) and a[4] == b[4]
    assert all(t <= 3 * n for _, n, _, _, t in got)
    for source, total in {r[2]: r[3] for r in got}.items():
        taken = sum(r[4] for r in got if r[2] == source and r[3] == total)
        assert abs(taken - total) <= 3000


def test_the_mix_repeats_documents(spark):
    rows, labels = corpus(3)
    docs, marks = tables(spark, [*rows, (904, "rare", "z"), (904, "rare", "z"), (None, "q", None)], labels)
    out = mixing.mixed(docs, weight())
    assert out.columns == docs.columns
    want = {}
    for r in mixing.mix(docs, weight()).documents.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in want.items() if n}
    again = mixing.mixed(docs.repartition(5), weight())
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_weights_favour_quality(spark):
    rows = [(i, "a b c", "s0" if i < 2000 else "s1") for i in range(3000)]
    docs, marks = tables(spark, rows, [(i, i % 2) for i in range(3000)])
    taken = mixing.mix(docs, weight()).documents.where("copies > 0").join(marks, "doc_id")
    some = taken.groupBy("source", "quality").count().collect()
    count = {(r.source, r.quality): r["count"] for r in some}
    part = [s for s in ("s0", "s1") if count[s, 0] != count[s, 1]]
    assert part and all(count[s, 1] > count[s, 0] for s in part)


def test_empty_and_native(spark):
    docs, marks = tables(spark, [], [])
    assert mixing.mix(docs, weight()).documents.count() == 0
    assert mixing.mixed(docs, weight()).count() == 0
    rows, labels = corpus(1, 20)
    docs, marks = tables(spark, rows, labels)
    plan = mixing.mixed(docs, weight())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_weight_of_a_text(spark):
    texts = [("plain prose",), ("ab%%% cd$$$",), (None,), ("",)]
    rows = spark.createDataFrame(texts, "t string").select(mixing.text_weight(F.col("t")).alias("w")).collect()
    assert rows[0].w == 1.0 and rows[2].w == rows[3].w == 1.0
    assert 0.1 <= rows[1].w < 0.2
