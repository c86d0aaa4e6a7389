"""The audit against term-by-term arithmetic in plain Python."""

import random
import re
from collections import Counter, defaultdict

import plain
import pytest

from barloom.llm import divergence
from barloom.llm.divergence import audit, share

SCHEMA = "lang string, source string, text string, term string, n int, value string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows, least=10, top=10):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        group = (lang or "", source or "")
        groups.add(group)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", plain.lowered(text))
        counts[group].update(found)
        in_docs[group[0]].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        sources = {s: {t: counts[lang, s][t] for t in kept} for g, s in groups if g == lang}
        whole = {t: sum(c[t] for c in sources.values()) for t in kept}

        def shares(c, kept=kept):
            n = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        of, q = {s: shares(c) for s, c in sources.items()}, shares(whole)
        for s, p in of.items():
            pairs = [(-sum(f(p[t], r[t]) for t in kept), o.encode(), o) for o, r in of.items() if o != s]
            terms = [(-f(p[t], q[t]), t.encode(), t) for t in kept if sources[s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, _, item) in enumerate(sorted(found)[:most]):
                    out.add((lang, s, part, item, -value, rank + 1))
    return out


def found(df):
    rows = df.collect()
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows}, len(rows)


def corpus(seed, n, words, sources):
    rng = random.Random(seed)
    vocabulary = ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(words)] + ["Éa", "éa", "ÉA", "漢字", "Über"]
    return [
        (
            rng.choice(["en", "de", None]), rng.choice(sources),
            " ".join(rng.choices(vocabulary, k=rng.randrange(0, 40))).title() + rng.choice(["", " 12_x", ".\tEnd"]),
        )
        for _ in range(n)
    ]


def same(spark, rows, **more):
    got, n = found(audit(frame(spark, rows), **more))
    assert got == brute(rows, **more) and n == len(got)


@pytest.mark.parametrize("seed", [1, 2])
def test_like_plain_arithmetic(spark, monkeypatch, seed):
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "LONG", 150)
    rows = corpus(seed, 300, 60, ["a", "b", "hot", "hot", "hot", None, "ß"])
    rows += [("en", "empty", None), ("en", "signs", "123 _ !"), ("xx", "alone", "few words"), ("", "", "")]
    rows += [("en", "long", "wa wb " * 500 + "only here " * 3)] * 12
    same(spark, rows)


def test_ties_are_taken_in_utf8_order(spark):
    """Many terms with equal counts: one cell, cut to the first ten by bytes."""
    terms = [chr(0x61 + i) + chr(0x61 + i) for i in range(20)] + ["é", "ü", "ａ", "𝔞"]
    rows = [("en", "s", " ".join(terms))] * 10 + [("en", "t", "other")] * 10 + [("en", "u", "other é")] * 3
    same(spark, rows)
    same(spark, rows, top=3)


def test_few_and_none(spark):
    assert found(audit(frame(spark, []))) == (set(), 0)
    same(spark, [(None, None, None)])
    same(spark, [("en", "a", "rare"), ("en", "b", "words")])
    same(spark, [("en", "a", "rare"), ("en", "b", "words rare")], least=1)


def test_shares_of_huge_counts_are_exact(spark):
    rows = [(3, 10, 4), (9 * 10**17, 9 * 10**18 - 1, 10**6), (0, 0, 0)]
    df = spark.createDataFrame(rows, "n long, total long, terms long")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(share(F.col("n"), F.col("total").cast("decimal(20,0)"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (n + 2) // (t + 2 * v) if v else None for n, t, v in rows]
