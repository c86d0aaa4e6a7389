import random

import numpy as np
import plain
import pytest

from barloom.llm import divideskip, graph, ngram_join, shingles

SCHEMA = "doc_id long, text string, n long, a string, x string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 7, "clash", "clash") for i, t in texts], SCHEMA)


def corpus(seed, bases=12, copies=6, length=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(50))
    texts = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, length))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own) + (f" {passage}" if rng.random() < 0.2 else ""))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_groups_like_brute_force(spark, words, percent):
    texts = corpus(percent)
    texts |= {900: None, 901: "", 902: " \t\n", 903: "One", 904: "one", 905: "a b c", 906: "A b\tC"}
    found = ngram_join.groups(documents(spark, texts.items()), words, percent).collect()
    want = plain.near_groups(texts, words, percent)
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.n_shingles for r in found} == {
        i: len(plain.shingles(t, words)) for i, t in texts.items()
    }
    assert want[904] == 903 and want[906] == 905 and want[901] == 901


def test_small_blocks_find_the_same(spark, monkeypatch):
    texts = corpus(3, bases=4, copies=30, length=40)
    want = plain.near_groups(texts, 4, 85)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 3)
    found = ngram_join.groups(documents(spark, texts.items())).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def test_very_long_text(spark):
    rng = random.Random(5)
    long = [f"v{rng.randrange(10**6)}" for _ in range(300_000)]
    other = long[:]
    other[1000] = "changed"
    texts = {1: " ".join(long), 2: " ".join(other), 3: " ".join(long[:1000]), 4: "x" * 3_000_000}
    found = ngram_join.groups(documents(spark, texts.items())).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.doc_id: r.n_shingles for r in found}[1] == len(plain.shingles(texts[1], 4))


def test_repeated_and_missing_ids(spark):
    text = "one two three four five six"
    rows = [(5, text), (5, text), (5, "quite another text here"), (None, text), (2, text), (None, "alone")]
    found = ngram_join.groups(documents(spark, rows))
    assert sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in found.collect()) == [
        ("2", "2", 3), ("5", "2", 3), ("5", "2", 3), ("5", "5", 1), ("None", "2", 3), ("None", "None", 1),
    ]


def test_near_copies_without_id_lose_no_links(spark):
    rng = random.Random(11)
    rows = []
    for base in range(40):
        words = [f"g{base}w{rng.randrange(10**6)}" for _ in range(80)]
        rows += [(None if i == 2 else base * 10 + i, " ".join([*words, f"end{i}"])) for i in range(4)]
    found = ngram_join.groups(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == {
        base * 10 + i: base * 10 for base in range(40) for i in (0, 1, 3)
    }
    assert sorted(r.component_id for r in found if r.doc_id is None) == [base * 10 for base in range(40)]


def test_one_of_each_decides_per_row(spark):
    """Repeated and missing ids: only copies go, and one row of each group stays."""
    text, other = "one two three four five six seven", "quite another text that is near to nothing"
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, text), (2, text), (2, other), (3, "x marks the spot on this old map"), (3, "y is a letter of the alphabet too")]
    left = ngram_join.one_of_each(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([rows[0], rows[2], rows[3], rows[4]])
    rows = [(None, text), (None, text), (None, near), (None, near + " nu"), (7, other), (None, other), (5, near + " nu xi"),
            (9, "same row twice in the same table"), (9, "same row twice in the same table"), (None, ""), (None, None)]
    left = ngram_join.one_of_each(documents(spark, rows), percent=70).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == sorted(
        (str(i), str(t)) for i, t in [rows[0], rows[4], rows[6], rows[7], rows[9], rows[10]]
    )


def test_empty_table(spark):
    found = ngram_join.groups(documents(spark, []))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert found.count() == 0
    assert ngram_join.one_of_each(documents(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_clean_documents(spark):
    texts = corpus(8)
    rows = [*texts.items(), (500, "one text of its own"), (500, "one text of its own"), (501, None), (502, "")]
    docs = documents(spark, rows)
    left = ngram_join.one_of_each(docs)
    want = plain.near_groups(texts, 5, 80)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({*want.values(), 500, 501, 502})


@pytest.mark.parametrize("heap", [0, 10**9])
def test_index_against_brute_force(monkeypatch, heap):
    monkeypatch.setattr(divideskip, "HEAP_ENTRIES", heap)
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 400, 60))
    sets = [np.unique(np.append(base[rng.random(len(base)) < p], rng.integers(0, 400, 3)))
            for p in rng.choice([0.5, 0.9, 0.97, 1.0], 80)]
    for percent in (50, 85, 100):
        index = divideskip.Index(sets, percent)
        for query in sets[:20]:
            both = [len(np.intersect1d(query, s)) for s in sets]
            want = [i for i, (s, b) in enumerate(zip(sets, both, strict=True))
                    if 100 * b >= percent * (len(s) + len(query) - b)]
            assert index.search(query, np.zeros(len(sets), dtype=bool)).tolist() == want


def test_a_token_that_is_not_in_the_index_counts_for_none():
    index = divideskip.Index([np.array([3, 4, 5])], 85)
    assert index.search(np.array([5, 7, 9]), np.zeros(1, dtype=bool)).tolist() == []
    assert index.search(np.array([3, 4, 5]), np.zeros(1, dtype=bool)).tolist() == [0]


def test_shingles_of_blocks_are_those_of_the_whole(monkeypatch):
    text = ("Ab c\x0bd\x1ce Ä f " * 400).encode()
    whole = [s.tolist() for s in shingles.shingle_sets([text, b"", None, b"a"], 4)]
    assert len(whole[0]) == len(plain.shingles(text.decode(), 4))
    monkeypatch.setattr(shingles, "BLOCK", 50)
    assert [s.tolist() for s in shingles.shingle_sets([text, b"", None, b"a"], 4)] == whole


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(2000, 2050)] + [(1, 1)]
    want = plain.grouped({n for e in edges for n in e}, edges)
    frame = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    found = {r.node: r.component for r in graph.components(frame).collect()}
    loops = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: c for n, c in want.items() if n not in loops}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
