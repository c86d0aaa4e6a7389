import os

import numpy as np
import pytest

from barloom.llm import langid

SAMPLE = {
    "en": ["the cat and the dog were in the house", "this is what they have been saying about that"],
    "de": ["der hund und die katze sind nicht zu hause", "das ist ein sehr schöner tag für euch"],
    "fr": ["le chien et le chat sont dans la maison", "où est-ce que vous êtes allés hier soir"],
}


def grams(text):
    clean = []
    for c in text.lower():
        c = c if c.isalpha() else " "
        if not (c == " " and clean and clean[-1] == " "):
            clean.append(c)
    return {"".join(clean[i : i + n]) for n in range(1, langid.LONGEST + 1) for i in range(len(clean) - n + 1)}


def test_presence_kernel_like_brute_force(monkeypatch):
    texts = [t for group in SAMPLE.values() for t in group]
    others = ["The  DOG, the?", "zz", "", "Ünder wo?!", "キ cat"]
    for chars in (langid.CHARS, 7):
        monkeypatch.setattr(langid, "CHARS", chars)
        known = langid.learn_grams(langid.symbol_table(texts), texts)
        marks, told = langid.presence(known, texts), langid.presence(known, others)
        every = set().union(*map(grams, texts))
        for i, other in enumerate(others):
            held = grams(other) & every
            for j, text in enumerate(texts):
                want = len(held & grams(text)) / np.sqrt(max(len(held), 1) * len(grams(text)))
                assert told[i] @ marks[j] == pytest.approx(want, abs=1e-5)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, __x int")


def labelled(spark, extra=()):
    rows, number = [], 0
    for lang, texts in SAMPLE.items():
        for text in texts * 30:
            rows.append((number, text, lang, 0.0, 1))
            number += 1
    return frame(spark, [*rows, *extra])


def test_identify(spark):
    extra = [(9000, None, "en", None, 1), (9001, "", None, None, 1), (9002, "123 ... %%", "fr", None, 1),
             (9003, "und die katze und der hund", None, None, 1), (9004, "привет", None, None, 1),
             (None, "the dog and the cat", "en", None, 1), (9005, "le chat et le chien " * 60_000, None, None, 1)]
    docs = labelled(spark, extra)
    got = langid.identify(docs)
    assert got.columns == [*docs.columns, "__lang", "__score"]
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i]["__lang"] for i in (9000, 9001, 9002)] == ["und"] * 3
    assert (rows[9003]["__lang"], rows[9005]["__lang"], rows[None]["__lang"]) == ("de", "fr", "en")
    assert rows[9004]["__score"] == 0.0 and rows[9004]["__lang"] == "de"
    assert all(0 <= r["__score"] <= 1 for r in rows.values())
    assert all(r["__lang"] == r.lang for i, r in rows.items() if i is not None and i < 9000)
    left = langid.kept(docs)
    assert left.columns == docs.columns
    gone = {9000, 9001, 9002, 9004}
    assert {r.doc_id for r in left.collect()} == set(rows) - gone


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "some text", None, None, 1), (2, None, None, None, 1)])
    assert {r["__lang"] for r in langid.identify(docs).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_one_language(spark):
    docs = frame(spark, [(i, "the same language", "en", None, 1) for i in range(20)])
    assert {(r["__lang"], round(r["__score"])) for r in langid.identify(docs).collect()} == {("en", 1)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).where(langid.held_out(docs.doc_id) & docs.lang.isNotNull()).collect()
    assert sum(r["__lang"] == r.lang for r in rows) >= 0.97 * len(rows) > 100
    # lang, source and doc_id are no inputs of a prediction
    swapped = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 <> 0 THEN lang END AS lang")
    again = langid.identify(swapped).where(langid.held_out(docs.doc_id)).collect()
    assert {r.doc_id: r["__lang"] for r in again} == {r.doc_id: r["__lang"] for r in rows} | {
        r.doc_id: r["__lang"] for r in again if r.doc_id not in {x.doc_id for x in rows}
    }


def test_languages_of_many_letters(spark):
    """Two made-up languages of 250 letters each, and texts of rare letters of theirs."""
    rng = np.random.default_rng(3)
    rows = []
    for lang, first in (("aa", 0x4E00), ("bb", 0xAC00)):
        for i in range(150):
            letters = rng.integers(0, 250, 120) if i % 3 else rng.integers(200, 250, 60)
            text = "".join(chr(first + int(c)) + (" " if rng.random() < 0.2 else "") for c in letters)
            rows.append((len(rows), text, lang, 0.0, 1))
    got = langid.identify(frame(spark, rows)).collect()
    assert all(r["__lang"] == r.lang and r["__score"] > 0.25 for r in got)


def test_a_language_of_long_texts_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_CHARS", 60)
    long = [(5000 + i, f"o gato e o cachorro estão na casa velha {i} " * 9, "pt", 0.0, 1) for i in range(40)]
    got = langid.identify(labelled(spark, long)).collect()
    assert {r["__lang"] for r in got if r.doc_id >= 5000} == {"pt"}
    assert all(r["__lang"] == r.lang for r in got if r.doc_id < 5000)


def test_blocks_are_bounded_and_change_nothing(monkeypatch):
    texts = [t for group in SAMPLE.values() for t in group]
    names = [lang for lang, group in SAMPLE.items() for _ in group]
    model = langid.fit(texts, names)
    want = langid.predict(model, texts * 40)
    monkeypatch.setattr(langid, "CELLS", 3 * model.grams.size)
    assert [len(b) for b in langid.in_blocks(model.grams, texts)] == [3, 3]
    got = langid.predict(model, texts * 40)
    assert got[0] == want[0] and np.allclose(got[1], want[1], atol=1e-6)


def test_scores_like_plain_kernel_regression():
    """Nystroem features and ridge weights against the same written out over a plain kernel."""
    texts = [t for group in SAMPLE.values() for t in group]
    names = [lang for lang, group in SAMPLE.items() for _ in group]
    others = ["der hund und das haus", "they were in the house", "vous êtes dans la maison", "cat"]
    every = set().union(*map(grams, texts))

    def kernel(a, b):
        a, b = grams(a) & every, grams(b) & every
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    def table(rows):
        return np.array([[kernel(r, t) for t in texts] for r in rows])

    values, vectors = np.linalg.eigh(table(texts))
    sound = values > 1e-6 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])
    features = table(texts) @ root
    labels = sorted(set(names))
    wanted = np.array([[1.0 if n == label else -1.0 for label in labels] for n in names])
    normal = features.T @ features + langid.RIDGE * len(texts) * np.eye(features.shape[1])
    weights = np.linalg.solve(normal, features.T @ wanted)
    told = table(others) @ root @ weights
    got, scores = langid.predict(langid.fit(texts, names), others)
    assert got == [labels[i] for i in told.argmax(axis=1)]
    assert np.allclose(scores, np.clip((told.max(axis=1) + 1) / 2, 0, 1), atol=1e-3)
