"""The registered queries against their SQL, and the pipeline against plain code."""

import os

import plain
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from barloom.llm import langid, mixing, ngram_join, queries
from checks.compare import differences, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.partition("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "mixing", "packing"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert [p for p in differences(df, duck(SF), queries.SQL[name]) if "note" not in p] == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_whole_results(spark, name):
    """Queries without SQL: a row per row of their table; brute force is in their own tests."""
    rows = queries.QUERIES[name](spark, SF).count()
    assert rows == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = corpus_pipeline.known_language(spark, docs, SF)
    assert told.columns == docs.columns
    texts = {r.doc_id: r.text for r in told.collect()}
    rejected = {r.doc_id for r in langid.identify(docs).where("`__score` < 0.25").collect()}
    assert set(texts) == {r.doc_id for r in docs.collect()} - rejected

    one = corpus_pipeline.without_near_copies(spark, told, SF)
    assert one.columns == docs.columns
    want = plain.near_groups(texts, 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(want.values()))
    assert ngram_join.one_of_each(told).count() == len(set(want.values()))

    mixed = corpus_pipeline.mixture(spark, one, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix(one, mixing.text_weight(one.text)).documents.collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies

    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in packed) == sorted(i for i, n in copies.items() for _ in range(n))
    assert all(r.n_tokens == len(plain.words(texts[r.doc_id])) for r in packed)
