"""From raw documents to training batches: language, near-duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. What a stage returns is written
as Parquet and read again as the documents of the next, so a lost executor costs a stage at most.
All stages but the last return the columns of documents; the mixture repeats a document as often
as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import langid, mixing, ngram_join, packing
from barloom.llm.common import landed


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without letters go."""
    return langid.kept(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated up to three times."""
    return mixing.mixed(docs, mixing.text_weight(docs["text"]))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document of the mixture."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("ngram_join", without_near_copies),
    ("mixing", mixture),
    ("packing", batches),
]

#: SQL can express neither the classifier nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
