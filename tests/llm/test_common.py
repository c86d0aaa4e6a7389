import itertools
import random

import plain
import pytest
from pyspark.sql import functions as F

from barloom.llm import common


@pytest.mark.parametrize("text", [None, "", " ", "a", " a\tb\x0bc\x0cd\r\ne ", "a\xa0b", "a\x1cb c", "ä ö\U0001f600 x"])
def test_words(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(common.word_count(F.col("t")).alias("n")).first()
    assert row.n == len(plain.words(text))


def test_places_and_sums_in_one_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), i, rng.randrange(9)) for i in range(2000)] + [(None, 5000, 3), (7, 6000, None)]
    frame = spark.createDataFrame(rows, "a int, b long, w long").repartition(7)
    got = common.in_order(frame, [F.col("a"), F.col("b")], {"before": "w"}).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sums = itertools.accumulate((r[2] or 0 for r in want), initial=0)
    assert sorted((r["__place"], r.b, r.before) for r in got) == [
        (i, r[1], s) for i, (r, s) in enumerate(zip(want, sums, strict=False))
    ]


def test_equal_rows_and_nothing(spark):
    same = spark.createDataFrame([(1, 2)] * 50, "a int, w long")
    got = common.in_order(same, [F.col("a")], {"before": "w"}).collect()
    assert sorted((r["__place"], r.before) for r in got) == [(i, 2 * i) for i in range(50)]
    assert common.in_order(same.limit(0), [F.col("a")], {"before": "w"}).count() == 0
