"""Exact copies: equal bytes only, whatever the keys, and an index that can be gone on with."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barloom.llm import exact_dedup
from barloom.llm.exact_dedup import deduplicate, directory

SCHEMA = "doc_id long, text string, key int, n string, ref long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


ROWS = (
    [(i, f"text {i % 37}") for i in range(200)]
    + [(1000 + i, "the same again and again") for i in range(120)]
    + [(2000, None), (2001, ""), (2002, " "), (2003, "Text 1"), (2004, "text 1 "), (None, "text 1")]
    + [(None, "nobody"), (None, "nobody"), (7, "text 7"), (7, "other"), (2005, "é"), (2006, "é")]
    + [(3000, "long " * 200_000), (3001, "long " * 200_000), (3002, "long " * 199_999)]
)


@pytest.mark.parametrize("room", [exact_dedup.ROOM, 1])
@pytest.mark.parametrize("bits", [64, 3, 0])
def test_like_brute_force(spark, monkeypatch, room, bits):
    """Few bits of key make all texts collide: only bytes tell them apart."""
    monkeypatch.setattr(exact_dedup, "HELD", 2000)
    monkeypatch.setattr(exact_dedup, "DEEPEST", 12)

    def key(text):
        return F.xxhash64(text).bitwiseAND(-1 << (64 - bits) if bits else 0).cast("long")

    copies = deduplicate(frame(spark, ROWS).repartition(5), key=key, room=room)
    assert copies.documents.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(copies.documents) == brute(ROWS)
    kept = copies.documents.where("kept").collect()
    texts = {t or "" for _, t in ROWS}
    assert len(kept) == len(texts) and all(r.doc_id == r.keep_id for r in kept)
    assert sorted(bytes(r.text).decode() for r in copies.index.collect()) == sorted(texts)


def test_few_and_none(spark):
    assert deduplicate(frame(spark, [])).documents.count() == 0
    assert found(deduplicate(frame(spark, [(None, None)])).documents) == brute([(None, None)])
    assert deduplicate(frame(spark, [(None, None), (None, "")])).documents.where("kept").count() == 1


def test_buckets_split_until_they_have_room(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    near = spark.range(64).select((F.col("id") + (5 << 50)).alias("key"))  # same leading bits
    found_keys = keys.union(near)
    tree = directory(found_keys, room=40).collect()
    assert sum(b["keys"] for b in tree) == 3064
    assert all(b["keys"] <= 40 or b.depth == exact_dedup.DEEPEST for b in tree)
    spans = sorted((b.prefix << (64 - b.depth), (b.prefix + 1) << (64 - b.depth)) for b in tree)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_goes_on_from_an_index(spark, tmp_path):
    """Two batches through the index give the groups of both together."""
    first, second = ROWS[::2], ROWS[1::2]
    begun = deduplicate(frame(spark, first))
    begun.index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    after = deduplicate(frame(spark, second), index)
    both = {(r[0], r[1], r[2], r[3]) for r in brute(ROWS)}
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in after.documents.collect()} <= both
    whole = deduplicate(frame(spark, ROWS)).index
    columns = ["key", "keep_id", "n", "sha256", "text"]
    assert sorted(map(str, after.index.select(*columns).collect())) == sorted(
        map(str, whole.select(*columns).collect())
    )
    assert whole.schema.simpleString() == begun.index.schema.simpleString()


def test_copies_are_combined_before_they_move(spark):
    """A text that a third of all rows share is one entry per reading task."""
    rows = spark.range(0, 3000, 1, 3).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
    )
    copies = deduplicate(rows)
    hot = copies.documents.where("group_size > 1")
    assert hot.count() == 1000 and hot.select("keep_id").distinct().collect()[0][0] == 2997
