"""Exact copies through an extendible-hash index on shared files.

Each text has a 64-bit key. Tasks that read documents combine equal texts before anything moves. A
directory maps the leading bits of a key to a bucket; a bucket with too many keys is split by one
more bit, which doubles the directory. Each owner task takes one range of the directory, and so of
the keys, puts the texts of a key in a chain and compares their bytes: the key decides where a
text is looked up, the bytes decide what it equals.

Everything lies in tables in the shared folder: the combined texts, the directory, and the index of
all different texts, which a later run can go on from. The index names the place of a text; texts
are written once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from math import ceil, log2
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of
from barloom.llm.common import landed

#: Different keys of a bucket; one with more of them is split.
ROOM = 4096
#: Bits after which a bucket is no longer split: its keys share a longer bucket.
DEEPEST = 40
#: Bytes of texts that a reading task combines at a time, and that an owner should get.
HELD, OWNED = 32 << 20, 32 << 20
#: Bytes of texts in one Arrow batch.
BATCH = 8 << 20

DOCUMENT, TEXT = 0, 1  # kinds of rows that reading tasks write
DIRECTORY, ENTRY = 0, 1  # kinds of rows that owners take
MEMBER, INDEXED = 0, 1  # kinds of rows that owners write

READ = {
    "kind": pa.int32(), "ref": pa.int64(), "row": pa.int64(), "doc_id": pa.int64(),
    "key": pa.int64(), "n": pa.int64(), "sha256": pa.string(), "bytes": pa.int64(), "text": pa.binary(),
}
READ_ROWS = (
    "kind int, ref long, row long, doc_id long, key long, n long, sha256 string, bytes long, "
    "text binary"
)
OWN = {
    "kind": pa.int32(), "ref": pa.int64(), "keep_row": pa.int64(), "keep_id": pa.int64(),
    "n": pa.int64(), "sha256": pa.string(), "depth": pa.int32(), "prefix": pa.int64(),
    "key": pa.int64(), "link": pa.int32(),
}
OWN_ROWS = (
    "kind int, ref long, keep_row long, keep_id long, n long, sha256 string, depth int, "
    "prefix long, key long, link int"
)
#: Rows that an owner writes at a time.
ROWS = 10_000


class Copies(NamedTuple):
    """``documents``: a row per document. ``index``: a row per different text."""

    documents: DataFrame
    index: DataFrame


def _text_batches(rows: Iterator[tuple]) -> Batches:
    """Rows that end with a text, in batches of a bounded number of bytes."""
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += len(row[-1]) + 64
        if held > BATCH:
            yield batch_of(READ, waiting)
            waiting, held = [], 0
    if waiting:
        yield batch_of(READ, waiting)


def _rank(doc_id: int | None, row: int) -> tuple:
    """The greatest of these is the row that stays: largest id, ids before none, first row."""
    return (doc_id is not None, doc_id or 0, -row)


def _combining(batches: Batches) -> Batches:
    """Documents and, per task and HELD bytes, the different texts among them.

    The columns are doc_id, key, sha256 and text.
    """
    base = TaskContext.get().partitionId() << 33
    chains: dict[int, list[list]] = {}
    held = rows = refs = 0

    def combined() -> Iterator[tuple]:
        for key, chain in chains.items():
            for ref, row, doc_id, n, sha256, text in chain:
                yield (TEXT, ref, row, doc_id, key, n, sha256, len(text), text)

    for batch in batches:
        documents = []
        texts = batch.column(3)
        scalars = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
        for i, (doc_id, key, sha256) in enumerate(scalars):
            text, row = texts[i].as_py(), base + rows
            rows += 1
            chain = chains.setdefault(key, [])
            for entry in chain:
                if entry[5] == text:
                    entry[3] += 1
                    if _rank(doc_id, row) > _rank(entry[2], entry[1]):
                        entry[1:3] = row, doc_id
                    break
            else:
                entry = [base + refs, row, doc_id, 1, sha256, text]
                refs += 1
                held += len(text) + 200
                chain.append(entry)
            documents.append((DOCUMENT, entry[0], row, doc_id, None, None, None, None, None))
            if held > HELD:
                yield batch_of(READ, documents)
                yield from _text_batches(combined())
                documents, held = [], 0
                chains.clear()
        yield batch_of(READ, documents)
    yield from _text_batches(combined())


def prefix(key: Column, depth: int) -> Column:
    """The leading bits of a key as a number from 0."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, least: int = 0, room: int = ROOM) -> DataFrame:
    """(depth, prefix, keys): the buckets of the different values of the column ``key``.

    The directory starts with enough bits for an even distribution, at least ``least``. Buckets
    with more than ``room`` keys are split, all of them in one round, until none is too full or
    DEEPEST bits are used. Counts are combined before the shuffle; a round reads only keys of the
    buckets that it splits. Buckets without keys are left out.
    """
    waiting = landed(keys.select("key").distinct(), "keys")
    count = waiting.count()
    depth = min(max(least, ceil(log2(max(count, 1) / room)) if count > room else 0), DEEPEST)
    done = []
    while True:
        buckets = waiting.groupBy(prefix(F.col("key"), depth).alias("prefix")).agg(
            F.count(F.lit(1)).alias("keys")
        )
        counted = landed(buckets.withColumn("depth", F.lit(depth)), "directory")
        done.append(counted.select("depth", "prefix", "keys"))
        full = counted.where(F.col("keys") > room)
        if depth >= DEEPEST or full.isEmpty():
            break
        done[-1] = done[-1].where(F.col("keys") <= room)
        split = waiting.withColumn("prefix", prefix(F.col("key"), depth))
        waiting = landed(split.join(full, "prefix", "left_semi").select("key"), "keys")
        depth += 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


class _Chain:
    """The different texts of one key, with what refers to each of them."""

    def __init__(self) -> None:
        self.links: list[list] = []  # text, sha256, n, keep_row, keep_id, refs

    def add(self, ref: int, row: int, doc_id: int | None, n: int, sha256: str, text: bytes) -> None:
        for link in self.links:
            if link[0] == text:
                link[2] += n
                if _rank(doc_id, row) > _rank(link[4], link[3]):
                    link[3:5] = row, doc_id
                break
        else:
            link = [text, sha256, n, row, doc_id, []]
            self.links.append(link)
        link[5].append(ref)

    def rows(self, key: int, depth: int, start: int) -> Iterator[tuple]:
        for place, (_, sha256, n, row, doc_id, refs) in enumerate(self.links):
            for ref in refs:
                if ref >= 0:
                    yield (MEMBER, ref, row, doc_id, n, sha256, None, None, None, None)
            yield (INDEXED, refs[0], None, doc_id, n, sha256, depth, start, key, place)


def _owning(batches: Batches) -> Batches:
    """One owner's range of the directory, then its entries by key: chains, compared by bytes."""
    rows = _chained(batches)
    while some := list(islice(rows, ROWS)):
        yield batch_of(OWN, some)


def _chained(batches: Batches) -> Iterator[tuple]:
    buckets: set[tuple[int, int]] = set()
    depths: list[int] = []
    now, chain = None, _Chain()

    def closed() -> Iterator[tuple]:
        for depth in depths:
            start = (now & (1 << 64) - 1) >> (64 - depth)
            if (depth, start) in buckets:
                yield from chain.rows(now, depth, start)
                return
        raise ValueError(f"the directory has no bucket for key {now}")

    for batch in batches:
        texts = batch.column(8)
        scalars = zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True)
        for i, (_, kind, ref, row, doc_id, key, n, sha256) in enumerate(scalars):
            if kind == DIRECTORY:  # n carries the depth, key the prefix
                buckets.add((n, key))
                if n not in depths:
                    depths.append(n)
                continue
            if key != now:
                if now is not None:
                    yield from closed()
                now, chain = key, _Chain()
            chain.add(ref, row, doc_id, n, sha256, texts[i].as_py())
    if now is not None:
        yield from closed()


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def deduplicate(
    docs: DataFrame,
    index: DataFrame | None = None,
    key: Callable[[Column], Column] = text_key,
    room: int = ROOM,
) -> Copies:
    """The group of equal texts of every document, and the index of all different texts.

    ``documents``: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal if their bytes
    are; null counts as empty. Of equal texts the row with the largest doc_id stays; rows without
    doc_id come last, and of rows that repeat the largest one (or have none) the first read
    stays, so that each group has one row with ``kept``. An empty table gives no rows. Other
    columns are neither read nor returned.

    ``index`` is the index of earlier documents, a table with the columns of ``Copies.index``.
    They count in ``group_size`` and may hold ``keep_id``; no row of ``docs`` is kept then.

    The texts of a key are held by one owner one at a time in chains, entries of copies as one
    number per reading task. A text crosses the network once per reading task that has it.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", key(F.col("text")).alias("key"), F.sha2("text", 256).alias("sha256"),
        F.col("text").cast("binary").alias("text"),
    )
    rows = landed(read.mapInArrow(_combining, READ_ROWS), "texts")
    entries = rows.where(F.col("kind") == TEXT).select(
        "ref", "row", "doc_id", "key", "n", "sha256", "text", "bytes"
    )
    if index is not None:
        older = index.select(
            (F.lit(-1).cast("long") - F.col("link")).alias("ref"), F.lit(-1).cast("long").alias("row"),
            F.col("keep_id").alias("doc_id"), "key", "n", "sha256", "text",
            F.length("text").cast("long").alias("bytes"),
        )
        entries = entries.union(older)

    size = entries.agg(F.sum("bytes")).first()[0] or 0
    owners = max(size / OWNED, spark.sparkContext.defaultParallelism)
    bits = min(ceil(log2(owners)), DEEPEST) if size else 0
    tree = landed(directory(entries, bits, room), "directory")

    # Ranges of equal length in bits: no bucket is shorter than ``bits``, so none has two owners.
    first = F.col("prefix") if not bits else F.expr(f"shiftrightunsigned(prefix, depth - {bits})")
    none = F.lit(None)
    slots = tree.select(
        first.cast("int").alias("owner"), F.lit(DIRECTORY).alias("kind"), none.cast("long").alias("ref"),
        none.cast("long").alias("row"), none.cast("long").alias("doc_id"), F.col("prefix").alias("key"),
        F.col("depth").cast("long").alias("n"), none.cast("string").alias("sha256"),
        none.cast("binary").alias("text"),
    )
    dealt = entries.select(
        prefix(F.col("key"), bits).cast("int").alias("owner"), F.lit(ENTRY).alias("kind"),
        "ref", "row", "doc_id", "key", "n", "sha256", "text",
    )
    owned = slots.union(dealt).repartitionById(1 << bits, F.col("owner"))
    sorted_ = owned.sortWithinPartitions("kind", "key")
    chained = landed(sorted_.mapInArrow(_owning, OWN_ROWS), "index")

    members = chained.where(F.col("kind") == MEMBER).select("ref", "keep_row", "keep_id", "n", "sha256")
    read_rows = rows.where(F.col("kind") == DOCUMENT).select("ref", "row", "doc_id")
    documents = read_rows.join(members, "ref").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha256").alias("text_sha256"),
    )
    links = chained.where(F.col("kind") == INDEXED).drop("kind", "keep_row")
    found = links.join(entries.select("key", "ref", "text"), ["key", "ref"])
    return Copies(documents, found.select("depth", "prefix", "key", "link", "keep_id", "n", "sha256", "text"))
