"""N-gram Jaccard join: which texts share enough of their word shingles, without missing any.

An inverted list of a shingle is the list of texts that hold it. A text can only reach the
required overlap with texts found on its shortest lists: as many lists as the overlap allows to
miss, plus one. A fixed share of all shingles, told by their hash, is posted, which is enough to
take the shortest lists from; lists of one text need no further step, and lists of passages that
many texts share are too long to be among the shortest. All texts on one short list meet in the
cell of the least text on it. Inside a cell DivideSkip runs the T-occurrence search: short lists
are merged through a heap, long ones are probed by binary search, and texts that reach the overlap
are linked. Links join groups; a text already in the group of another is not compared with it
again, so a large group of copies costs about one comparison per copy and is never written as
pairs.

Shingles, sets and texts are told apart by 64-bit hashes. Rows are told by their text, so rows
without doc_id and rows that repeat one are searched like all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of, cells
from barloom.llm.common import landed
from barloom.llm.divideskip import Index
from barloom.llm.graph import components
from barloom.llm.shingles import fingerprint, shingle_sets

#: A block of a cell holds about so many texts and so many shingles; larger cells are cut.
BLOCK_TEXTS, BLOCK_SHINGLES = 4096, 1 << 21
#: Posted shingles and written sets per Arrow batch.
ROWS = 1 << 16
#: Bits of the filter that says which texts are wanted: so many per text, up to a bound. A full
#: filter lets more through than needed, which is joined away after it.
FILTER_BITS, MOST_BITS, SLICE = 16, 1 << 28, 1 << 10  # a slice in bytes


def short_lists(size, percent: int):
    """How many lists a text of so many shingles has to look at (a number or a column)."""
    if isinstance(size, Column):
        return F.when(size > 0, size - F.ceil(size * percent / 100.0) + 1).otherwise(0)
    return size - -(-percent * size // 100) + 1 if size else 0


def _posted(found: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles of a set that are posted, and how many of them lie in the common share.

    The share is the same part of the hash range for all texts, twice what a text may miss. A
    small text with fewer there posts the next ones by hash, so that it posts enough.
    """
    edge = np.uint64((100 - percent) * 2 * 2**64 // 100 - 1)
    inside = int(np.searchsorted(found, edge, side="right"))
    return found[: max(inside, short_lists(len(found), percent))], inside


FACTS = {
    "doc_id": pa.int64(), "text": pa.int64(), "n": pa.int64(), "a": pa.int64(), "inside": pa.int64(),
    "posted": pa.list_(pa.int64()),
}
FACT_ROWS = "doc_id long, text long, n long, a long, inside long, posted array<long>"


def _describing(words: int, percent: int) -> Callable[[Batches], Batches]:
    """Size and fingerprint of every text's set, and the posted shingles of sets that are new to
    the task; from doc_id, the text's hash and the text."""

    def describe(batches: Batches) -> Batches:
        seen: set[int] = set()
        for batch in batches:
            rows, held = [], 0
            ids = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            texts = batch.column(2)
            sets = shingle_sets((t.as_py() for t in texts), words)
            for (doc, text), found in zip(ids, sets, strict=True):
                if not len(found):
                    rows.append((doc, text, 0, None, 0, None))
                    continue
                a, (posted, inside) = fingerprint(found), _posted(found, percent)
                new = a not in seen
                seen.add(a)
                rows.append((doc, text, len(found), a, inside, posted.view(np.int64) if new else None))
                held += len(posted) if new else 0
                if held > ROWS:
                    yield batch_of(FACTS, rows)
                    rows, held = [], 0
            yield batch_of(FACTS, rows)

    return describe


def _slot(x: np.ndarray, slots: int) -> np.ndarray:
    mixed_ids = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed_ids >> np.uint64(20)).astype(np.int64) % slots


def marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the filter has the numbers; it may have others too."""
    slot = _slot(ids, len(bits) * 8)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _slices(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    filled = {k: v.tobytes() for k, v in held.items() if v.any()}
    return batch_of({"slice": pa.int32(), "bits": pa.binary()}, list(filled.items()))


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit per slot of the given numbers: parts of it per task, put together slice by slice."""
    slices = max(1, min(MOST_BITS, ids.count() * FILTER_BITS) // (8 * SLICE))

    def marking(batches: Batches) -> Batches:
        own = np.zeros(slices * SLICE, dtype=np.uint8)
        for batch in batches:
            slot = _slot(batch.column(0).to_numpy(zero_copy_only=False), len(own) * 8)
            np.bitwise_or.at(own, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))
        yield _slices(dict(enumerate(own.reshape(-1, SLICE))))

    def uniting(batches: Batches) -> Batches:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                part = np.frombuffer(data, dtype=np.uint8)
                held[key] = held[key] | part if key in held else part
        yield _slices(held)

    shape = "slice int, bits binary"
    parts = ids.mapInArrow(marking, shape).repartition("slice").mapInArrow(uniting, shape)
    out = np.zeros((slices, SLICE), dtype=np.uint8)
    for row in parts.collect():  # MOST_BITS at most
        out[row["slice"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out.reshape(-1)


SETS = {"text": pa.int64(), "a": pa.int64(), "set": pa.list_(pa.int64())}


def _setting(words: int, wanted) -> Callable[[Batches], Batches]:
    """Whole sets of the texts that the filter lets through, from the texts' hashes and the texts;
    copies in one task come once."""

    def sets(batches: Batches) -> Batches:
        seen: set[int] = set()
        bits = wanted.value
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            ids = keys.tolist()
            there = np.nonzero(marked(bits, keys))[0].tolist()
            rows = [i for i in there if not (ids[i] in seen or seen.add(ids[i]))]
            out, held = [], 0
            for i, found in zip(rows, shingle_sets((texts[i].as_py() for i in rows), words), strict=True):
                if len(found):
                    out.append((ids[i], fingerprint(found), np.sort(found.view(np.int64))))
                    held += len(found)
                if held > 8 * ROWS:
                    yield batch_of(SETS, out)
                    out, held = [], 0
            yield batch_of(SETS, out)

    return sets


EDGE, LEFT = 0, 1
LINK = {"kind": pa.int8(), "u": pa.int64(), "v": pa.int64()}


def _links(rows: Iterator[list[tuple[int, int, int]]]) -> Batches:
    for found in rows:
        if found:
            yield batch_of(LINK, found)


def search_block(
    index: Index, ids: list[int], sets: list[np.ndarray], queries: list[int], roots: np.ndarray
) -> list[tuple[int, int]]:
    """Links that connect the queries with what they reach, one for each two parts joined.

    ``roots`` tells the parts, by any member each, and is kept up to date.
    """
    links = []
    for q in queries:
        found = index.search(sets[q], roots == roots[q])
        parts, first = np.unique(roots[found], return_index=True)
        links += [(ids[q], ids[i]) for i in found[first]]
        roots[np.isin(roots, parts)] = roots[q]
    return links


def _within(percent: int) -> Callable[[Batches], Batches]:
    """Blocks of a cell: its centre first, then the texts that are not linked to the centre.

    Texts in the centre's part are connected, so only texts outside it have anything to find.
    """

    def rows(batches: Batches) -> Iterator[list[tuple[int, int, int]]]:
        for (centre, _), texts in cells(batches, 2):
            ids, blocks, sets = zip(*texts, strict=True)
            if centre not in ids:
                continue
            at, index, roots = ids.index(centre), Index(list(sets), percent), np.arange(len(ids))
            found = search_block(index, ids, sets, [at], roots)
            for i in range(len(ids)):
                if roots[i] != roots[at]:
                    found += search_block(index, ids, sets, [i], roots)
            out = [(EDGE, *link) for link in found]
            if blocks[0] > 1:
                out += [(LEFT, centre, ids[i]) for i in np.nonzero(roots != roots[at])[0]]
            yield out

    return lambda batches: _links(rows(batches))


def _across(percent: int) -> Callable[[Batches], Batches]:
    """Texts left over in other blocks of a cell against one block."""

    def rows(batches: Batches) -> Iterator[list[tuple[int, int, int]]]:
        for _, texts in cells(batches, 3):
            # role 0: linked to the centre, 1: in the block, 2: left over elsewhere
            ids, roles, sets = zip(*texts, strict=True)
            index, roots, role = Index(list(sets), percent), np.arange(len(ids)), np.array(roles)
            if (role == 0).any():
                roots[role == 0] = np.nonzero(role == 0)[0][0]
            queries = np.nonzero(role == 2)[0].tolist()
            yield [(EDGE, *link) for link in search_block(index, ids, sets, queries, roots)]

    return lambda batches: _links(rows(batches))


def _searched(rows: DataFrame, keys: list[str], run: Callable[[Batches], Batches]) -> DataFrame:
    dealt = rows.repartition(*keys).sortWithinPartitions(*rows.columns[:-1])
    return dealt.mapInArrow(run, "kind byte, u long, v long")


def _blocks_of(texts: Column, shingles: Column) -> Column:
    return F.greatest(
        F.ceil(texts / F.lit(float(BLOCK_TEXTS))), F.ceil(shingles / F.lit(float(BLOCK_SHINGLES)))
    ).cast("int")


def _link_cells(members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside the cells; ``members`` has (c, x), a centre is not a member of its cell."""
    sized = members.join(sizes, "x").groupBy("c").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles")
    )
    cells = landed(sized.select("c", _blocks_of(F.col("texts"), F.col("shingles")).alias("k")), "cells")
    block = F.pmod(F.xxhash64("x"), F.col("k")).cast("int")
    own = members.join(cells, "c").select("c", block.alias("block"), "x", "k")
    centre = cells.select(
        "c", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("block"), F.col("c").alias("x"), "k"
    )
    rows = own.union(centre).join(sets, "x").select("c", "block", "x", "k", "set")
    found = landed(_searched(rows, ["c", "block"], _within(percent)), "links")
    links = found.where(F.col("kind") == EDGE).select("u", "v")
    left = found.where(F.col("kind") == LEFT).select(F.col("u").alias("c"), F.col("v").alias("x"))
    if left.isEmpty():
        return links

    # Cells of several blocks: texts without a link to the centre meet the other blocks.
    chunks = left.join(sizes, "x").groupBy("c").agg(
        _blocks_of(F.count(F.lit(1)), F.sum("n")).alias("chunks")
    )
    wide = chunks.join(cells, "c")
    loose = left.withColumn("role", F.lit(1))
    block_rows = own.drop("k").join(wide, "c").join(loose, ["c", "x"], "left").select(
        "c", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "x",
        F.coalesce("role", F.lit(0)).alias("role"),
    )
    query_rows = left.join(wide, "c").withColumn("own", block).select(
        "c", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("block"),
        F.pmod(F.xxhash64("x", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"), "x",
        F.lit(2).alias("role"), "own",
    ).where(F.col("own") != F.col("block")).drop("own")
    rows = block_rows.union(query_rows).join(sets, "x").select("c", "block", "chunk", "x", "role", "set")
    more = _searched(rows, ["c", "block", "chunk"], _across(percent))
    return links.union(landed(more, "links").select("u", "v"))


def _met(facts: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(c, x): texts on a short list, with the least text of the list; sets stand for texts."""
    postings = facts.where("posted IS NOT NULL").select(F.explode("posted").alias("token"), "a")
    held = Window.partitionBy("token")
    lists = postings.select(
        "token", "a", F.count(F.lit(1)).over(held).alias("long"),
        F.min("a").over(held).alias("least"), F.max("a").over(held).alias("most"),
    )
    # Sets in one partition from here on: the own lists, their rank, the ones to look at.
    shared = lists.where(F.col("least") != F.col("most")).select("token", "a", "long")
    shared = shared.repartition("a").dropDuplicates(["a", "token"])
    own = Window.partitionBy("a")
    ranked = shared.join(nodes.select("a", "n", "inside"), "a").select(
        "a", "token", "n", "inside", F.count(F.lit(1)).over(own).alias("shared"),
        F.row_number().over(own.orderBy("long", "token")).alias("rank"),
    )
    need = short_lists(F.col("n"), percent)
    alone = F.col("inside") - F.col("shared")  # lists of one text come first
    short = (F.col("inside") < need) | (F.col("rank") <= need - alone)
    short = landed(ranked.where(short).select("token", F.col("a").alias("x")), "short")
    least = short.groupBy("token").agg(F.min("x").alias("c"))
    met = short.join(least, "token").where(F.col("x") != F.col("c"))
    return landed(met.select("c", "x").distinct(), "members")


def _text_key(docs: DataFrame) -> Column:
    """Hash of a text, null as empty."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _classed(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Facts of every row, and per set (a, component, least): its component, by any member, and
    the least doc_id there."""
    texts = docs.select(
        F.col("doc_id").cast("long"), _text_key(docs).alias("key"), F.col("text").cast("binary")
    )
    facts = landed(texts.mapInArrow(_describing(words, percent), FACT_ROWS), "facts")
    nodes = facts.where("n > 0").groupBy("a").agg(
        F.min("doc_id").alias("doc"), F.min("text").alias("text"), F.max("n").alias("n"),
        F.max("inside").alias("inside"),
    )
    nodes = landed(nodes, "nodes")
    members = _met(facts, nodes, percent)

    wanted = members.select("x").union(members.select(F.col("c").alias("x"))).distinct()
    wanted = nodes.join(wanted, F.col("a") == F.col("x")).select(F.col("text").alias("key"), "a")
    wanted = landed(wanted, "wanted")
    # Texts stay where they are: a filter of their hashes lets those through whose sets are needed.
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("key")))
    read = texts.select("key", "text")
    sets = read.mapInArrow(_setting(words, bits), "key long, a long, set array<long>")
    sets = sets.join(wanted, ["key", "a"]).dropDuplicates(["a"])
    sets = landed(sets.select(F.col("a").alias("x"), "set"), "sets")

    sizes = nodes.select(F.col("a").alias("x"), "n")
    tied = components(_link_cells(members, sizes, sets, percent)).withColumnRenamed("node", "a")
    known = nodes.select("a", "doc").join(tied, "a", "left").select(
        "a", "doc", F.coalesce("component", "a").alias("component")
    )
    least = known.groupBy("component").agg(F.min("doc").alias("least"))
    return facts.drop("posted"), known.join(least, "component").select("a", "component", "least")


def groups(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two texts are linked when 100 * (shingles of both) >= percent * (shingles of either);
    ``component_id`` is the least doc_id that links reach. Texts with equal sets are one class,
    searched once. Null, empty and word-less texts have no shingles and are linked with nothing.
    Rows that repeat a doc_id are texts of their own, which may lie in different components. Rows
    without doc_id are linked like others; a component of such rows alone has no id. An empty
    table gives no rows.
    """
    facts, classes = _classed(docs, words, percent)
    return facts.select("doc_id", "n", "a").join(classes.select("a", "least"), "a", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents with one row of each group left; all without shingles stay.

    The row with the least doc_id stays, one with a doc_id before one without; of several texts
    with that id the one with the least hash, and of rows equal in both one. What goes is decided
    per row: another text with the same doc_id is not touched.
    """
    facts, classes = _classed(docs, words, percent)
    rows = landed(facts.where("n > 0").join(classes, "a").select("component", "doc_id", "text"), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text")
    kept = rows.groupBy("component").agg(F.min(place).alias("kept")).select(
        "component", F.col("kept.doc_id").alias("kept_id"), F.col("kept.text").alias("kept_text")
    )
    told = rows.join(kept, "component").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text") == F.col("kept_text"))
    )
    gone = told.where(~F.col("stays")).select(
        F.col("doc_id").alias("__doc"), F.col("text").alias("__text")
    ).distinct()
    gone = landed(gone, "gone")
    # Only rows that the filter takes for gone are shuffled and looked up.
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(gone.select("__text")))

    @F.pandas_udf("boolean")
    def maybe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(marked(bits.value, keys.to_numpy()))

    keyed = docs.withColumn("__key", _text_key(docs)).withColumn("__maybe", maybe("__key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__text"))
    sure, unsure = (keyed.where(c).drop("__maybe") for c in (~F.col("__maybe"), F.col("__maybe")))
    left = sure.union(unsure.join(gone, same, "left_anti"))

    again = told.where("stays").groupBy("kept_id", "kept_text").count().where("count > 1")
    again = landed(again.select(F.col("kept_id").alias("__doc"), F.col("kept_text").alias("__text")), "again")
    if again.isEmpty():
        return left.select(*docs.columns)
    repeated = left.join(again, same, "left_semi")
    first = repeated.dropDuplicates(["doc_id", "__key"])
    return left.join(again, same, "left_anti").union(first).select(*docs.columns)
