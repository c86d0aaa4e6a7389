"""How much the sources of a language differ in their words.

Terms are never ranked or compared one by one. Those with the same counts are one cell: a cell of
(count in the group, count in the language) for the terms that stand out, a cell of (count here,
count there) for two sources. A figure is evaluated once per cell and weighed with the number of
terms in it; only the cells that reach the ranks asked for are opened again.

Counts become whole numbers on a scale of 10 ** 9 and stay whole, so results are exact.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.batches import Batches
from barloom.llm.common import landed

#: A term counts in a language if so many of its documents have it.
LEAST = 10
#: Terms listed per group.
TOP = 10
SCALE = 1_000_000_000
#: Texts of more bytes are counted in pieces, whose counts Spark adds up.
LONG = 4 << 20
#: Entries that a task combines before it hands them on.
HELD = 300_000

#: Bytes of a term, A-Z as a-z; all others part terms.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

COUNT_ROWS = "lang string, source string, term binary, n long, docs long"
PIECE_ROWS = "row long, lang string, source string, term binary, n long"


def _table(names: list[str], columns: list[list], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def _counting(batches: Batches) -> Batches:
    """Occurrences and documents of each term per language and source, combined per task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def combined() -> Batches:
        types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            yield _table(
                ["lang", "source", "term", "n", "docs"],
                [[lang] * len(terms), [source] * len(terms), terms, list(times.values()), [docs[t] for t in terms]],
                types,
            )

    for batch in batches:
        texts = batch.column(2)
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for i, group in enumerate(groups):
            words = texts[i].as_py().translate(TERM_BYTES).split()
            if group not in held:
                held[group] = Counter(), Counter()
            times, docs = held[group]
            before = len(times)
            times.update(words)
            docs.update(set(words))
            size += len(times) - before
            if size > HELD:
                yield from combined()
                held.clear()
                size = 0
    yield from combined()


def _counting_pieces(batches: Batches) -> Batches:
    """Occurrences of each term per piece of a long text, cut between terms."""
    types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64()]
    for batch in batches:
        texts = batch.column(3)
        scalars = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
        for i, (row, lang, source) in enumerate(scalars):
            text, at = texts[i].as_py().translate(TERM_BYTES), 0
            while at < len(text):
                end = text.find(b" ", at + LONG)
                end = len(text) if end < 0 else end
                times = Counter(text[at:end].split())
                at = end
                yield _table(
                    ["row", "lang", "source", "term", "n"],
                    [[row] * len(times), [lang] * len(times), [source] * len(times), list(times), list(times.values())],
                    types,
                )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents that have it.

    Terms are runs of anything but ASCII characters that are no letters; A-Z count as lower case.
    Counts are combined in the task that reads a text, so a frequent term or a large source costs a
    row per task. A text of more than LONG bytes is counted in pieces.
    """
    size = F.octet_length("text")
    group = ["lang", "source"]
    binary = F.col("text").cast("binary").alias("text")
    short = docs.where(size <= LONG).select(*group, binary).mapInArrow(_counting, COUNT_ROWS)
    pieces = docs.select(F.monotonically_increasing_id().alias("row"), *group, "text").where(size > LONG)
    pieces = pieces.select("row", *group, binary).mapInArrow(_counting_pieces, PIECE_ROWS)
    long = pieces.groupBy("row", *group, "term").agg(F.sum("n").alias("n"))
    both = short.union(long.select(*group, "term", "n", F.lit(1).cast("long").alias("docs")))
    sums = both.groupBy(*group, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.withColumn("term", F.col("term").cast("string"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 terms)), exact for any counts; null without terms."""
    upper = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    lower = (total + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", upper, lower) + 1)


def apart(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)) of two shares, which are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sides(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group and other source: the sum over the terms as if the other had none of them."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other_p0"))
    met = cells.join(groups, ["lang", "source"]).join(other, "lang").where("source != item")
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    value = F.sum(F.col("m") * apart(p, F.col("other_p0")))
    return met.groupBy("lang", "source", "item").agg(value.alias("side"))


def _both(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Per pair of sources: what the terms that both have add to the two sides."""
    left = kept.select("lang", "term", "source", F.col("n").alias("n_a"))
    right = kept.select("lang", "term", F.col("source").alias("item"), F.col("n").alias("n_b"))
    cells = left.join(right, ["lang", "term"]).where("source < item").groupBy(
        "lang", "source", "item", "n_a", "n_b"
    ).agg(F.count(F.lit(1)).alias("m"))
    a = groups.select("lang", "source", "terms", F.col("total").alias("total_a"), F.col("p0").alias("a0"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("total_b"), F.col("p0").alias("b0"))
    shares = cells.join(a, ["lang", "source"]).join(b, ["lang", "item"]).withColumns({
        "a": share(F.col("n_a"), F.col("total_a"), F.col("terms")),
        "b": share(F.col("n_b"), F.col("total_b"), F.col("terms")),
    })
    a, b, a0, b0 = (F.col(c) for c in ("a", "b", "a0", "b0"))
    more = apart(a, b) - apart(a, b0) - apart(a0, b) + apart(a0, b0)
    return shares.groupBy("lang", "source", "item").agg(F.sum(F.col("m") * more).alias("both"))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the figure summed over all kept terms, for each other source.

    A pair is summed from cells: all terms of each source against none in the other, and a
    correction for cells of terms that both have. What neither has is counted, not listed.
    """
    cells = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m"))
    held = cells.groupBy("lang", "source").agg(F.sum("m").alias("held"))
    absent = groups.join(held, ["lang", "source"], "left").select(
        "lang", "source", F.lit(0).cast("long").alias("n"),
        (F.col("terms") - F.coalesce("held", F.lit(0))).alias("m"),
    )
    sides = landed(_sides(cells.union(absent.where("m > 0")), groups), "sides")
    both = _both(kept, groups)
    both = landed(both.union(both.select("lang", F.col("item"), F.col("source"), "both")), "both")
    back = sides.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("side").alias("back"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other_p0"))
    pairs = groups.join(other, "lang").where("source != item")
    key = ["lang", "source", "item"]
    neither = F.col("terms") * apart(F.col("p0"), F.col("other_p0"))
    value = F.col("side") + F.col("back") - neither + F.coalesce("both", F.lit(0))
    joined = pairs.join(sides, key, "left").join(back, key, "left").join(both, key, "left")
    return joined.select(*key, F.coalesce(value, F.lit(0)).alias("value"))


def term_values(kept: DataFrame, groups: DataFrame, languages: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group uses most beyond its language.

    Cells of (group count, language count) are ranked by their figure; of cells with equal
    figures the terms are taken together. Cells whose figure is beaten by ``top`` terms are
    never opened, and what is opened is cut to ``top`` terms before and after the shuffle.
    """
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("m"))
    of_lang = languages.select("lang", F.col("total").alias("lang_total"))
    valued = cells.join(groups, group).join(of_lang, "lang").withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("terms")),
        "q": share(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
    })
    valued = valued.where("p > q").select(*group, "n", "lang_n", "m", apart(F.col("p"), F.col("q")).alias("value"))
    valued = landed(valued, "cells")

    best = Window.partitionBy(*group).orderBy(F.desc("value"))
    before = F.sum("m").over(best.rowsBetween(Window.unboundedPreceding, -1))
    values = valued.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    values = values.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    values = values.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    opened = valued.join(values.select(*group, "value"), [*group, "value"])
    terms = kept.join(opened.drop("m"), [*group, "n", "lang_n"])
    order = Window.partitionBy(*group).orderBy(F.desc("value"), "term")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(*group, F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how every (lang, source) group differs.

    Null text, lang and source count as empty. A language keeps the terms that at least ``least``
    of its documents have; with V kept terms and N occurrences of them in a group or a language,
    a term has the share 1 + floor(10^9 (count + 2) / (N + 2 V)) there, also if its count is 0. Two
    shares p and q differ by floor((p - q)^2 / (p + q)).

    Part ``pair``: all other sources of the language by the sum over all kept terms (0 without
    any). Part ``term``: the ``top`` terms of the group whose share is above the language's. Ties
    go to the smaller item in UTF-8 order. A group whose texts have no terms, or no kept ones, has
    pairs and no terms; a language's only source has no pairs; an empty table gives no rows.
    Repeated rows count as often as they occur. Other columns are not read.

    Pairs of sources are the result and are as many rows; a pair is met once per task and cell.
    """
    empty = F.lit("")
    docs = docs.select(*[F.coalesce(F.col(c), empty).alias(c) for c in ("lang", "source", "text")])
    counts = landed(term_counts(docs), "terms")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("lang_docs"),
        (F.min("source").over(of_term) == F.col("source")).cast("long").alias("first"),
    )
    kept = landed(kept.where(F.col("lang_docs") >= least).drop("lang_docs"), "kept")

    languages = kept.groupBy("lang").agg(F.sum("n").alias("total"), F.sum("first").alias("terms"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(
        languages.select("lang", "terms"), "lang", "left"
    )
    zero = F.lit(0).cast("long")
    groups = known.select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms")
    )
    groups = landed(groups.withColumn("p0", share(zero, F.col("total"), F.col("terms"))), "groups")

    columns = ["lang", "source", "part", "item", "value", "rank"]
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(kept, groups).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(ordered)})
    terms = term_values(kept, groups, languages, top).withColumn("part", F.lit("term"))
    return pairs.select(columns).union(terms.select(columns))
