"""Mixing sources to target weights with weighted sampling without replacement.

Every source gets a target in words. Complete epochs of a source come first; what is left of the
target is filled by a weighted sample: each document draws an exponential key that its quality
weight scales, the documents of a source are sorted by key, and their sizes are summed up to the
remaining budget. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_order, landed, word_count

#: Parts of the mix that sources get in turn, by code point order of their names, null last.
TURN = (5, 2, 1)
#: No source is repeated more often than this.
MOST_EPOCHS = 3
#: How much likelier a document of quality 1, of quality 0, without a label is drawn.
QUALITY_WEIGHT = {1: 2.0, 0: 0.5, None: 1.0}
#: Characters that prose has few of.
SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~0123456789"


@dataclass(frozen=True)
class Mix:
    """What the mix takes: a row per document, and a row per source."""

    documents: DataFrame  # doc_id, source, size, key, copies, taken, target, source_size
    sources: DataFrame  # source, source_size, weight, target, epochs, last


def exponential_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, u in (0, 1) from a digest of seed and id: the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return -F.log((bits + F.lit(1)) / F.lit(float(2**48 + 2))) / weight


def quality_weight(quality: Column) -> Column:
    return (
        F.when(quality >= 1, QUALITY_WEIGHT[1])
        .when(quality <= 0, QUALITY_WEIGHT[0])
        .otherwise(QUALITY_WEIGHT[None])
    )


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with the best ``__quality`` that labels give their doc_id, or null."""
    best = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality"))
    return docs.join(best, F.col("doc_id") == F.col("__id"), "left").drop("__id")


def text_weight(text: Column) -> Column:
    """A quality weight from the text itself: 1 for prose, down to 0.1 where symbols abound."""
    size = F.char_length(text)
    odd = size - F.char_length(F.translate(text, SYMBOLS, ""))
    return F.when(size > 0, F.greatest(F.lit(0.1), 1 - 2 * odd / size)).otherwise(1.0)


def with_key(docs: DataFrame, weight: Column, size: Column | None, seed: str) -> DataFrame:
    """Documents with ``__size``, by default in words, and their ``__key``."""
    return docs.withColumns(
        {
            "__size": word_count(F.col("text")) if size is None else size,
            "__key": exponential_key(F.col("doc_id"), weight, seed),
        }
    )


def level(sources: DataFrame, turn: str = "weight") -> float:
    """The water level: target = least(MOST_EPOCHS * source_size, weight * level).

    Sources above their limit are set to it and the rest is shared anew until none is above. The
    set of limited sources only grows, and each round costs one aggregate over the source table.
    """
    limit = F.col("source_size") * MOST_EPOCHS
    total, weights = sources.agg(F.sum("source_size"), F.sum(turn)).first()
    if not total:
        return 0.0
    now = float(total) / float(weights)
    while True:
        over = limit <= F.col(turn) * F.lit(now)
        capped, free = sources.agg(
            F.sum(F.when(over, limit).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col(turn)))
        ).first()
        then = float(total - capped) / float(free) if free else now
        if then == now:
            return now
        now = then


def targets(sizes: DataFrame, turn: Sequence[int] = TURN) -> DataFrame:
    """Sources with ``weight``, ``target``, complete ``epochs`` and the words before a source.

    ``sizes`` has a row (source, source_size) per source.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = in_order(landed(sizes, "sizes"), order, {"__start": "source_size"})
    nth = (F.col("__place") % len(turn) + 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, turn)), nth)
    weighed = landed(placed.withColumn("weight", weight), "weighed")
    top = (F.col("source_size") * MOST_EPOCHS).cast("double")
    target = F.least(top, F.col("weight") * F.lit(level(weighed)))
    epochs = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return weighed.select(
        "source", "source_size", "weight", "__start", target.alias("target"),
        epochs.cast("long").alias("epochs"),
    )


def mix(
    docs: DataFrame, weight: Column, size: Column | None = None, seed: str = "mix"
) -> Mix:
    """Choose the documents of the mix.

    ``docs`` needs doc_id, source, and text unless ``size`` gives the words; ``weight``, a
    positive quality weight, is computed from their columns. A null text has size 0, a null source is a source of its
    own, sorted last. Documents without words are never short of budget: they are taken as often
    as the epochs say. A source takes the documents whose middle lies within what its epochs leave
    of the target, so it misses the target by at most half a document. Rows that repeat a doc_id
    are documents of their own with equal keys. An empty table gives an empty mix.
    """
    narrow = with_key(docs, weight, size, seed).select("doc_id", "source", "__size", "__key")
    facts = landed(narrow, "facts")
    sizes = facts.groupBy("source").agg(F.sum("__size").alias("source_size"))
    sources = landed(targets(sizes), "sources")

    order = [F.col("source").isNull(), *map(F.col, ("source", "__key", "doc_id", "__size"))]
    rows = in_order(facts, order, {"__before": "__size"})
    rows = rows.withColumnRenamed("source", "__source")
    joined = rows.join(sources, F.col("__source").eqNullSafe(F.col("source")))
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = 2 * (F.col("__before") - F.col("__start")) + F.col("__size")
    drawn = (F.col("__size") > 0) & (middle <= 2 * left)
    chosen = joined.select(
        "doc_id", "source", F.col("__size").alias("size"), "source_size", "target",
        (F.col("epochs") + drawn.cast("long")).alias("copies"),
        F.when(drawn, F.struct("__key", "doc_id", "__size")).alias("__last"),
    )
    chosen = landed(chosen, "chosen")
    last = chosen.groupBy(F.col("source").alias("__of")).agg(F.max("__last").alias("last"))
    found = sources.join(last, F.col("source").eqNullSafe(F.col("__of")), "left")
    return Mix(
        chosen.select(
            "doc_id", "size", "source_size", "target",
            (F.col("copies") * F.col("size")).alias("taken"), "copies", "source",
        ),
        found.select("source", "source_size", "weight", "target", "epochs", "last"),
    )


def mixed(docs: DataFrame, weight: Column, seed: str = "mix") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    The sample comes down to one small row per source, the last key that is drawn. With it every
    document tells from its own row how often it is taken, so texts are not shuffled.
    """
    sources = mix(docs, weight, seed=seed).sources.select(
        F.col("source").alias("__of"), F.col("epochs").alias("__epochs"), F.col("last").alias("__last")
    )
    limits = landed(sources, "limits")
    rows = with_key(docs, weight, None, seed).join(limits, F.col("source").eqNullSafe(F.col("__of")))
    own = F.struct("__key", "doc_id", "__size")
    drawn = (F.col("__size") > 0) & F.col("__last").isNotNull() & (own <= F.col("__last"))
    taken = rows.withColumn("__copies", F.col("__epochs") + drawn.cast("long"))
    each = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return taken.where(F.col("__copies") > 0).withColumn("__copy", each).select(*docs.columns)
