"""Language identification with string kernels.

The kernel of two texts counts the distinct n-grams, of one to four symbols, that both hold,
divided by the geometric mean of how many each holds (blended spectrum, presence, normalised).
Landmark texts give a Nystroem approximation, on which one ridge regression per language tells it
from the rest. Scoring folds landmarks and weights into one weight per n-gram and language and
multiplies batches of presence rows with that matrix.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import landed

#: Longest n-gram.
LONGEST = 4
#: The fit uses a bounded sample: so many rows in all, shared equally among the languages, of
#: texts up to so many characters. Landmarks are some of them, of each so many characters. So a
#: model has at most LONGEST * LANDMARKS * LANDMARK_CHARS n-grams, of 8 bytes and 4 per language.
#: Every text is scored, and whole, with all letters of the sample.
TRAIN_ROWS = 2000
TRAIN_CHARS = 20000
LANDMARKS, LANDMARK_CHARS = 256, 4096
RIDGE = 1e-3
#: Texts and cells of a presence matrix, and characters per step of marking it.
ROWS, CELLS, CHARS = 64, 1 << 24, 1 << 18
#: A text whose best score is lower is claimed by no language: all regressions say "rest" clearly.
CLAIMED = 0.25

UNKNOWN = "und"
BREAK, GAP = 0, 1  # symbols: matches nothing; a run of anything but letters


@dataclass(frozen=True)
class Grams:
    """The n-grams of the landmarks: per length the sorted keys of (n-gram one shorter, symbol)."""

    symbol: np.ndarray  # of each code point
    span: int  # symbols there are; a key is the number of the shorter n-gram * span + symbol
    keys: tuple[np.ndarray, ...]  # n-grams of a length are numbered from 1 in the order of keys
    offset: tuple[int, ...]  # of the n-grams of each length among all
    size: int


@dataclass(frozen=True)
class Model:
    grams: Grams
    weights: np.ndarray  # n-gram x language
    languages: tuple[str, ...]


def symbol_table(texts: list[str]) -> np.ndarray:
    """Symbol of every code point; the alphabet is that of the texts."""
    letters = sorted({c for text in texts for c in text.lower() if c.isalpha()})
    table = np.array([BREAK if chr(i).isalpha() else GAP for i in range(0x110000)], dtype=np.uint32)
    for number, letter in enumerate(letters):
        table[ord(letter)] = GAP + 1 + number
    return table


def symbols(table: np.ndarray, piece: str, before: np.ndarray) -> np.ndarray:
    """Symbols of a piece of text after those ``before`` it; runs of gaps are one gap."""
    codes = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = np.concatenate([before, table[codes]])
    again = np.zeros(len(found), dtype=bool)
    again[1:] = (found[1:] == GAP) & (found[:-1] == GAP)
    return found[~again]


def pieces(table: np.ndarray, text: str) -> Iterator[np.ndarray]:
    """Symbols of a whole text in pieces that overlap by one less than the longest n-gram."""
    before = np.zeros(0, dtype=np.uint32)
    for at in range(0, len(text), CHARS):
        found = symbols(table, text[at : at + CHARS], before)
        yield found
        before = found[max(0, len(found) - LONGEST + 1) :]


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """Parts in one array, each with a break after it."""
    return np.concatenate([x for part in parts for x in (part, np.zeros(1, np.uint32))])


def learn_grams(table: np.ndarray, texts: list[str]) -> Grams:
    """The n-grams that the texts hold."""
    flat = _joined([p for t in texts for p in pieces(table, t)]).astype(np.int64)
    span, keys, offset, total = int(table.max()) + 1, [], [], 0
    at, ids = np.arange(len(flat)), np.zeros(len(flat), np.int64)
    for n in range(LONGEST):
        at, ids = at[at + n < len(flat)], ids[at + n < len(flat)]
        whole = flat[at + n] != BREAK
        at, ids = at[whole], ids[whole]
        known, places = np.unique(ids * span + flat[at + n], return_inverse=True)
        ids = places + 1
        keys.append(known)
        offset.append(total)
        total += len(known)
    return Grams(table, span, tuple(keys), tuple(offset), total)


def mark(grams: Grams, flat: np.ndarray, row: np.ndarray, present: np.ndarray) -> None:
    """Set the cells (row, n-gram) of the n-grams in ``flat``.

    An n-gram is known only if the one without its last symbol is, so places fall away early.
    """
    after = flat.astype(np.int64)
    at, ids = np.arange(len(flat)), np.zeros(len(flat), np.int64)
    for n, (keys, offset) in enumerate(zip(grams.keys, grams.offset, strict=True)):
        if not len(keys):
            return
        if n:
            inside = at + n < len(flat)
            at, ids = at[inside], ids[inside]
        wanted = ids * grams.span + after[at + n]
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        held = keys[found] == wanted
        at, ids = at[held], found[held] + 1
        present[row[at], offset + ids - 1] = 1


def presence(grams: Grams, texts: list[str]) -> np.ndarray:
    """Texts x n-grams, each row scaled to length 1 (or all zero)."""
    present = np.zeros((len(texts), max(grams.size, 1)), dtype=np.float32)
    parts, rows, held = [], [], 0

    def flush() -> None:
        if parts:
            sizes = [len(p) + 1 for p in parts]
            mark(grams, _joined(parts), np.repeat(np.array(rows), sizes), present)

    for row, text in enumerate(texts):
        for part in pieces(grams.symbol, text):
            parts.append(part)
            rows.append(row)
            held += len(part)
            if held >= CHARS:
                flush()
                parts, rows, held = [], [], 0
    flush()
    norm = np.sqrt(present.sum(axis=1, dtype=np.float64))
    present /= np.where(norm > 0, norm, 1.0).astype(np.float32)[:, None]
    return present


def in_blocks(grams: Grams, texts: list[str]) -> Iterator[list[str]]:
    """Texts whose presence matrix stays within CELLS, ROWS at most."""
    rows = max(1, min(ROWS, CELLS // max(grams.size, 1)))
    for at in range(0, len(texts), rows):
        yield texts[at : at + rows]


def fit(texts: list[str], languages: list[str]) -> Model | None:
    """Landmarks, Nystroem features and one-versus-rest ridge regressions of a labelled sample."""
    names = tuple(sorted(set(languages)))
    if not names:
        return None
    table = symbol_table(texts)
    each = max(1, LANDMARKS // len(names))
    chosen, used = [], Counter()
    for text, language in zip(texts, languages, strict=True):
        if used[language] < each:
            used[language] += 1
            chosen.append(text[:LANDMARK_CHARS])
    grams = learn_grams(table, chosen)
    marks = np.concatenate([presence(grams, block) for block in in_blocks(grams, chosen)])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    sound = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, sound] / np.sqrt(values[sound])  # landmarks x features
    features = np.concatenate(
        [(presence(grams, block) @ marks.T).astype(np.float64) @ root for block in in_blocks(grams, texts)]
    )
    wanted = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    normal = features.T @ features + RIDGE * len(texts) * np.eye(features.shape[1])
    solved = np.linalg.solve(normal, features.T @ wanted)
    return Model(grams, (marks.T @ (root @ solved).astype(np.float32)), names)


def predict(model: Model | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score, from 0 to 1, of texts that hold a letter."""
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    found, scores = [], []
    for block in in_blocks(model.grams, texts):
        marks = presence(model.grams, block)
        values = (marks @ model.weights).astype(np.float64)
        best = values.argmax(axis=1)
        found += [model.languages[i] for i in best]
        score = np.clip((values[np.arange(len(block)), best] + 1) / 2, 0, 1)
        scores.append(np.where(marks.any(axis=1), score, 0.0))
    return found, np.concatenate(scores) if scores else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """A bounded sample of labelled texts, the same number of each language, in hash order.

    Counts come from all labelled rows. A language is learned from its texts of up to TRAIN_CHARS
    characters; one without such texts from so much of its longer ones.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    size = F.char_length("text")
    labelled = labelled.where(size > 0)
    short = size <= TRAIN_CHARS
    counts = labelled.groupBy("lang").agg(F.count_if(short).alias("__short"), F.count(F.lit(1)).alias("__n"))
    counts = landed(counts, "langs")
    each = max(1, TRAIN_ROWS // max(counts.count(), 1))
    place = F.xxhash64("doc_id")
    share = F.pmod(place, F.lit(1 << 32)) / float(1 << 32)
    near = labelled.select(
        F.col("lang"), F.substring("text", 1, TRAIN_CHARS).alias("text"), short.alias("__is_short"),
        place.alias("__place"), share.alias("__share"),
    ).join(counts, "lang")
    eligible = F.when(F.col("__short") > 0, F.col("__short")).otherwise(F.col("__n"))
    wanted = F.col("__is_short") == (F.col("__short") > 0)
    near = near.where(wanted & (F.col("__share") * eligible < 4.0 * each))
    first = Window.partitionBy("lang").orderBy("__place", "text")
    rows = near.withColumn("__nth", F.row_number().over(first)).where(F.col("__nth") <= each)
    got = rows.select("lang", "__nth", "text").collect()
    got.sort(key=lambda r: (r["__nth"], r["lang"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def identify(docs: DataFrame) -> DataFrame:
    """Documents with ``__lang`` and ``__score``.

    A null text, or one without a letter, is ``und`` with score 0, as is every text when there is
    nothing to learn from. A text that shares no n-gram with a landmark gets the first language by
    name with score 0. Predictions use the text alone. Repeated rows get equal predictions; an
    empty table stays empty; other columns pass through.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(*sample(docs.select("doc_id", "lang", "text"))))

    @F.pandas_udf("struct<lang:string,score:double>")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.fillna("").tolist()
            lang, score = predict(model.value, texts)
            yield pd.DataFrame({"lang": lang, "score": score})

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    got = docs.withColumn("__lettered", lettered)
    got = got.withColumn("__told", told(F.when(F.col("__lettered"), F.col("text"))))
    return got.select(
        *docs.columns,
        F.when(F.col("__lettered"), F.col("__told.lang")).otherwise(UNKNOWN).alias("__lang"),
        F.when(F.col("__lettered"), F.col("__told.score")).otherwise(0.0).alias("__score"),
    )


def kept(docs: DataFrame) -> DataFrame:
    """Documents in one of the learned languages.

    Rejected are texts without a letter and those that every regression gives to the rest.
    """
    known = (F.col("__lang") != UNKNOWN) & (F.col("__score") >= CLAIMED)
    return identify(docs).where(known).select(*docs.columns)
