"""Two tokenizers' tokens of the same texts, aligned by their bytes.

The unit of work is a fragment: the tokens of both tokenizers over a range of bytes, as an open
prefix, closed groups and an open suffix. A cut is an offset where tokens of both end; groups lie
between neighbouring cuts, and what lies outside a fragment's first and last cut is open. Two
neighbouring fragments compose to one: the left suffix and the right prefix are put together and cut
anew. Composition is associative, so fragments of one text may be made in different tasks and put
together in a tree.

Texts of up to CHUNK bytes are one fragment, made in the task that reads them. Longer ones are dealt
in chunks to all tasks; each tokenizer's share of a chunk starts at the first place from a border on
where cutting cannot change its tokens, so the shares of the two need not agree, and the open ends
go through the tree.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of
from barloom.llm.common import landed

FOLDER = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Characters of a chunk of a long text, and bytes up to which a text is not cut.
CHUNK = 1 << 16
#: Fragments that one node of the tree puts together.
FAN = 16
#: Characters of texts that are handed to the tokenizers at a time.
BATCH = 1 << 19
#: Rows of the table of pairs up to which it is broadcast (24 bytes each).
PAIRS = 1_000_000
#: A pair of ids is one number: the first id, then so many bits for the second.
BITS = 20

SPACE = "▁"
#: Both tokenizers start anew at a space after anything but white space.
BETWEEN_WORDS = re.compile(rf"(?<=[^\s{SPACE}]) (?!\Z)")
#: The first one also does at a sign of punctuation after a letter.
WITHIN_LINES = re.compile(rf"(?<=[^\s{SPACE}]) (?!\Z)|(?<=[A-Za-z])(?=[,.;:!?])")

Tokens = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # first ids and ends, second ids and ends

ALIGNED = {
    "row": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
    "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
}
ALIGNED_ROWS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)
CHUNKS = {
    "row": pa.int64(), "doc_id": pa.int64(), "k": pa.int64(), "a_at": pa.int64(), "b_at": pa.int64(),
    "a_text": pa.string(), "b_text": pa.string(),
}
CHUNK_ROWS = "row long, doc_id long, k long, a_at long, b_at long, a_text string, b_text string"
PART, FRAGMENT = 0, 1  # kinds of rows of chunks and nodes
_LISTS = ["pa", "pa_ends", "pb", "pb_ends", "sa", "sa_ends", "sb", "sb_ends"]
NODES = {
    "kind": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "k": pa.int64(), "ok": pa.bool_(),
    "cut": pa.bool_(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "groups": pa.string(), **{c: pa.list_(pa.int64()) for c in _LISTS},
}
NODE_ROWS = (
    "kind int, row long, doc_id long, k long, ok boolean, cut boolean, n_a long, n_b long, "
    "n_groups long, n_links long, groups string, " + ", ".join(f"{c} array<long>" for c in _LISTS)
)


class Part(NamedTuple):
    """Closed groups in a row: their number, ids as text, and the pairs of overlapping tokens."""

    n_groups: int
    groups: str
    pairs: np.ndarray


class Fragment(NamedTuple):
    """What is open in a range of bytes. Without a cut all of it is in ``prefix``."""

    cut: bool
    prefix: Tokens
    suffix: Tokens


NONE = np.zeros(0, dtype=np.int64)
NOTHING: Tokens = (NONE, NONE, NONE, NONE)


def joined(left: Tokens, right: Tokens) -> Tokens:
    return tuple(np.concatenate(both) for both in zip(left, right, strict=True))


def _between(tokens: Tokens, after: int, until: int | None) -> Tokens:
    """Tokens that end behind one offset, up to another."""
    out = []
    for ids, ends in (tokens[:2], tokens[2:]):
        low, high = np.searchsorted(ends, after, "right"), len(ends)
        if until is not None:
            high = np.searchsorted(ends, until, "right")
        out += [ids[low:high], ends[low:high]]
    return tuple(out)


class Written:
    """Ids as texts with a mark behind them, from tables over all ids."""

    def __init__(self, ids: int):
        self.tables = {m: np.array([f"{i}{m}" for i in range(ids)], dtype=object) for m in ",|;"}

    def __call__(self, ids: np.ndarray, mark: str) -> np.ndarray:
        return self.tables[mark][ids]


def written(ids: np.ndarray, mark: str) -> np.ndarray:
    """The same without tables, for a few ids."""
    return np.array([f"{i}{mark}" for i in ids.tolist()], dtype=object)


def closed(tokens: Tokens, start: int, texts_of=written) -> Part:
    """Groups of tokens that begin and end with a cut, and the pairs of tokens that overlap.

    Between two neighbouring ends of either kind lies one token of each, and no two such spans
    have the same two tokens: each span is a pair.
    """
    a_ids, a_ends, b_ids, b_ends = tokens
    if not len(a_ids) and not len(b_ids):
        return Part(0, "", NONE)
    if not len(a_ids) or not len(b_ids) or a_ends[-1] != b_ends[-1]:
        raise ValueError(f"tokens from byte {start} on do not end with a cut")
    spans = np.union1d(a_ends, b_ends)
    pairs = a_ids[np.searchsorted(a_ends, spans)] << BITS | b_ids[np.searchsorted(b_ends, spans)]

    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    of_a, of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    texts = np.empty(len(a_ids) + len(b_ids), dtype=object)  # first ids of a group, then second ones
    for ids, ends, own, others, side, mark in (
        (a_ids, a_ends, of_a, of_b, "left", "|"), (b_ids, b_ends, of_b, of_a, "right", ";")
    ):
        places = np.arange(len(ids)) + np.searchsorted(others, own, side)
        texts[places] = np.where(cuts[own] == ends, texts_of(ids, mark), texts_of(ids, ","))
    return Part(len(cuts), "".join(texts.tolist())[:-1], pairs)


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """The open ends of a run of tokens, and the tokens between its first and last cut."""
    cuts = np.intersect1d(tokens[1], tokens[3], assume_unique=True)
    if not len(cuts):
        return Fragment(False, tokens, NOTHING), NOTHING
    first, last = int(cuts[0]), int(cuts[-1])
    middle = _between(tokens, first, last)
    return Fragment(True, _between(tokens, -1, first), _between(tokens, last, None)), middle


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Tokens]:
    """One fragment of two neighbours, and the tokens that their seam closes."""
    seam = joined(left.suffix if left.cut else left.prefix, right.prefix)
    made, middle = fragment(seam)
    if not made.cut:
        if left.cut:  # the right one is open as well
            return Fragment(True, left.prefix, seam), NOTHING
        return made, NOTHING
    suffix = right.suffix if right.cut else made.suffix
    if left.cut:  # the seam starts with a cut: its prefix is a closed group
        return Fragment(True, left.prefix, suffix), joined(made.prefix, middle)
    return Fragment(True, made.prefix, suffix), middle


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level vocabularies with ``use_regex`` cut texts before they join bytes.
BYTE_LEVEL_CUTS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_ranks(first: str) -> dict[bytes, int] | None:
    """Entries of a byte-level vocabulary file as bytes with their ids, if the ids are in the order
    in which entries are joined and nothing else changes a text; None otherwise."""
    file = json.loads(first)
    model, before = file["model"], file["pre_tokenizer"] or {}
    letters = byte_letters()
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before["add_prefix_space"]
    if model["type"] != "BPE" or file["normalizer"] or not plain or model.get("ignore_merges"):
        return None
    special = {t["content"] for t in file["added_tokens"]}
    entries = {e: i for e, i in model["vocab"].items() if e not in special}
    if not all(c in letters for e in entries for c in e):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [entries.get("".join(m)) for m in merges]
    if None in made or made != sorted(made) or len(merges) + len(letters) != len(entries):
        return None
    return {bytes(letters[c] for c in e): i for e, i in entries.items()}


class Tokenizers:
    """Both tokenizers, and the bytes of every id.

    A byte-level file whose ids are ranks is run by the library for ranks, which takes a quarter
    of the time and gives the same tokens (a test compares them on every code point).
    """

    def __init__(self, first: str, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(entries.values()))
        for entry, i in entries.items():
            known = all(c in letters for c in entry)
            self.a_bytes[i] = bytes(letters[c] for c in entry) if known else entry.encode()
        ranks = byte_ranks(first)
        self.a_ranks = ranks and tiktoken.Encoding(
            "first", pat_str=BYTE_LEVEL_CUTS, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = SentencePieceProcessor(model_proto=second)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} joins words, so texts cannot be cut between words")
            self.b_bytes.append(
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            )
        self.a_sizes, self.b_sizes = (
            np.array([len(t) for t in names], dtype=np.int64) for names in (self.a_bytes, self.b_bytes)
        )

    def first(self, texts: list[str]) -> list[list[int]]:
        if self.a_ranks:
            return [self.a_ranks.encode_ordinary(text) for text in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def second(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which the tokenizer puts there itself."""
        return self.b.encode([t[1:] for t in texts], num_threads=1)

    def tokens(
        self, a: list[int], a_text: str, a_at: int, b: list[int], b_text: str, b_at: int
    ) -> Tokens | None:
        """Ids and ends of two texts that begin at some bytes; None if their tokens have others."""
        out = []
        for ids, names, sizes, text, at in (
            (a, self.a_bytes, self.a_sizes, a_text, a_at), (b, self.b_bytes, self.b_sizes, b_text, b_at)
        ):
            if b"".join([names[i] for i in ids]) != text.encode():
                return None
            found = np.array(ids, dtype=np.int64)
            out += [found, at + np.cumsum(sizes[found])]
        return tuple(out)


def _counted(pairs: np.ndarray) -> tuple[list[int], list[int]]:
    found, times = np.unique(pairs, return_counts=True)
    return found.tolist(), times.tolist()


def _no_tokens(row: int, doc_id: int | None) -> tuple:
    return (row, doc_id, 0, 0, 0, 0, "", [], [])


def _decoded(text: bytes | None) -> str | None:
    """A text, None if it is null, empty or no UTF-8, which no tokenizer gives back."""
    try:
        return (text or b"").decode() or None
    except UnicodeDecodeError:
        return None


def _aligning(files):
    """Whole texts: row, doc_id, text."""

    def aligned(batches: Batches) -> Batches:
        tokenizers = Tokenizers(*files.value)
        texts_of = Written(max(len(tokenizers.a_bytes), len(tokenizers.b_bytes)))

        def done(waiting: list[tuple]) -> pa.RecordBatch:
            texts = [" " + text for _, _, text in waiting if text]
            looked_up = zip(texts, tokenizers.first(texts), tokenizers.second(texts), strict=True)
            out = []
            for row, doc_id, text in waiting:
                tokens = None
                if text:
                    whole, a, b = next(looked_up)
                    tokens = tokenizers.tokens(a, whole, 0, b, whole, 0)
                if tokens is None:
                    out.append(_no_tokens(row, doc_id))
                    continue
                part = closed(tokens, 0, texts_of)
                digest = hashlib.sha256(part.groups.encode()).hexdigest()
                counts = (len(tokens[0]), len(tokens[2]), part.n_groups, len(part.pairs))
                out.append((row, doc_id, *counts, digest, *_counted(part.pairs)))
            return batch_of(ALIGNED, out)

        for batch in batches:
            waiting, held = [], 0
            texts = batch.column(2)
            ids = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for i, (row, doc_id) in enumerate(ids):
                text = _decoded(texts[i].as_py())
                waiting.append((row, doc_id, text))
                held += len(text or "")
                if held > BATCH:
                    yield done(waiting)
                    waiting, held = [], 0
            yield done(waiting)

    return aligned


def _starts(text: str, cuts: re.Pattern) -> list[int]:
    """For each border the first place from it on where a text may be cut, or its end."""
    out = [0]
    for border in range(CHUNK, len(text), CHUNK):
        if out[-1] < border:
            found = cuts.search(text, border)
            out.append(found.start() if found else len(text))
        else:
            out.append(out[-1])
    return [*out, len(text)]


def _offsets(text: str, places: list[int]) -> list[int]:
    """Bytes before each of some places, which are in order."""
    out, at, last = [], 0, 0
    for place in places:
        at += len(text[last:place].encode())
        last = place
        out.append(at)
    return out


def _cutting(batches: Batches) -> Batches:
    """Chunks of long texts with the shares of both tokenizers; none of texts that are no UTF-8."""
    for batch in batches:
        texts = batch.column(2)
        ids = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for i, (row, doc_id) in enumerate(ids):
            text = _decoded(texts[i].as_py())
            if text is None:
                yield batch_of(CHUNKS, [(row, doc_id, 0, 0, 0, None, None)])
                continue
            text = " " + text
            a, b = _starts(text, WITHIN_LINES), _starts(text, BETWEEN_WORDS)
            a_at, b_at = _offsets(text, a), _offsets(text, b)
            for k in range(len(a) - 1):
                shares = text[a[k] : a[k + 1]], text[b[k] : b[k + 1]]
                yield batch_of(CHUNKS, [(row, doc_id, k, a_at[k], b_at[k], *shares)])


def _part_row(row: int, doc_id: int | None, start: int, tokens: Tokens, counts: tuple = (0, 0)) -> tuple:
    """Closed groups that begin at byte ``start``; ``pa`` holds their pairs."""
    part = closed(tokens, start)
    return (
        PART, row, doc_id, start, True, None, *counts, part.n_groups, len(part.pairs), part.groups,
        part.pairs.tolist(), *[[]] * 7,
    )


def _start(tokens: Tokens) -> int:
    """A number by which runs of closed groups of one text are in order: the first token's end."""
    return int(tokens[1][0])


def _fragment_row(row: int, doc_id: int | None, k: int, made: Fragment) -> tuple:
    lists = [part.tolist() for part in (*made.prefix, *made.suffix)]
    return (FRAGMENT, row, doc_id, k, True, made.cut, 0, 0, 0, 0, None, *lists)


def _fragmenting(files):
    """Chunks to fragments and their closed groups."""

    def made(batches: Batches) -> Batches:
        tokenizers = Tokenizers(*files.value)
        for batch in batches:
            for row, doc_id, k, a_at, b_at, a_text, b_text in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                bad = (PART, row, doc_id, -1, False, None, 0, 0, 0, 0, None, *[[]] * 8)
                if a_text is None:
                    yield batch_of(NODES, [bad])
                    continue
                a = tokenizers.first([a_text])[0] if a_text else []
                b = tokenizers.second([b_text])[0] if b_text else []
                tokens = tokenizers.tokens(a, a_text, a_at, b, b_text, b_at)
                if tokens is None:
                    yield batch_of(NODES, [bad])
                    continue
                open_, middle = fragment(tokens)
                rows = [_fragment_row(row, doc_id, k, open_)]
                counts = (PART, row, doc_id, -1, True, None, len(a), len(b), 0, 0, None, *[[]] * 8)
                rows.append(counts)
                if len(middle[0]):
                    rows.append(_part_row(row, doc_id, _start(middle), middle))
                yield batch_of(NODES, rows)

    return made


def _composing(batches: Batches) -> Batches:
    """Fragments in order to fragments of their nodes; the closed groups of seams on the way."""
    now, made = None, None

    def node() -> pa.RecordBatch:
        return batch_of(NODES, [_fragment_row(*now, made)])

    for batch in batches:
        for row, doc_id, parent, _, cut, *lists in zip(
            *[c.to_pylist() for c in batch.columns], strict=True
        ):
            arrays = [np.array(part, dtype=np.int64) for part in lists]
            right = Fragment(cut, tuple(arrays[:4]), tuple(arrays[4:]))
            if now != (row, doc_id, parent):
                if now is not None:
                    yield node()
                now, made = (row, doc_id, parent), right
                continue
            made, seam = compose(made, right)
            if len(seam[0]):
                yield batch_of(NODES, [_part_row(row, doc_id, _start(seam), seam)])
    if now is not None:
        yield node()


def _finishing(batches: Batches) -> Batches:
    """A text is one fragment now; it begins with a cut, so its prefix is a group."""
    for batch in batches:
        out = []
        for row, doc_id, cut, *lists in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not cut or lists[4] or lists[6]:
                out.append((PART, row, doc_id, -1, False, None, 0, 0, 0, 0, None, *[[]] * 8))
            else:
                prefix = tuple(np.array(part, dtype=np.int64) for part in lists[:4])
                out.append(_part_row(row, doc_id, 0, prefix))
        yield batch_of(NODES, out)


def _assembling(batches: Batches) -> Batches:
    """Parts of each long text in order to its row; the digest runs over one part after another."""
    now, digest, sums, pairs, ok = None, None, None, {}, True

    def finished() -> pa.RecordBatch:
        if not ok or not sums[0]:
            return batch_of(ALIGNED, [_no_tokens(*now)])
        found = sorted(pairs)
        return batch_of(ALIGNED, [(*now, *sums, digest.hexdigest(), found, [pairs[p] for p in found])])

    for batch in batches:
        for row, doc_id, good, *counts, groups, part in zip(
            *[c.to_pylist() for c in batch.columns], strict=True
        ):
            if now != (row, doc_id):
                if now is not None:
                    yield finished()
                now, digest, sums, pairs, ok = (row, doc_id), hashlib.sha256(), [0] * 4, {}, True
            ok = ok and good
            if groups:
                digest.update((";" if sums[2] else "").encode() + groups.encode())
            sums = [s + c for s, c in zip(sums, counts, strict=True)]
            for pair, times in zip(*_counted(part), strict=True):
                pairs[pair] = pairs.get(pair, 0) + times
    if now is not None:
        yield finished()


def _long_texts(chunks: DataFrame, files) -> DataFrame:
    """Rows of ALIGNED for texts in chunks: fragments, the tree over them, the parts in order."""
    dealt = chunks.repartition("row", "k")
    level = landed(dealt.mapInArrow(_fragmenting(files), NODE_ROWS), "fragments")
    parts = level.where(F.col("kind") == PART)
    last = level.agg(F.max(F.when(F.col("kind") == FRAGMENT, F.col("k")))).first()[0] or 0
    while last:
        last //= FAN
        nodes = level.where(F.col("kind") == FRAGMENT).select(
            "row", "doc_id", F.floor(F.col("k") / FAN).cast("long").alias("parent"), "k", "cut", *_LISTS
        )
        ordered = nodes.repartition("row", "parent").sortWithinPartitions("row", "parent", "k")
        level = landed(ordered.mapInArrow(_composing, NODE_ROWS), "fragments")
        parts = parts.union(level.where(F.col("kind") == PART))
    whole = level.where(F.col("kind") == FRAGMENT).select("row", "doc_id", "cut", *_LISTS)
    parts = parts.union(whole.mapInArrow(_finishing, NODE_ROWS))
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    ordered = parts.repartition("row").sortWithinPartitions("row", "k").select(
        "row", "doc_id", "ok", *counts, "groups", "pa"
    )
    return ordered.mapInArrow(_assembling, ALIGNED_ROWS)


def align(docs: DataFrame, folder: str = FOLDER, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Tokens, groups and pairs of every text: the columns of ALIGNED_ROWS.

    ``row`` tells rows apart, ``pairs`` are the different pairs of ids whose tokens overlap, as one
    number each, ``times`` how often they do. Special tokens in texts are plain text. Texts that
    are null or empty, are no UTF-8, or whose tokens of either tokenizer have other bytes than a
    space and the text, have zeros, '' and empty lists. Repeated rows and ids stay rows of their
    own; other columns are not read.

    ``first`` is a byte-level vocabulary, ``second`` a model whose pieces begin at spaces; the
    files are read once and travel with the tasks, a few megabytes of fixed size. A task holds the
    text that it reads, or a chunk; what it holds of a long text beyond that are open ends.
    """
    spark = docs.sparkSession
    with open(os.path.join(folder, first), encoding="utf-8") as a, open(os.path.join(folder, second), "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"), size.alias("size"),
    )
    short = rows.where(F.col("size") <= CHUNK).drop("size").mapInArrow(_aligning(files), ALIGNED_ROWS)
    chunks = rows.where(F.col("size") > CHUNK).drop("size").mapInArrow(_cutting, CHUNK_ROWS)
    return landed(short.union(_long_texts(chunks, files)), "aligned")


def linked(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many texts each pair is linked, and whether no pair of its first
    id is in more. Counts are combined before the shuffle; a first id has at most as many rows as
    the second vocabulary has ids."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("docs")
    )
    of_first = Window.partitionBy(F.shiftright("pair", BITS))
    return counts.withColumn("best", (F.col("docs") == F.max("docs").over(of_first)).cast("long"))


def totals(aligned: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text.

    ``n_best`` counts the links whose pair is in as many texts as any pair of its first id,
    ``count_sum`` adds up the number of texts of each link's pair. The table of pairs is broadcast
    up to PAIRS rows; beyond, it is joined as Spark sees fit.
    """
    pairs = landed(linked(aligned), "pairs")
    known = F.broadcast(pairs) if pairs.count() <= PAIRS else pairs
    each = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("one")).select(
        "row", F.col("one.pairs").alias("pair"), F.col("one.times").alias("times")
    )
    sums = each.join(known, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
