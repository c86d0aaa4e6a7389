"""Alignment against whole texts through both tokenizers and plain loops."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from barloom.llm import alignment
from barloom.llm.alignment import Fragment, Tokenizers, align, closed, compose, fragment, totals

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.FOLDER), reason="no vocabulary files here")
SCHEMA = "doc_id long, text string, row string, pairs int, k int"


@pytest.fixture(scope="module")
def tokenizers():
    with open(f"{alignment.FOLDER}/{alignment.FIRST}", encoding="utf-8") as a:
        with open(f"{alignment.FOLDER}/{alignment.SECOND}", "rb") as b:
            return Tokenizers(a.read(), b.read())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def spans(ids, names):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(names[i])))
        at += len(names[i])
    return out


def plain(text, tokenizers):
    """Groups and links of a whole text; None without tokens."""
    if not text:
        return None
    a = tokenizers.a.encode(" " + text, add_special_tokens=False).ids
    b = tokenizers.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(tokenizers.a_bytes[i] for i in a) != raw or b"".join(tokenizers.b_bytes[i] for i in b) != raw:
        return None
    a, b = spans(a, tokenizers.a_bytes), spans(b, tokenizers.b_bytes)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, start = [], 0
    for cut in cuts:
        mine = [",".join(str(i) for i, s, _ in t if start <= s < cut) for t in (a, b)]
        groups.append("|".join(mine))
        start = cut
    links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    return len(a), len(b), groups, links


def brute(rows, tokenizers):
    known = [(i, plain(t, tokenizers)) for i, t in rows]
    docs = Counter(p for _, found in known if found for p in set(found[3]))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, found in known:
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((
            i, n_a, n_b, len(groups), len(links), sum(docs[p] == best[p[0]] for p in links),
            sum(docs[p] for p in links), digest,
        ))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


EDGES = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "tab\tand\nlines\r\n\r\n  x", "▁", "a ▁b", "x▁y z",
    "</s> <s> <|endoftext|> <unk>", "<0x41> [INST]", "naïve façade Straße", "漢字かな交じり文。 テスト", "🙂🙂 é    x y",
    "don't they've I'll 's 123 4567 3.14,15", "\x00 null \x00byte", "ＡＢＣ ﬁne ½ ²", "a  b", "q" * 300, "привет, мир!",
    "x,y;z: (a) [b] {c}. \"d\"", "end. ", "\n", "word " * 30, "​zero​ width", "tabs\t \t mixed \t\t x",
]


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "and", "tokenization", "Ünïcode", "supercalifragilistic", "x1", "2024", "can't", "日本", "foo_bar", "https://a.b/c?d=e"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", ", ", ". ", " \n ", "'", "-", " '"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize(("chunk", "fan"), [(1 << 16, 16), (7, 2), (40, 3)])
def test_like_whole_texts(spark, tokenizers, monkeypatch, chunk, fan):
    """With short chunks every text is cut, also inside groups, and goes through the tree."""
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "BATCH", 500)
    rows = list(enumerate(EDGES + texts(chunk, 25)))
    rows += [(None, "no id here"), (3, "again"), (3, "again"), (None, None)]
    assert found(totals(align(frame(spark, rows).repartition(3)))) == brute(rows, tokenizers)


@pytest.mark.parametrize("start", range(0, 0x110000, 0x22000))
def test_both_libraries_give_the_same_tokens(tokenizers, start):
    """Every code point next to letters, digits, signs, spaces and itself: all classes of the cuts."""
    assert tokenizers.a_ranks
    points = [chr(c) for c in range(start, start + 0x22000) if not 0xD800 <= c < 0xE000]
    cases = [f" a{c}b 1{c}2 .{c}, {c} {c}{c}x\n{c}\n y'{c}s" for c in points]
    want = [e.ids for e in tokenizers.a.encode_batch_fast(cases, add_special_tokens=False)]
    assert tokenizers.first(cases) == want


def test_libraries_agree_on_texts(tokenizers):
    cases = [" " + t for t in EDGES if t] + [" " + t for t in texts(77, 200)] + [" " + "q" * 5000, " " * 3000]
    assert tokenizers.first(cases) == [e.ids for e in tokenizers.a.encode_batch_fast(cases, add_special_tokens=False)]


def test_other_files_are_left_to_their_own_library():
    import json

    with open(f"{alignment.FOLDER}/{alignment.FIRST}", encoding="utf-8") as f:
        file = json.load(f)
    assert alignment.byte_ranks(json.dumps(file)) is not None
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}):
        assert alignment.byte_ranks(json.dumps(file | change)) is None
    merges = file["model"]["merges"]
    file["model"]["merges"] = [merges[1], merges[0], *merges[2:]]
    assert alignment.byte_ranks(json.dumps(file)) is None


def test_pairs_are_joined_alike_beyond_the_bound(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS", 0)
    rows = list(enumerate(texts(5, 30)))
    assert found(totals(align(frame(spark, rows)))) == brute(rows, tokenizers)


def test_few_and_none(spark, tokenizers):
    assert found(totals(align(frame(spark, [])))) == []
    for only in (None, "", "one"):
        assert found(totals(align(frame(spark, [(1, only)])))) == brute([(1, only)], tokenizers)


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'C3' AS STRING) AS text")
    assert found(totals(align(df))) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_composition_is_associative():
    """Any tree over any cutting of two token streams gives the same groups."""
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(2, 40)
        ends = [sorted({*(rng.randrange(1, n) for _ in range(rng.randrange(0, n))), n}) for _ in range(2)]
        ids = [list(range(100 * t, 100 * t + len(e))) for t, e in enumerate(ends)]
        whole = tuple(np.array(x) for x in (ids[0], ends[0], ids[1], ends[1]))
        marks = [sorted(rng.choices(range(n + 1), k=3)) for _ in range(2)]  # streams are cut apart from each other

        def share(i, marks=marks, ids=ids, ends=ends, n=n):
            out = []
            for t in range(2):
                low, high = ([0, *marks[t], n])[i : i + 2]
                kept = [k for k, e in enumerate(ends[t]) if low < e <= high]
                out += [[ids[t][k] for k in kept], [ends[t][k] for k in kept]]
            return tuple(np.array(x, dtype=np.int64) for x in out)

        parts = [fragment(share(i)) for i in range(4)]

        def left(parts=parts):
            made, runs = parts[0][0], [m for _, m in parts]
            for part, _ in parts[1:]:
                made, seam = compose(made, part)
                runs.append(seam)
            return made, runs

        def right(parts=parts):
            made, runs = parts[-1][0], [m for _, m in parts]
            for part, _ in parts[-2::-1]:
                made, seam = compose(part, made)
                runs.append(seam)
            return made, runs

        def paired(parts=parts):
            runs = [m for _, m in parts]
            (one, a), (two, b) = compose(parts[0][0], parts[1][0]), compose(parts[2][0], parts[3][0])
            made, c = compose(one, two)
            return made, [*runs, a, b, c]

        want = closed(whole, 0)
        for made, runs in (left(), right(), paired()):
            assert made.cut and not len(made.suffix[0]) and not len(made.suffix[2])
            got = sorted((r for r in [*runs, made.prefix] if len(r[0])), key=lambda r: r[1][0])
            some = [closed(r, 0) for r in got]
            assert ";".join(p.groups for p in some) == want.groups
            assert [p for part in some for p in part.pairs.tolist()] == want.pairs.tolist()
    nothing = Fragment(False, alignment.NOTHING, alignment.NOTHING)
    made, seam = compose(nothing, nothing)
    assert not made.cut and not len(made.prefix[0]) and not len(seam[0])
