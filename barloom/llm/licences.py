"""Licence scans by canonical digests.

A text is normalised so that ways to write the same licence come out equal, digested, and looked
up among the digests of known licences. What is looked up are entire texts: the document, and
each of its lines as a text of its own.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterable
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.batches import Batches, batch_of
from barloom.llm.common import landed

# Words that licences spell in several ways, with the spelling that stands for them.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments",
    "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber",
    "cancelled": "canceled", "catalogue": "catalog", "centre": "center", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http",
    "initialise": "initialize", "judgement": "judgment", "labour": "labor", "licence": "license",
    "licences": "licenses", "licenced": "licensed", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "owner": "holder", "owners": "holders",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
# Words written together or apart.
PAIRS = {
    ("per", "cent"): "percent", ("sub", "license"): "sublicense", ("non", "commercial"): "noncommercial",
    ("non", "infringement"): "noninfringement", ("no", "derivatives"): "noderivatives",
    ("share", "alike"): "sharealike",
}

# Short notices, by SPDX id, with the names that a licence goes by.
NAMES = {
    "MIT": ("MIT", "Expat", "X11 MIT"),
    "Apache-2.0": ("Apache", "Apache Software"),
    "GPL-2.0": ("GNU General Public", "GNU GPL", "GPL"),
    "GPL-3.0": ("GNU General Public", "GNU GPL", "GPL"),
    "LGPL-2.1": ("GNU Lesser General Public", "GNU LGPL", "LGPL"),
    "LGPL-3.0": ("GNU Lesser General Public", "GNU LGPL", "LGPL"),
    "AGPL-3.0": ("GNU Affero General Public", "GNU AGPL", "AGPL"),
    "MPL-2.0": ("Mozilla Public", "MPL"),
    "BSD-2-Clause": ("BSD 2-Clause", "Simplified BSD", "FreeBSD"),
    "BSD-3-Clause": ("BSD 3-Clause", "New BSD", "Modified BSD"),
    "ISC": ("ISC",),
    "Zlib": ("zlib",),
    "CC-BY-4.0": ("CC BY", "Creative Commons Attribution"),
    "CC-BY-SA-4.0": ("CC BY-SA", "Creative Commons Attribution-ShareAlike"),
    "CC-BY-NC-4.0": ("CC BY-NC", "Creative Commons Attribution-NonCommercial"),
    "CC-BY-ND-4.0": ("CC BY-ND", "Creative Commons Attribution-NoDerivatives"),
    "CC0-1.0": ("CC0", "Creative Commons Zero"),
}
# Words that open a notice, before "under"; they count as the same.
VERBS = ("licensed", "released", "distributed", "available", "provided")

# Whole texts of short licences.
TEXTS = {
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
    """,
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
        AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.
    """,
    "Zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event will
        the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following
        restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software.
        3. This notice may not be removed or altered from any source distribution.
    """,
}


#: Where the instructions for using a licence begin; copies come with and without them.
APPENDIX = {
    "Apache-2.0": "APPENDIX: How to apply",
    "GPL-2.0": "How to Apply These Terms to Your New Programs",
    "GPL-3.0": "How to Apply These Terms to Your New Programs",
    "LGPL-2.1": "How to Apply These Terms to Your New Libraries",
}
#: Texts from so many characters on have their title in the text.
TITLED = 4000
#: Numbers and stars of lists, which some copies leave out.
_LIST_NUMBER = re.compile(r"(?m)^\s*(\d\.|\*)\s+")


def _resource(name: str) -> str:
    return (resources.files("barloom.llm") / "licence_texts" / name).read_text(encoding="utf-8")


def spdx_ids() -> list[str]:
    """All ids of the SPDX list, old ones included."""
    return _resource("spdx_ids.txt").split()


def whole_texts() -> Iterable[tuple[str, str]]:
    """(SPDX id, text) of whole licences: those in TEXTS and in the files beside this one."""
    yield from TEXTS.items()
    yield "ISC", TEXTS["ISC"].replace("and/or", "and")
    names = (f.name for f in (resources.files("barloom.llm") / "licence_texts").iterdir())
    for file in sorted(n for n in names if n.endswith(".txt") and n != "spdx_ids.txt"):
        spdx, text = file.removesuffix(".txt").partition("_")[0], _resource(file)
        yield spdx, text
        if spdx in APPENDIX:
            yield spdx, text[: text.index(APPENDIX[spdx])]
        if spdx.startswith("BSD"):
            yield spdx, _LIST_NUMBER.sub("", text)


def headings(spdx: str) -> list[str]:
    """Lines that a copy of a licence may begin with, by its names."""
    last = spdx.rpartition("-")[2]
    out = [spdx]
    for name in NAMES[spdx]:
        for own in {name, *([f"{name} {last}"] if last[0].isdigit() else [])}:
            out += [own, f"{own} License", f"The {own} License", f"The {own} License ({spdx})"]
            out += [f"{own} License ({spdx})", f"The {own}"]
    return out


def headed_texts() -> Iterable[tuple[str, str]]:
    """(SPDX id, text) of whole licences; short ones, which bring no title, also with a heading."""
    for spdx, text in whole_texts():
        yield spdx, text
        for heading in headings(spdx) if len(text) < TITLED else ():
            yield spdx, f"{heading}\n{text}"


def notices() -> Iterable[tuple[str, str]]:
    """(SPDX id, notice) for every name of a licence and every way to put its version."""
    for spdx, names in NAMES.items():
        last = spdx.rpartition("-")[2]
        versions = {last, last.removesuffix(".0")} if last[0].isdigit() else {""}
        for name in names:
            for kind in (f"{name} License", f"{name} Public License", name):
                for version in versions:
                    yield spdx, f"Licensed under the {kind} {version}"
    for spdx in {*NAMES, *spdx_ids()}:
        yield spdx, f"SPDX-License-Identifier: {spdx}"


def known_licences(spark: SparkSession) -> DataFrame:
    """(licence, text): whole texts and short notices, a bounded table."""
    rows = sorted({*headed_texts(), *notices()})
    return spark.createDataFrame(rows, "licence string, text string")


#: A clause about the copyright: its mark, years, and what else a holder is named by.
_MARK = re.compile(r"(?:\(c\)|\u00a9|\bcopyright\b)(?:\s*(?:\(c\)|\u00a9|\bcopyright\b))*")
_SINCE = re.compile(r"\W*(?:\d{4}\b|yyyy\b|year\b)")
_BY = re.compile(r"\W*by\b")
_RESERVED = re.compile(r"\ball rights reserved\b")
#: The end of a sentence, but for initials and "inc." and the like.
_STOP = re.compile(r"(?<!\b[a-z])(?<!\binc)(?<!\bltd)(?<!\bco)(?<!\bcorp)(?<!\bllc)(?<!\bst)(?<!\bdr)(?<!\bjr)[.;!?]\s+(?=\w)")
#: Words of terms, which no holder is named by, and the most words of a holder.
_TERMS = frozenset(
    "any are be can cannot commercial copies forbidden freely granted hereby holders is license "
    "licensed may must no not notice notices only owners permission permitted prohibited provided "
    "redistribute redistribution sell shall subject that this under use used warranty will without "
    "you your".split()
)
_LONGEST_HOLDER = 24
#: How the text of a licence or a notice goes on after the clause, on the same line.
_OPENING = re.compile(
    r"\b(?:permission\W+is\W+hereby\W+granted|permission\W+is\W+granted|permission\W+to\W+use"
    r"|redistribution\W+and\W+use|this\W+software\W+is\W+provided"
    r"|(?:this\W+\w+\W+is\W+)?(?:" + "|".join(VERBS) + r")\W+under)\b"
)
_WORD = re.compile(r"[^\W_]+")
_VERSION = re.compile(r"v\d+$")


def _says_holder(mark: str, rest: str) -> bool:
    """Whether what follows a mark is years and a holder's name, and nothing else."""
    signed = "\u00a9" in mark or ("copyright" in mark and "(c)" in mark)
    if not (signed or _SINCE.match(rest) or ("copyright" in mark and _BY.match(rest))):
        return False
    for part in _MARK.split(_RESERVED.sub(" ", rest)):
        name = re.sub(r"^[\W\d]+", "", part)
        words = _WORD.findall(name)
        if len(words) > _LONGEST_HOLDER or _STOP.search(name) or not _TERMS.isdisjoint(words):
            return False
    return True


@functools.cache
def _heading_words() -> frozenset[tuple[str, ...]]:
    return frozenset(tuple(_canonical(h.lower())) for spdx in NAMES for h in headings(spdx))


def without_holder(line: str) -> str:
    """A line in lower case without the clause that says who holds the copyright.

    The clause opens the line, or follows a heading, and ends with the line or where a licence
    begins. A line with other words in these places is left as it is.
    """
    if not _WORD.search(_RESERVED.sub(" ", line)):
        return ""
    mark = _MARK.search(line)
    if mark is None:
        return line
    before, rest = line[: mark.start()], line[mark.end() :]
    if len(before) > 100 or (_WORD.search(before) and tuple(_canonical(before)) not in _heading_words()):
        return line
    opening = _OPENING.search(rest)
    end = opening.start() if opening else len(rest)
    return f"{before} {rest[end:]}" if _says_holder(mark.group(), rest[:end]) else line


def words_of(line: str) -> list[str]:
    """Canonical words of a line: lower case, no punctuation, one spelling, without the clause
    that says who holds the copyright."""
    line = line.lower()
    if "copyright" in line or "(c)" in line or "\u00a9" in line or "rights reserved" in line:
        line = without_holder(line)
    return _canonical(line)


def _canonical(line: str) -> list[str]:
    out: list[str] = []
    for word in _WORD.findall(line):
        word = SPELLINGS.get(word, word)
        if word == "version":
            continue
        if word[0] == "v" and _VERSION.match(word):
            word = word[1:]
        if out and (out[-1], word) in PAIRS:
            out[-1] = PAIRS[out[-1], word]
        else:
            out.append(word)
    if len(out) > 4 and out[0] == "this" and out[2] == "is" and out[3] in VERBS:
        out = out[3:]  # "this work is licensed ..."
    if len(out) > 2 and out[0] in VERBS and out[1] == "under":
        out[0] = VERBS[0]
        if out[2] == "the":
            del out[2]
    return out


def digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


DIGESTS = {
    "row": pa.int64(), "doc_id": pa.int64(), "line": pa.int64(), "whole": pa.string(),
    "digest": pa.string(),
}


def _scanned(counts: frozenset[int] | None) -> Callable[[Batches], Batches]:
    """Digests of a text (line 0) and of its lines (from 1) that have as many words as some
    known licence; other lines cannot be equal to one."""

    def scan(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for row, doc, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                lines = [words_of(line) for line in (text or "").split("\n")]
                own = [line for line in lines if line]
                whole = digest([w for line in own for w in line]) if own else None
                rows.append((row, doc, 0, whole, whole))
                if counts is not None and len(own) > 1:
                    rows += [
                        (row, doc, i + 1, None, digest(line))
                        for i, line in enumerate(lines) if len(line) in counts
                    ]
            yield batch_of(DIGESTS, rows)

    return scan


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, digest, licence, notices, licences.

    ``digest`` is that of the whole normal form, null if no words are left; ``licence`` is the
    known licence that the whole text is. ``notices`` counts its lines that are a known licence
    or notice each, or 1 if the whole text is one; ``licences`` lists, sorted and without repeats,
    what was found. A text that several licences share gets the first by name. Null and empty
    texts find nothing. Rows that repeat a doc_id, or have none, are documents of their own.
    ``known`` has (licence, text) and may be a user's own table of licences, with as many texts
    of one licence as there are forms of it; an empty table of either kind is fine.
    """
    spark = docs.sparkSession
    known = known_licences(spark) if known is None else known
    table = known.select(F.lit(0).cast("long").alias("doc_id"), "text", "licence")

    def listed(batches: Batches) -> Batches:
        schema = {"licence": pa.string(), "key": pa.string(), "words": pa.int64()}
        for batch in batches:
            rows = []
            for text, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = [w for line in (text or "").split("\n") for w in words_of(line)]
                if words:
                    rows.append((name, digest(words), len(words)))
            yield batch_of(schema, rows)

    keys = table.mapInArrow(listed, "licence string, key string, words long")
    keys = landed(keys.groupBy("key", "words").agg(F.min("licence").alias("licence")), "known")
    # Numbers of words of licences that lines can be: one small number per length there is.
    counts = frozenset(r["words"] for r in keys.select("words").distinct().collect())
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
    )
    found = texts.mapInArrow(
        _scanned(counts), "row long, doc_id long, line long, whole string, digest string"
    )
    met = found.join(keys.select("key", "licence"), F.col("digest") == F.col("key"), "left")
    of_row = met.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("whole").alias("digest"),
        F.min(F.when(F.col("line") == 0, F.col("licence"))).alias("licence"),
        F.count("licence").alias("notices"),
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
    )
    return of_row.drop("row")
