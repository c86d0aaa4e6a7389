"""Word shingles of whole texts as 64-bit numbers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

#: Texts are split into words in blocks of about so many bytes, cut at white space.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _hashes(words: list[bytes]) -> np.ndarray:
    held = np.empty(len(words), dtype=object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False) if words else np.zeros(0, np.uint64)


def _cut(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > BLOCK:
        space = _SPACE.search(text, at + BLOCK)
        if not space:
            break
        yield text[at : space.start()]
        at = space.end()
    yield text[at:]


def _words(text: bytes) -> np.ndarray:
    """Hashes of the words of one long text."""
    return np.concatenate([_hashes(part.lower().split()) for part in _cut(text)])


def _multipliers(words: int) -> np.ndarray:
    return mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct shingles of a sequence of word hashes."""
    if not len(hashes):
        return hashes
    times = _multipliers(words)
    if len(hashes) < words:  # the whole sequence is the only one
        whole = (hashes * times[: len(hashes)]).sum(dtype=np.uint64)
        return mixed(np.array([whole + np.uint64(len(hashes))], dtype=np.uint64))
    last = len(hashes) - words + 1
    found = np.zeros(last, dtype=np.uint64)
    for i in range(words):
        found += hashes[i : i + last] * times[i]
    return np.unique(mixed(found))


def shingle_sets(texts: Iterable[bytes | None], words: int) -> Iterator[np.ndarray]:
    """Per UTF-8 text the sorted distinct shingles of ``words`` words.

    A-Z count as lower case; words are runs of anything but space, tab and the line and page
    breaks of ASCII, which is what bytes.lower and bytes.split go by. A text with fewer words has
    the whole sequence as its only shingle; one without words, or null, has none. Texts are
    taken in blocks, so words of a long text are never all held at once.
    """
    waiting: list[list[bytes]] = []
    held = 0

    def flush() -> Iterator[np.ndarray]:
        hashes = _hashes([w for words_of in waiting for w in words_of])
        at = 0
        for words_of in waiting:
            yield _shingles(hashes[at : at + len(words_of)], words)
            at += len(words_of)
        waiting.clear()

    for text in texts:
        if text is not None and len(text) > BLOCK:
            yield from flush()
            held = 0
            yield _shingles(_words(text), words)
            continue
        waiting.append((text or b"").lower().split())
        held += len(text or b"")
        if held > BLOCK:
            yield from flush()
            held = 0
    yield from flush()


def fingerprint(found: np.ndarray) -> int:
    """A 64-bit number of a set, the same in any order."""
    total = mixed(found + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(mixed(total[None] + np.uint64(len(found)))[0].astype(np.int64))
