"""T-occurrence search over an inverted index in memory."""

from __future__ import annotations

import heapq
from itertools import groupby
from math import ceil, log2

import numpy as np

#: Weight of the logarithm in the choice of how many lists are long (DivideSkip's mu).
MU = 0.02
#: Entries that are merged through a heap; a counter per set takes more of them.
HEAP_ENTRIES = 1024


class Index:
    """Inverted lists of a block of sets: per token the numbers, ascending, of the sets it is in."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.percent = percent
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        numbers = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.numbers = numbers[order]
        self.tokens, self.starts = np.unique(tokens[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(tokens))

    def search(self, wanted: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Numbers of the sets that reach the overlap with ``wanted``, except where ``skip``.

        DivideSkip: the shortest lists are merged, the longest ones are only probed, by binary
        search, for the sets that the short ones brought up often enough.
        """
        size = len(wanted)
        least = -(-self.percent * size // 100)  # any partner shares so many
        none = np.zeros(0, dtype=np.int64)
        if not len(self.tokens) or not size:
            return none
        at = np.minimum(np.searchsorted(self.tokens, wanted), len(self.tokens) - 1)
        at = at[self.tokens[at] == wanted]
        if len(at) < least:
            return none
        at = at[np.argsort(self.ends[at] - self.starts[at], kind="stable")]
        lists = [self.numbers[self.starts[i] : self.ends[i]] for i in at]
        many = min(least - 1, ceil(least / (MU * log2(len(lists[-1]) + 1) + 1)))
        numbers, counts = merged(lists[: len(lists) - many], len(self.sizes))
        others = self.sizes[numbers]
        small, large = np.minimum(size, others), np.maximum(size, others)
        sound = (counts + many >= least) & ~skip[numbers] & (100 * small >= self.percent * large)
        numbers, counts = numbers[sound], counts[sound]
        need = -(-self.percent * (size + self.sizes[numbers]) // (100 + self.percent))
        left = many
        for found in reversed(lists[len(lists) - many :]):
            if not len(numbers):
                return none
            left -= 1
            place = np.minimum(np.searchsorted(found, numbers), len(found) - 1)
            counts = counts + (found[place] == numbers)
            alive = counts + left >= need
            if not alive.all():
                numbers, counts, need = numbers[alive], counts[alive], need[alive]
        return numbers


def merged(lists: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers on ascending lists, ascending, and on how many lists each is.

    A heap of the lists' heads yields equal numbers one after the other. Many long lists are
    cheaper to count in an array with a place per number.
    """
    if sum(map(len, lists)) > HEAP_ENTRIES:
        counts = np.bincount(np.concatenate(lists), minlength=size)
        numbers = np.nonzero(counts)[0]
        return numbers, counts[numbers]
    heads = heapq.merge(*[found.tolist() for found in lists])
    pairs = [(number, sum(1 for _ in hits)) for number, hits in groupby(heads)]
    out = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]
