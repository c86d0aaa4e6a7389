"""Plain single-process versions that the operators are held against."""

import math
import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    found = words(lowered(text))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1)))


def grouped(nodes, linked):
    """Least reachable node per node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_groups(texts, n, percent):
    """texts: id -> text. Least id of the group of each."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    ids = sorted(texts)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return grouped(ids, links)


def cosine(a, b):
    a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
    return math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(
        math.fsum(x * x for x in a) * math.fsum(y * y for y in b)
    )


def rows(df):
    return [tuple(r) for r in df.collect()]
