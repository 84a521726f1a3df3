"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(rows, percent=75):
    """{doc_id: (n_shingles, component_id)} from (doc_id, text)."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            holders[s].append(d)
    shared = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def remove_repeats(rows, size=35):
    """[(doc_id, n_words, n_removed, kept_sha256)] from (doc_id, text)."""
    split = [(d, words(t)) for d, t in rows]
    count = Counter(tuple(w[i:i + size]) for _, w in split for i in range(len(w) - size + 1))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
