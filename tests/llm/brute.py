"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def covered(texts, window):
    """For each sequence the flags of the symbols in a window that starts elsewhere too."""
    counts = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        flags = [False] * len(t)
        for i in range(len(t) - window + 1):
            if counts[tuple(t[i : i + window])] > 1:
                flags[i : i + window] = [True] * window
        out.append(flags)
    return out


def repeated_bytes(texts, window=200):
    raw = [(t or "").encode() for t in texts]
    for t, flags in zip(raw, covered(raw, window), strict=True):
        runs = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        yield len(t), sum(flags), runs, sha(bytes(b for b, f in zip(t, flags, strict=True) if not f))


def repeated_words(texts, window=35):
    lists = [(t or "").encode().split() for t in texts]
    for w, flags in zip(lists, covered(lists, window), strict=True):
        yield len(w), sum(flags), sha(b" ".join(x for x, f in zip(w, flags, strict=True) if not f))


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def components(rows, percent=80):
    """``(id, size of set, smallest id in the component)`` of each row."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        known = [k for k in (least.get(root(i)), key) if k is not None]
        least[root(i)] = min(known) if known else None
    return [(key, len(s), least[root(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def leaks(texts, items, window=10):
    def words(t):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    grams = []
    for name, text in items:
        w = words(text)
        n = min(len(w), window)
        grams += [("" if name is None else name, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for t in texts:
        w, hit, names = words(t), set(), set()
        for name, g in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    names.add(str(name))
        yield len(w), len(hit), sorted(names)
