"""Plain versions of what the operators compute."""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(links, nodes):
    """Smallest node of each node's component."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def edit_distance(a, b, free_ends=False):
    """Word edits between a and b, or a and any run of b."""
    row = [0] * (len(b) + 1) if free_ends else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return min(row) if free_ends else row[-1]


def edited_copies(seed=0, bases=6, copies=8, length=60, vocabulary=400):
    """Texts in groups of copies with ever more words replaced, inserted or removed."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(vocabulary)}"
    out = []
    for _ in range(bases):
        base = [word() for _ in range(rng.integers(length // 2, length))]
        for c in range(copies):
            text = list(base)
            for _ in range(c):
                at = int(rng.integers(len(text)))
                text[at : at + int(rng.integers(2))] = [word()] if rng.integers(3) else []
            out.append(" ".join(text))
    return out
