"""Plain versions of the operators' definitions for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingle_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def near_duplicates(rows):
    """{id: (set size, smallest id of its component)} of (id, text) rows with distinct ids."""
    sets, groups = {i: shingle_set(t) for i, t in rows}, Groups([i for i, _ in rows])
    holders = defaultdict(list)
    for i, own in sets.items():
        common = Counter(j for s in own for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                groups.join(i, j)
        for s in own:
            holders[s].append(i)
    return {i: (len(sets[i]), groups.find(i)) for i in sets}


def vector_links(rows, cosine=0.98):
    """{id: (links, smallest id of its component)} of (id, vector, label) rows with distinct ids."""
    groups, count = Groups([r[0] for r in rows]), Counter()
    good = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, label in rows
            if label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    label = {i: k for i, _, k in rows}
    for a in good:
        for b in good:
            if a < b and label[a] == label[b] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine:
                count[a] += 1
                count[b] += 1
                groups.join(a, b)
    return {i: (count[i], groups.find(i)) for i, _, _ in rows}


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    spans = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, cover = Counter(spans), set()
    for i, span in enumerate(spans):
        if often[span] > 1:
            cover.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed
