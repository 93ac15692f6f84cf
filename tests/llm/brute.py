"""Plain Python counterparts of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, k):
    words = WORDS.findall((text or "").encode().translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def shingle_groups(rows, k, threshold):
    sets = {i: shingles(t, k) for i, t in rows}
    union = Union(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= threshold * len(sets[a] | sets[b]):
                union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def suffix_removal(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256, kept) of each text."""
    coded = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in coded for i in range(len(b) - length + 1))
    found = []
    for b in coded:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, x in zip(b, gone) if not x)
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        found.append((len(b), sum(gone), runs, sha256(kept).hexdigest(), kept))
    return found


def line_dedup(rows, min_lines=2):
    """Text left of each (id, text), by id order: runs of pairs of lines that stand at an earlier place go."""
    seen, left = set(), {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if not text:
            left[i] = text
            continue
        lines = text.split("\n")
        runs, chained = [], False
        for j in range(1, len(lines)):
            pair = (lines[j - 1], lines[j])
            if pair in seen:
                if runs and chained:
                    runs[-1][1] = j
                else:
                    runs.append([j - 1, j])
            chained = pair in seen
            seen.add(pair)
        gone = {k for a, b in runs if sum(x != "" for x in lines[a : b + 1]) >= min_lines for k in range(a, b + 1)}
        left[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return left
