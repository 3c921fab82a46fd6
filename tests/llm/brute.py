"""What the pair operators have to find, by comparing everything with everything."""

import math

import numpy as np


class Groups(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def jaccard(rows, width, percent):
    """Per position: number of shingles and smallest id of the component."""
    sets, groups = [shingles(t, width) for _, t in rows], Groups()
    for i in range(len(rows)):
        groups.root(i)
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                groups.join(i, j)
    return _named([i for i, _ in rows], groups, [len(s) for s in sets])


def cosine(rows, limit):
    groups, links = Groups(), [0] * len(rows)
    fine = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) and label is not None for _, v, label in rows]
    for i in range(len(rows)):
        groups.root(i)
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if fine[i] and fine[j] and la == lb and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= limit:
                    groups.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return _named([i for i, _, _ in rows], groups, links)


def _named(ids, groups, values):
    least = {}
    for i, name in enumerate(ids):
        root = groups.root(i)
        least[root] = min((x for x in (least.get(root), name) if x is not None), default=None)
    return sorted(((name, v, least[groups.root(i)]) for i, (name, v) in enumerate(zip(ids, values, strict=True))), key=repr)


def repeats(rows, length):
    """Per row: bytes kept and removed runs ``(start, length)``."""
    first = {}
    order = lambda i: math.inf if i is None else i
    for i, text in rows:
        b = (text or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, math.inf), order(i))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < order(i):
                gone[k:k + length] = [True] * length
        starts = [k for k in range(len(b)) if gone[k] and not (k and gone[k - 1])]
        spans = [(k, next((e for e in range(k, len(b)) if not gone[e]), len(b)) - k) for k in starts]
        out.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g), spans))
    return sorted(out, key=repr)
