"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict


def words(text, kind="plain"):
    text = text or ""
    if kind != "plain":
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" if kind == "alnum" else "[^\x20\x09-\x0D]+", text)


def removed(texts, window):
    """For each text the set of removed word places."""
    seen = Counter()
    rows = [words(t) for t in texts]
    for w in rows:
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    return [{j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)} for w in rows]


def shingles(text, k):
    w = words(text, "lower")
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def classes(texts, k, percent):
    """For each text the smallest place reachable by links."""
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def contamination(texts, items, window):
    """For each text (hit word places, ids of items that occur)."""
    phrases = defaultdict(set)
    for name, text in items:
        w = words(text, "alnum")
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            phrases[tuple(w[i:i + n])].add("null" if name is None else str(name))
    out = []
    for t in texts:
        w, hit, ids = words(t, "alnum"), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                found = phrases.get(tuple(w[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    ids |= found
        out.append((hit, sorted(ids)))
    return out


def mix(rows, weights=(5, 2, 1), cap=3):
    """rows (doc_id, source, size, quality): taken words of each, and targets by source."""
    sizes = Counter()
    for _, s, n, _ in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = sum(sizes.values()), {}
    free = set(order)
    left = float(total)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if cap * sizes[s] <= level * weight[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over

    def key(row):
        u = (int(hashlib.md5(("null" if row[0] is None else str(row[0])).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / row[3]

    taken, upto = {}, Counter()
    for i in sorted(range(len(rows)), key=lambda i: (key(rows[i]), rows[i][0] is not None, rows[i][0] or 0, rows[i][2])):
        _, s, n, _ = rows[i]
        upto[s] += n
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        taken[i] = n * (epochs + (n > 0 and upto[s] - n / 2 <= target[s] - epochs * sizes[s]))
    return [taken[i] for i in range(len(rows))], target


class KneserNey:
    """Interpolated modified Kneser-Ney over characters, straight from the formulas."""

    def __init__(self, texts, order, symbols):
        self.order, self.symbols = order, symbols
        top = Counter()
        for t in texts:
            t = "\0" * (order - 1) + " ".join(t.lower().split())
            top.update(t[i - order + 1:i + 1] for i in range(order - 1, len(t)))
        self.counts = {order: top}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.discount = {}
        for n, c in self.counts.items():
            k = Counter(v for v in c.values() if v <= 4)
            if not (k[1] and k[2] and k[3]):
                self.discount[n] = [0.5, 1.0, 1.5]
                continue
            y = k[1] / (k[1] + 2 * k[2])
            d = (1 - 2 * y * k[2] / k[1], 2 - 3 * y * k[3] / k[2], 3 - 4 * y * k[4] / k[3])
            self.discount[n] = [min(max(x, 0.05), i - 0.05) for i, x in zip((1, 2, 3), d)]

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / self.symbols
        below = self.p(gram[1:])
        here = {g: c for g, c in self.counts[n].items() if g[:-1] == gram[:-1]}
        if not here:
            return below
        cut = lambda c: self.discount[n][min(c, 3) - 1]
        total, own = sum(here.values()), here.get(gram, 0)
        saved = sum(cut(c) for c in here.values())
        return (own - cut(own) if own else 0) / total + saved / total * below

    def perplexity(self, text):
        t = " ".join((text or "").lower().split())
        if not t:
            return None
        t = "\0" * (self.order - 1) + t
        logs = [math.log(self.p(t[i - self.order + 1:i + 1])) for i in range(self.order - 1, len(t))]
        return math.exp(-sum(logs) / len(logs))
