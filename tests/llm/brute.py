"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def kneser_ney(grams: Counter, classes: int):
    """Probability function of a trigram model by the textbook formulas, over dictionaries."""
    pairs, single = Counter(), Counter()
    for a, b, c in grams:
        pairs[b, c] += 1
    for b, c in pairs:
        single[c] += 1

    def cuts(table):
        n = [sum(1 for v in table.values() if v == k) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else (k + 1) / 2 for k in range(3)]
        d = [0.0, *(min(max(x, 0.1), k + 0.9) for k, x in enumerate(raw))]
        return lambda v: d[min(v, 3)]

    d1, d2, d3 = cuts(single), cuts(pairs), cuts(grams)
    total1 = sum(single.values())
    by2, by3 = defaultdict(list), defaultdict(list)
    for (b, _), v in pairs.items():
        by2[b].append(v)
    for (a, b, _), v in grams.items():
        by3[a, b].append(v)

    def p1(c):
        return max(single[c] - d1(single[c]), 0) / total1 + sum(map(d1, single.values())) / total1 / classes

    def p2(b, c):
        held = by2.get(b)
        if not held:
            return p1(c)
        return max(pairs[b, c] - d2(pairs[b, c]), 0) / sum(held) + sum(map(d2, held)) / sum(held) * p1(c)

    def p3(a, b, c):
        held = by3.get((a, b))
        if not held:
            return p2(b, c)
        return max(grams[a, b, c] - d3(grams[a, b, c]), 0) / sum(held) + sum(map(d3, held)) / sum(held) * p2(b, c)

    return p3


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(rows, size, percent):
    """{id: (set size, smallest id reachable)} of (id, text) rows."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for g in s for j in held[g])
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            held[g].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def suffix_dedup(rows, length=50):
    out, first = {}, {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - length + 1):
            if first.setdefault(raw[p : p + length], i) < i:
                gone[p : p + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def line_repeats(rows, threshold=2, min_bytes=40):
    lines = sorted((i, k, x.encode()) for i, t in rows for k, x in enumerate((t or "").split("\n")) if words(x))
    first, out = {}, {}
    for i, k, x in lines:
        if x in first:
            out[i, k] = (*first[x], 0)
        else:
            first[x] = (i, k)
    different = sorted(((x, at) for x, at in first.items() if len(x) >= min_bytes), key=lambda z: len(z[0]))
    counts = [Counter(x) for x, _ in different]
    near = defaultdict(list)
    for m, (x, at) in enumerate(different):
        for n in range(m + 1, len(different)):
            y, other = different[n]
            if len(y) - len(x) > threshold:
                break
            if sum(((counts[m] - counts[n]) + (counts[n] - counts[m])).values()) <= 2 * threshold:
                d = distance(x, y)
                if d <= threshold:
                    a, b = sorted((at, other))
                    near[b].append((*a, d))
    return out | {b: min(v) for b, v in near.items()}


def log_mean(values):
    return sum(map(math.log, values)) / len(values)
