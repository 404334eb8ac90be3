"""Plain Python versions for comparison."""

import re
from collections import Counter


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in (x for x in links if x[0] != x[1]):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def word_shingles(text, size=5):
    w = re.findall(r"[A-Za-z0-9_\x80-\U0010ffff]+", (text or "").lower())
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def probability_jaccard(x, y):
    total = 0.0
    every = set(x) | set(y)
    for i in set(x) & set(y):
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every)
    return total


def char_shingles(line, size=6):
    line = line.strip().lower()
    return {line[i:i + size] for i in range(max(1, len(line) - size + 1))} if line else set()


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 0.0
