"""Katz backoff on one machine, from the definitions."""

import functools
import math
from collections import Counter, defaultdict

K = 5


def discounts(counts):
    n = Counter(counts)
    out = {}
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        out[r] = d if 0 < d <= 1 else (r - 0.5) / r
    return out


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def score(train, texts, order=2):
    """[(n_known, base, score)] of the texts under the model of ``train``."""
    uni = Counter(w for t in train for w in tokens(t))
    grams = {n: defaultdict(Counter) for n in range(2, order + 1)}  # by context
    for t in train:
        w = tokens(t)
        for n, counted in grams.items():
            padded = ("start",) * (n - 1) + tuple(w)
            for i, word in enumerate(w):
                counted[padded[i : i + n - 1]][word] += 1
    total = sum(uni.values())
    d = {1: discounts(uni.values())}
    d |= {n: discounts(c for after in g.values() for c in after.values()) for n, g in grams.items()}
    left = sum(c * (1 - d[1][c]) for c in uni.values() if c <= K)
    whole = total if left else total + 1
    unknown = (left or 1.0) / whole
    discounted = lambda n, c: (d[n][c] if c <= K else 1.0) * c

    def p1(w):
        return discounted(1, uni[w]) / whole if uni[w] else unknown

    @functools.cache
    def facts(context):
        n = len(context) + 1
        after = grams[n][context]
        count = sum(after.values())
        free = sum(c * (1 - d[n][c]) for c in after.values() if c <= K)
        n_all = count if free > 0 else count + 1
        return n_all, (free if free > 0 else 1.0) / n_all / (1 - sum(p(context[1:], w) for w in after))

    def p(context, w):
        if not context:
            return p1(w)
        after = grams[len(context) + 1].get(context)
        if not after:
            return p(context[1:], w)
        n_all, alpha = facts(context)
        return discounted(len(context) + 1, after[w]) / n_all if after[w] else alpha * p(context[1:], w)

    out = []
    for t in texts:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 0.1) / (total + 0.1 * (len(uni) + 1))) for x in w)
        padded = ("start",) * (order - 1) + tuple(w)
        chances = [p(padded[i : i + order - 1], x) for i, x in enumerate(w)]
        out.append((sum(x in uni for x in w), base, sum(map(math.log10, chances))))
    return out, (uni, grams, p, unknown)
