"""Row-by-row Python statement of the learner's definitions (test oracle).

Deliberately naive: sorts whole columns, counts with loops, recurses per
node.  Only for tiny fixtures.
"""

from __future__ import annotations

import math
from collections import Counter

FILLER = "FILLER_STRING"
QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.9)


def nearest_rank(values, q):
    vals = sorted(v for v in values if v is not None)
    if not vals:
        return None
    return vals[math.floor((len(vals) - 1) * q + 0.5)]


def bucket(rows, column, min_count=32, cap=6):
    counts = Counter(r[column] for r in rows if r[column] is not None)
    frequent = sorted(((n, v) for v, n in counts.items() if n >= min_count), key=lambda t: (-t[0], t[1]))
    keep = {v for _, v in frequent[:cap]}
    return keep


def gini(left_counts, right_counts):
    tl, tr = sum(left_counts.values()), sum(right_counts.values())
    if tl == 0 or tr == 0:
        return None
    sl = sum(c * c for c in left_counts.values())
    sr = sum(c * c for c in right_counts.values())
    return 1.0 - (sl / tl + sr / tr) / (tl + tr)


def candidates(rows, label, kinds, reference=False, quantiles=QUANTILES):
    """All candidates: dicts with feature, kind, threshold, category, n_left, n_right, score."""
    out = []
    for f, kind in kinds.items():
        if kind == "ordinal":
            vals = [r[f] for r in rows]
            ts = [nearest_rank(vals, q) for q in quantiles]
            mult = Counter(t for t in ts if t is not None)
            for t, m in sorted(mult.items()):
                left, right = Counter(), Counter()
                for r in rows:
                    v = r[f]
                    if v is None:
                        if not reference:
                            right[r[label]] += 1
                    elif v >= t:
                        left[r[label]] += 1
                    else:
                        right[r[label]] += 1
                g = gini(left, right)
                tl, tr = sum(left.values()), sum(right.values())
                if reference:
                    g = None if g is None else 1.0 - (1.0 - g) / m
                    tl, tr = tl * m, tr * m
                out.append(dict(feature=f, kind=kind, threshold=t, category=None, n_left=tl, n_right=tr, score=g))
        else:
            cats = sorted({r[f] for r in rows if r[f] != FILLER})
            for c in cats:
                left, right = Counter(), Counter()
                for r in rows:
                    (left if r[f] == c else right)[r[label]] += 1
                g = gini(left, right)
                out.append(dict(feature=f, kind=kind, threshold=None, category=c,
                                n_left=sum(left.values()), n_right=sum(right.values()), score=g))
    return out


def order_key(c):
    return (c["score"] is None, c["score"] if c["score"] is not None else 0.0, c["feature"],
            c["threshold"] is None, c["threshold"] or 0.0, c["category"] is None, c["category"] or "")


def best(rows, label, kinds, reference=False):
    cands = [c for c in candidates(rows, label, kinds, reference) if c["score"] is not None]
    return min(cands, key=order_key) if cands else None


def majority(rows, label):
    counts = Counter(r[label] for r in rows)
    return min(counts.items(), key=lambda t: (-t[1], t[0]))[0] if counts else None


def fit(rows, label, kinds, max_depth=4, min_leaf=32, reference=False):
    """Returns {node_id: dict} like the node table (subset of columns)."""
    nodes = {}

    def go(node_id, depth, part, closed):
        labels = {r[label] for r in part}
        b = None
        if not closed and depth < max_depth and (reference or len(labels) > 1):
            b = best(part, label, kinds, reference)
        if b is None:
            nodes[node_id] = dict(is_leaf=True, depth=depth, n_rows=len(part), label=majority(part, label))
            return
        nodes[node_id] = dict(is_leaf=False, depth=depth, n_rows=len(part), feature=b["feature"],
                              threshold=b["threshold"], category=b["category"], n_left=b["n_left"], n_right=b["n_right"])
        f = b["feature"]

        def side(r):
            v = r[f]
            if b["kind"] == "ordinal":
                if v is None:
                    return None if reference else False
                return v > b["threshold"] if reference else v >= b["threshold"]
            return v == b["category"]

        left = [r for r in part if side(r) is True]
        right = [r for r in part if side(r) is False]
        go(2 * node_id, depth + 1, left, b["n_left"] < min_leaf or depth + 1 >= max_depth)
        go(2 * node_id + 1, depth + 1, right, b["n_right"] < min_leaf or depth + 1 >= max_depth)

    go(1, 0, rows, max_depth == 0)
    return nodes
