"""Exact cosine pairs by a cover-tree dual traversal.

Unit vectors have cosine >= t exactly when their distance is at most
``sqrt(2 - 2 t)``.  Vectors are dealt to blocks around pivots; every block
is a cover tree: nested levels whose nodes cover their members within a
radius that halves from level to level, each with its true covering
radius.  Two trees are traversed together: a pair of nodes farther apart
than their radii and the bound allow is dropped, a pair that lies within
the bound as a whole is linked as a whole, all others go down a level,
and vectors that meet at the bottom are compared.  Whole blocks are
dropped by the same rule before they are brought together.

Whole links are counted, not listed: a group of n close copies costs about n.
A pivot with many vectors is split into several blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SALTS, connected_components, pack, salted_join, small, unpack, written

THRESHOLD = 0.9
BLOCK_ROWS = 4096
PIVOTS = 512  # at most; a bounded sample of the vectors, used only to deal the blocks
BLOCKS_PER_SALT = 256  # blocks that one task holds against all others of their length
LEVELS = 7  # radii 1, 1/2, ... 1/64; below that, single vectors
_EPS = 1e-7  # room for rounding in the bounds; links themselves are decided by the cosine
_TILE = 1 << 20  # node pairs looked at together
_DENSE = 1 << 12  # pairs of children from which a matrix product pays


def unit(values: np.ndarray) -> np.ndarray:
    # Scaled by a power of two first, which is exact, so that no square overflows or vanishes.
    values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1, keepdims=True))[1])
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _split(x: np.ndarray, members: np.ndarray, radius: float):
    """Cover ``members`` by balls of ``radius`` around some of them, the first
    one's first (so levels are nested): ``(centre, members)`` of each."""
    reach = 1 - radius * radius / 2  # cosine at that distance
    while len(members):
        near = x[members] @ x[members[0]] >= reach
        near[0] = True
        yield members[0], members[near]
        members = members[~near]


class Tree:
    """Levels of a block: ``centre``, ``radius``, and ``first``/``last``, the
    span of ``order`` with the node's members; ``child`` is the span of its
    nodes in the next level.  The last level has one node per vector."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.x, self.levels = x, []
        nodes = [(0, np.arange(n))]
        for depth in range(LEVELS + 2):
            if depth == LEVELS + 1:
                below = [[(m, np.array([m])) for m in ms] for _, ms in nodes]
            elif depth:
                radius = 2.0 ** (1 - depth)
                below = [[(c, ms)] if len(ms) == 1 else list(_split(x, ms, radius)) for c, ms in nodes]
            if depth:
                edges = np.cumsum([0] + [len(b) for b in below])
                self.levels[-1]["child"] = np.stack([edges[:-1], edges[1:]], 1)
                nodes = [node for b in below for node in b]
            ends = np.cumsum([0] + [len(ms) for _, ms in nodes])
            centre = np.array([c for c, _ in nodes])
            flat = np.concatenate([ms for _, ms in nodes])
            apart = 2 - 2 * np.einsum("ij,ij->i", x[flat], x[np.repeat(centre, np.diff(ends))])
            radii = np.sqrt(np.maximum(np.maximum.reduceat(apart, ends[:-1]), 0))
            radii[np.diff(ends) == 1] = 0
            self.levels.append({"centre": centre, "radius": radii, "span": np.stack([ends[:-1], ends[1:]], 1)})
        self.order = flat  # members of any node are neighbours here: levels only refine

    def members(self, level: int, node: int) -> np.ndarray:
        lo, hi = self.levels[level]["span"][node]
        return self.order[lo:hi]

    def dump(self, raw: np.ndarray) -> bytes:
        """Bytes of the tree; ``raw`` are the vectors that ``x`` was made of, in a
        type as narrow as holds them."""
        flat = [small(level[k].reshape(-1)) for level in self.levels for k in ("centre", "span", "child") if k in level]
        return pack(raw.reshape(-1), len(raw), small(self.order), *flat, *[level["radius"] for level in self.levels])

    @classmethod
    def load(cls, blob: bytes) -> Tree:
        raw, n, order, *rest = unpack(blob)
        tree = cls.__new__(cls)
        tree.x, tree.order, tree.levels = unit(raw.astype(float).reshape(n, -1)), order.astype(np.int64), []
        depths = LEVELS + 2
        radii, flat = rest[-depths:], iter(rest[:-depths])
        for depth in range(depths):
            level = {"centre": next(flat).astype(np.int64), "span": next(flat).astype(np.int64).reshape(-1, 2)}
            if depth + 1 < depths:
                level["child"] = next(flat).astype(np.int64).reshape(-1, 2)
            tree.levels.append(level | {"radius": radii[depth]})
        return tree


class _Links:
    """Counts of links per vector and a spanning set of links."""

    def __init__(self, n: int):
        self.counts = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def _find(self, a: np.ndarray) -> np.ndarray:
        while True:
            r = self.root[a]
            if (r == a).all():
                return a
            a = r

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self._find(a), self._find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))


def traverse(a: Tree, b: Tree | None, threshold: float, links: _Links) -> None:
    """Add all links between ``a`` and ``b`` (vectors of ``b`` are numbered after
    those of ``a``), or within ``a`` if ``b`` is None."""
    same = b is None
    b = a if same else b
    shift = 0 if same else len(a.x)
    bound = math.sqrt(2 - 2 * threshold)
    last = len(a.levels) - 1
    narrow = [(t.x.astype(np.float32)) for t in ([a] if same else [a, b])]

    def settle(level: int, i: np.ndarray, j: np.ndarray):
        """Drop, link as a whole, or link vectors; what is left must go down."""
        if same:
            i, j = i[i <= j], j[i <= j]
        la, lb = a.levels[level], b.levels[level]
        ci, cj = la["centre"][i], lb["centre"][j]
        cosine = np.einsum("ij,ij->i", a.x[ci], b.x[cj])
        if level == last:
            hit = cosine >= threshold
            if same:
                hit &= i < j  # each unordered pair once
            p, q = ci[hit], cj[hit] + shift
            np.add.at(links.counts, p, 1)
            np.add.at(links.counts, q, 1)
            links.join(p, q)
            return
        apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        reach = la["radius"][i] + lb["radius"][j]
        whole = apart + reach <= bound - _EPS
        for s, t in zip(i[whole].tolist(), j[whole].tolist()):
            p, q = a.members(level, s), b.members(level, t) + shift
            itself = same and s == t
            links.counts[p] += len(q) - itself
            if not itself:
                links.counts[q] += len(p)
            links.join(p, np.full(len(p), q[0]))
            links.join(q, np.full(len(q), p[0]))
        down = ~whole & (apart - reach <= bound + _EPS)
        if down.any():
            stack.append((level, i[down], j[down]))

    stack: list = []
    settle(0, np.zeros(1, np.int64), np.zeros(1, np.int64))
    while stack:
        level, i, j = stack.pop()
        ca, cb = a.levels[level]["child"], b.levels[level]["child"]
        wide = (ca[i, 1] - ca[i, 0]) * (cb[j, 1] - cb[j, 0]) >= _DENSE
        for s, t in zip(i[wide].tolist(), j[wide].tolist()):
            below, rows, cols = level + 1, ca[s], cb[t]
            to_a, to_b = a.levels[level]["span"][s], b.levels[level]["span"][t]
            if _pairs(to_a, to_b) <= 2 * _pairs(rows, cols):
                # Nearly all nodes below are single vectors: no radius can spare more than half of them.
                below, rows, cols = last, to_a, to_b
            for p, q in _near(a, b, narrow, below, rows, cols, bound):
                settle(below, p, q)
        if not wide.all():
            for p, q in _children(ca, cb, i[~wide], j[~wide]):
                settle(level + 1, p, q)


def _pairs(rows, cols) -> int:
    return int(rows[1] - rows[0]) * int(cols[1] - cols[0])


def _near(a: Tree, b: Tree, narrow, level: int, rows, cols, bound: float):
    """Pairs of the nodes ``rows`` x ``cols`` of a level that the bounds may
    keep: all cosines as single-precision matrix products, some rows at a
    time, with room for their rounding."""
    la, lb = a.levels[level], b.levels[level]
    y = narrow[-1][lb["centre"][cols[0] : cols[1]]].T
    reach = (lb["radius"][cols[0] : cols[1]] + bound + _EPS).astype(np.float32)
    step = max(1, _TILE // int(cols[1] - cols[0]))
    for lo in range(rows[0], rows[1], step):
        hi = min(lo + step, rows[1])
        cosine = narrow[0][la["centre"][lo:hi]] @ y
        own = la["radius"][lo:hi].astype(np.float32)
        widest = min(2.0, float(own.max() + reach.max()))
        if cosine.max() < 1 - widest * widest / 2 - 1e-5:
            continue
        least = np.minimum(own[:, None] + reach, 2)
        least *= least
        least *= -0.5
        least += 1 - 1e-5
        p, q = np.nonzero(cosine >= least)
        for at in range(0, len(p), _TILE):
            yield p[at : at + _TILE] + lo, q[at : at + _TILE] + cols[0]


def _children(ca, cb, i, j):
    """All pairs of children of the pairs (i, j), in pieces of about _TILE pairs."""
    na, nb = ca[i, 1] - ca[i, 0], cb[j, 1] - cb[j, 0]
    rows = np.repeat(np.arange(len(i)), na)
    first = ca[i, 0][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(na) - na, na)
    width = nb[rows]
    ends = np.cumsum(width)
    cuts = np.searchsorted(ends, np.arange(_TILE, ends[-1] + _TILE, _TILE))
    lo = 0
    for cut in np.unique(np.minimum(cuts + 1, len(rows))):
        r, w = rows[lo:cut], width[lo:cut]
        at = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        yield np.repeat(first[lo:cut], w), np.repeat(cb[j, 0][r], w) + at
        lo = cut


# --- Spark ------------------------------------------------------------------------

def _valid(vector: str) -> F.Column:
    """Vectors that can link: no null, NaN or infinite component, not all zero."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)


def _blocks(vectors: DataFrame, n: int) -> DataFrame:
    """``(block, row, vector)``: vectors with a finite direction, dealt to the nearest pivot, then by hash."""
    pivots = min(PIVOTS, max(1, n // BLOCK_ROWS))
    picked = vectors.orderBy(F.xxhash64("row")).limit(pivots).select("vector").collect()
    by_size: dict[int, list] = {}
    for (v,) in picked:
        by_size.setdefault(len(v), []).append(v)
    centres = {d: unit(np.array(vs, float)) for d, vs in by_size.items()}

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                c = centres.get(len(v))
                out.append(0 if c is None else int((c @ unit(np.array([v], float))[0]).argmax()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], ["row", "vector", "pivot"])

    dealt = written(vectors.select("row", "vector").mapInArrow(run, "row long, vector array<double>, pivot int"))
    sizes = dealt.groupBy(F.size("vector").alias("dim"), "pivot").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = dealt.withColumn("dim", F.size("vector")).join(F.broadcast(sizes), ["dim", "pivot"])  # a row per pivot and length
    return dealt.select(F.struct("dim", "pivot", part.alias("part")).alias("block"), "row", "vector")


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One block's tree; its root's centre and radius."""
    order = np.argsort(rows.column("row").to_numpy())
    vectors = np.array(rows.column("vector").to_pylist(), float)[order]
    single = vectors.astype(np.float32)
    x = unit(vectors)
    tree = Tree(x)
    root = tree.levels[0]
    return pa.table({
        "dim": pa.array([key[0].as_py()["dim"]], pa.int32()),
        "name": [repr(key[0].as_py())], "rows": [rows.column("row").to_numpy()[order].tolist()],
        "centre": [x[root["centre"][0]].tolist()], "radius": [float(root["radius"][0])],
        "tree": pa.array([tree.dump(single if (single == vectors).all() else vectors)], pa.binary()),
    })


def _compare(threshold: float):
    def run(key: tuple[pa.Scalar, ...], sides: pa.Table) -> pa.Table:
        got = sorted(sides.select(["name", "rows", "tree"]).to_pylist(), key=lambda r: r["name"])
        a = Tree.load(got[0]["tree"])
        b = Tree.load(got[1]["tree"]) if len(got) > 1 else None
        rows = np.concatenate([np.array(g["rows"], np.int64) for g in got])
        links = _Links(len(rows))
        traverse(a, b, threshold, links)
        hit = np.flatnonzero(links.counts)
        root = links._find(hit)
        return pa.table({"row": rows[hit], "n": links.counts[hit], "root": rows[root]})

    return run


def cosine_links(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows of cosine >= ``threshold`` (double
    precision), ``component_id`` is the smallest id reachable by links, the
    row's own included.  Vectors that are null, empty, all zero, or hold
    null or non-finite components link with nothing; vectors link only
    with those of the same length.  Repeated rows link with each other;
    null ids count as larger than all others; an empty table gives an empty
    result; other columns are not read.
    """
    # Every row gets a number of its own; written, so that it stays.
    base = written(
        vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    usable = base.where(_valid("vector"))
    schema = "dim int, name string, rows array<long>, centre array<double>, radius double, tree binary"
    blocks = written(_blocks(usable, usable.count()).groupBy("block").applyInArrow(_build, schema))
    # Pairs of blocks by number, one row per block; those too far apart are dropped.
    # One length may hold all blocks, so its first blocks are dealt to tasks.
    one = blocks.select("dim", F.col("name").alias("one"), F.col("centre").alias("centre1"), F.col("radius").alias("radius1"))
    two = blocks.select("dim", F.col("name").alias("two"), F.col("centre").alias("centre2"), F.col("radius").alias("radius2"))
    cosine = F.aggregate(F.zip_with("centre1", "centre2", lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine))
    bound = math.sqrt(2 - 2 * threshold) + 1e-6
    salts = max(SALTS, blocks.count() // BLOCKS_PER_SALT)
    pairs = salted_join(one, two, ["dim"], F.xxhash64("one"), salts=salts).where(
        (F.col("one") <= F.col("two")) & (apart - F.col("radius1") - F.col("radius2") <= bound)
    )
    pairs = written(pairs.select("one", "two"))
    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("name"))
    met = sides.join(blocks.select("name", "rows", "tree"), "name").groupBy("one", "two")
    found = written(met.applyInArrow(_compare(threshold), "row long, n long, root long"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    roots = written(connected_components(found.select(F.col("row").alias("u"), F.col("root").alias("v"))))
    named = base.select("vec_id", "row").join(roots, F.col("row") == F.col("node"), "left")
    named = named.select("vec_id", "row", F.coalesce("root", "row").alias("root")).join(counts, "row", "left")
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = salted_join(named, least, ["root"], F.xxhash64("row"))
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
