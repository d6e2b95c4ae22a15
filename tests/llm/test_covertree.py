"""Exact cosine links against brute force."""

import numpy as np
import pytest

from arborist.llm import covertree


def brute(rows, threshold=0.9):
    ids, ok, xs = [], [], []
    for i, v in rows:
        ids.append(i)
        good = bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        ok.append(good)
        xs.append(np.array(v, float) / np.linalg.norm(v) if good else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(xs[i]) == len(xs[j]) and xs[i] @ xs[j] >= threshold]
            for i in range(n)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in near[i]:
            root[find(i)] = find(j)
    out = []
    for i in range(n):
        group = [ids[j] for j in range(n) if find(j) == find(i) and ids[j] is not None]
        out.append((ids[i], len(near[i]), min(group, default=None)))
    return sorted(out, key=str)


def vectors(seed, dim=8, singles=150, groups=12):
    rnd = np.random.default_rng(seed)
    rows = list(rnd.normal(size=(singles, dim)))
    for _ in range(groups):
        c = rnd.normal(size=dim)
        rows += [c + rnd.normal(size=dim) * rnd.choice([0.02, 0.15, 0.3]) for _ in range(rnd.integers(2, 25))]
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows if r["vec_id"] is not None)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 4096)])
def test_links_match_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    monkeypatch.setattr(covertree, "_TILE", 500)
    monkeypatch.setattr(covertree, "_DENSE", 200)
    rows = vectors(seed)
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [nan] + [1.0] * 7), (1004, [inf] + [1.0] * 7),
             (1005, [None] + [1.0] * 7), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (3, rows[3][1]), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS row", "1 AS n", "2 AS block")
    assert found(covertree.cosine_links(df)) == brute(rows)


def test_large_group_is_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 128)
    rnd = np.random.default_rng(5)
    c = rnd.normal(size=16)
    rows = [(i, [float(x) for x in c + rnd.normal(size=16) * 0.01]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(covertree.cosine_links(df)) == sorted(((i, 599, 0) for i in range(600)), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert covertree.cosine_links(df).collect() == []


def test_levels_halve_and_cover():
    x = covertree.unit(np.random.default_rng(1).normal(size=(300, 6)))
    tree = covertree.Tree.load(covertree.Tree(x).dump(x))
    for depth, level in enumerate(tree.levels):
        for node in range(len(level["centre"])):
            members = tree.members(depth, node)
            apart = np.sqrt(np.maximum(2 - 2 * x[members] @ x[level["centre"][node]], 0))
            assert apart.max() <= level["radius"][node] + 1e-7
            if 0 < depth <= covertree.LEVELS:
                assert level["radius"][node] <= 2.0 ** (1 - depth) + 1e-7
        assert sorted(np.concatenate([tree.members(depth, i) for i in range(len(level["centre"]))])) == list(range(300))
        if depth:
            assert set(tree.levels[depth - 1]["centre"]) <= set(level["centre"])


@pytest.mark.parametrize("scale", [1e200, 1e-200])
def test_huge_and_tiny_doubles_link_like_others(spark, scale):
    rows = [(i, [x * scale for x in v]) for i, v in vectors(4, singles=30, groups=4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(covertree.cosine_links(df)) == brute(vectors(4, singles=30, groups=4))


def test_links_across_many_blocks_in_64_dimensions(spark, monkeypatch):
    # Clusters wider than a block, so links cross blocks, and block pairs fall to several tasks.
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 32)
    monkeypatch.setattr(covertree, "BLOCKS_PER_SALT", 2)
    rnd = np.random.default_rng(9)
    rows = [c + 0.25 * rnd.normal(size=64) * np.linalg.norm(c) / 8 for c in rnd.normal(size=(12, 64)) for _ in range(60)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    want = brute(rows)
    assert sum(n for _, n, _ in want) > 10_000
    assert found(covertree.cosine_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))) == want
