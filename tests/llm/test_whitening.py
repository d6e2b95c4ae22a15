"""Whitening against a full eigendecomposition; the FEAST parts on their own."""

import numpy as np
import pytest
from pyspark.sql import types as T

from arborist.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def check(got, rows, components=4):
    """``got`` against numpy on the usable ``rows`` of one length."""
    x = np.array([[np.floor(256.0 * float(np.float32(c))) for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    v = centred.T @ centred / len(fit)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = (x - fit.mean(0)) @ axes / np.sqrt(values)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append((r["vec_id"], r["whitened"], r["explained"], r["n"], int(r["deviation"])))
    assert sorted(by) == list(range(1, components + 1))
    whole = np.vectorize(int, otypes=[object])
    deviation = list(((len(fit) * whole(x) - whole(fit).sum(0)) ** 2).sum(1))
    for k, found in by.items():
        mine = sorted(zip([i for i, _ in rows], want[:, k - 1], deviation))
        found = sorted(found)
        sign = np.sign(sum(a[1] * b[1] for a, b in zip(found, mine)))
        assert [f[0] for f in found] == [m[0] for m in mine]
        np.testing.assert_allclose([sign * f[1] for f in found], [m[1] for m in mine], atol=1e-9)
        assert all(abs(f[2] / (values[k - 1] / np.trace(v)) - 1) < 1e-10 and f[3] == len(fit) for f in found)
        assert sorted(f[4] for f in found) == sorted(m[2] for m in mine)
    assert all(r["identity_error"] < 1e-10 for r in got)


@pytest.mark.parametrize("dim", [4, 7, 64])
def test_equals_the_full_decomposition(spark, dim):
    rng = np.random.default_rng(dim)
    data = rng.standard_normal((300, dim)) * np.linspace(1, 2, dim)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # copies count once
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_rows_left_out_and_repeated(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((60, 5)))]
    rows += [(None, rows[3][1]), (7, rows[8][1])]
    bad = [(90, None), (91, []), (92, [1.0, None, 0.0, 0.0, 0.0]), (93, [float("nan")] * 5), (94, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    df = frame(spark, rows + bad)
    for name in ("x", "n", "values", "component", "whitened"):
        df = df.withColumn(name, df["vec_id"])
    got = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in got} == {i for i, _ in rows}
    assert len(got) == 4 * len(rows)
    assert all(r["identity_error"] < 1e-10 for r in got)


def test_few_distinct_vectors_have_fewer_components(spark):
    rows = [(0, [1.0, 0.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    # Two equal eigenvalues: any pair of axes, whitened all the same.
    assert sorted({r["component"] for r in got}) == [1, 2] and all(r["identity_error"] < 1e-10 for r in got)
    assert all(abs(r["explained"] - 0.5) < 1e-12 for r in got)
    assert whitening.whiten(frame(spark, rows[:1] * 5)).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_lengths_are_lists_of_their_own(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(6 if i % 2 else 4)]) for i in range(80)]
    got = whitening.whiten(frame(spark, rows)).collect()
    for odd in (0, 1):
        check([r for r in got if r["vec_id"] % 2 == odd], [r for r in rows if r[0] % 2 == odd])


def test_huge_entries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(1e9 * rng.standard_normal((50, 4)))]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_inertia_counts_and_intervals():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((40, 30))
    v = a.T @ a
    values = np.linalg.eigvalsh(v)
    diagonal, off = whitening.tridiagonal(v)
    for shift in (values[:-1] + values[1:]) / 2:
        assert whitening.inertia_above(diagonal, off, shift) == (values > shift).sum()
    spans = whitening.intervals(diagonal, off, 10)
    assert sum(n for *_, n in spans) >= 10
    assert all(((values > lo) & (values < hi)).sum() == n for lo, hi, n in spans)
    assert all(a[0] == b[1] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 1], [9, 8, 1, 1, 1, 1], [1e6, 3, 2, 1, 1e-3, 1e-9], [2, 2, 2, 2, 2, 2]])
def test_contours_find_clusters(spark, values):
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((6, 6)))[0]
    v = (q * np.array(values, float)) @ q.T
    v = 0.5 * (v + v.T)
    found, axes = whitening.feast(spark, v, 4)
    np.testing.assert_allclose(found, sorted(map(float, values), reverse=True)[:4], rtol=1e-9, atol=1e-12 * max(values))
    assert np.abs(v @ axes - axes * found).max() < 1e-12 * max(values)
    assert np.abs(axes.T @ axes - np.eye(4)).max() < 1e-9
