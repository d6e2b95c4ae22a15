"""Embedding whitening by FEAST contour integration.

Vectors become whole numbers, repeated vectors count once, and one pass of
Spark tasks sums the centred products of the fit list: a covariance of
``d x d`` numbers, whatever the number of vectors.  Its eigenvalues are
never taken from a ready-made solver:

* a tridiagonal form answers inertia counts (how many eigenvalues lie above
  a shift) by sign changes; bisection on the counts cuts the top of the
  spectrum into intervals of a few eigenvalues each, ends between them;
* for each interval the spectral projector is the contour integral of
  ``(zI - V)^-1`` over a circle through its ends, by quadrature: every
  (interval, point) is one Spark task's complex solve against the basis;
* Rayleigh-Ritz on the projected basis gives the eigenpairs; the passes
  are repeated until the residuals are at rounding, and the inertia count
  must agree with the number found, so that no component is missed.

A second pass over the fit list measures the covariance of the whitened
vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SCALE = 256  # fixed value of the contract
COMPONENTS = 4
POINTS = 12  # quadrature points on the upper half of a circle
PER_INTERVAL = 4  # eigenvalues of an interval, unless more are equal
ROUNDS = 30
# Eigenvalues below this share of the trace are rounding, not components.
LEAST_SHARE = 1e-12
_VECTORS = 4_096  # vectors of one matrix product


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, x)``: whole-number vectors of the rows that have one."""
    values = F.col("values")
    bad = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("values"))
    rows = rows.where(values.isNotNull() & ~bad & (F.size(values) > 0))
    return rows.select("vec_id", F.transform(values, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def products(rows: DataFrame, dim: int, project) -> np.ndarray:
    """Sum over ``rows (x)`` of ``[1, p]^T [1, p]`` for the rows ``p`` of
    ``project(matrix of x)``: counts, sums and centred products at once.
    Each task adds its own up; the sums of tasks meet by row of the matrix."""

    def run(batches):
        total = None
        for batch in batches:
            for lo in range(0, batch.num_rows, _VECTORS):
                p = project(_matrix(batch.column(0).slice(lo, _VECTORS), dim))
                p = np.hstack([np.ones((len(p), 1)), p])
                total = p.T @ p if total is None else total + p.T @ p
        if total is not None:
            cells = [pa.array(np.repeat(np.arange(len(total)), len(total))), pa.array(np.tile(np.arange(len(total)), len(total)))]
            yield pa.RecordBatch.from_arrays([*cells, pa.array(total.ravel())], ["i", "j", "s"])

    cells = rows.select("x").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    found = cells.toPandas()  # (1 + components)^2 or (1 + dim)^2 numbers
    out = np.zeros((int(found["i"].max()) + 1,) * 2) if len(found) else np.zeros((1, 1))
    out[found["i"], found["j"]] = found["s"]
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a Householder reduction: the same eigenvalues."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0:
            continue
        x[0] += math.copysign(size, x[0])
        x /= np.linalg.norm(x)
        a[k + 1 :, k:] -= 2.0 * np.outer(x, x @ a[k + 1 :, k:])
        a[:, k + 1 :] -= 2.0 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: the positive pivots of the shifted tridiagonal form."""
    tiny = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def intervals(diagonal: np.ndarray, off: np.ndarray, wanted: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Disjoint ``(lo, hi, count)`` from the top, together at least ``wanted``
    eigenvalues (fewer if there are fewer above rounding).

    An end between two eigenvalues is the middle of the shifts that
    bisection could not tell apart from them, so both keep their distance;
    eigenvalues that no double tells apart stay in one interval.
    """
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    top = float((diagonal + reach).max())
    floor_ = LEAST_SHARE * float(diagonal.sum())
    whole = inertia_above(diagonal, off, floor_)

    def edge(k: int) -> tuple[float, float]:
        """Bounds, tight to rounding, of the k-th largest eigenvalue."""
        lo, hi = 0.0 if floor_ <= 0 else floor_, top * (1 + 1e-12) + np.finfo(float).tiny
        for _ in range(200):
            mid = 0.5 * (lo + hi)
            if mid in (lo, hi):
                break
            lo, hi = (mid, hi) if inertia_above(diagonal, off, mid) >= k else (lo, mid)
        return lo, hi

    out: list[tuple[float, float, int]] = []
    done, upper = 0, top * (1 + 1e-6) + np.finfo(float).tiny
    while done < min(wanted, whole):
        # The widest gap below this interval's eigenvalues: its lower end.
        last = min(done + per, whole)
        marks = [edge(k) for k in range(done + 1, min(last + 1, whole) + 1)]
        if last == whole:
            marks.append((floor_ * 0.5, floor_ * 0.5))
        least = max(1, min(wanted, whole) - done) if done + per >= min(wanted, whole) else 1
        gaps = [(marks[i][0] - marks[i + 1][1], i) for i in range(len(marks) - 1) if i + 1 >= least or i + 1 == len(marks) - 1]
        gap, i = max(gaps)
        if gap <= 1e-9 * top and last < whole:  # a cluster: let it grow
            return intervals(diagonal, off, wanted, 2 * per)
        lower = 0.5 * (marks[i][0] + marks[i + 1][1])
        out.append((lower, upper, inertia_above(diagonal, off, lower) - done))
        done, upper = inertia_above(diagonal, off, lower), lower
    return out


def _contour_pass(spark: SparkSession, v: np.ndarray, bases: list[np.ndarray], spans: list, points: int) -> list[np.ndarray]:
    """One filtered basis per interval: the quadrature sum of complex solves,
    one Spark row for each (interval, point)."""
    nodes, weights = np.polynomial.legendre.leggauss(points)
    d = len(v)

    def run(batches):
        for batch in batches:
            for which, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lo, hi, _ = spans[which]
                middle, radius = 0.5 * (lo + hi), 0.5 * (hi - lo)
                angle = -0.5 * np.pi * (nodes[k] - 1.0)
                turn = radius * np.exp(1j * angle)
                shifted = (middle + turn) * np.eye(d) - v
                part = 0.5 * weights[k] * np.real(turn * np.linalg.solve(shifted, bases[which].astype(complex)))
                blob = pa.array([np.ascontiguousarray(part).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([k], pa.int32()), blob], ["which", "point", "part"])

    tasks = spark.range(len(spans) * points).repartition(min(16, len(spans) * points))
    tasks = tasks.select((F.col("id") / points).cast("int").alias("which"), (F.col("id") % points).cast("int").alias("point"))
    out = [np.zeros_like(b) for b in bases]
    # In a fixed order, so that reruns agree to the last bit.
    for r in sorted(tasks.mapInArrow(run, "which int, point int, part binary").collect(), key=lambda r: (r["which"], r["point"])):
        out[r["which"]] += np.frombuffer(r["part"]).reshape(out[r["which"]].shape)
    return out


def feast(spark: SparkSession, v: np.ndarray, wanted: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of the symmetric ``v``, falling, and
    their unit vectors as columns; fewer where the others are rounding."""
    d = len(v)
    scale = float(np.abs(v).max(initial=0.0))
    if scale == 0.0 or d == 0:
        return np.zeros(0), np.zeros((d, 0))
    w = v / scale
    spans = intervals(*tridiagonal(w), wanted)
    if not spans:
        return np.zeros(0), np.zeros((d, 0))
    rng = np.random.default_rng(d)
    # Half as many columns again as eigenvalues: neighbours outside fade with every pass.
    bases = [np.linalg.qr(rng.standard_normal((d, min(d, math.ceil(1.5 * n) + 4))))[0] for _, _, n in spans]
    for _ in range(ROUNDS):
        filtered = _contour_pass(spark, w, bases, spans, points)
        found, worst = [], 0.0
        for j, (lo, hi, n) in enumerate(spans):
            left, size, _ = np.linalg.svd(filtered[j], full_matrices=False)
            basis = left[:, size > 1e-13 * size[0]]
            values, inner = np.linalg.eigh(basis.T @ w @ basis)  # Rayleigh-Ritz, a few columns
            ritz = basis @ inner
            inside = (values > lo) & (values < hi)
            rest = np.linalg.norm(w @ ritz[:, inside] - ritz[:, inside] * values[inside], axis=0)
            worst = max([worst, *rest]) if inside.sum() == n else math.inf
            found.append((values[inside], ritz[:, inside]))
            bases[j] = ritz if ritz.shape[1] else bases[j]
        if worst <= 1e-14 * d:
            break
    else:
        raise RuntimeError(f"contour integration did not converge: residual {worst:.1e}, counts {[n for *_, n in spans]}")
    values, columns = np.concatenate([a for a, _ in found]), np.hstack([b for _, b in found])
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * scale, columns[:, order] / np.linalg.norm(columns[:, order], axis=0)


def _whiten(rows: DataFrame, dim: int, wanted: int) -> DataFrame | None:
    """Whitened rows of the vectors of one length; None without a component."""
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit = written(rows.select("x").distinct())
    n = fit.count()
    sums = [int(r["s"]) for r in fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()]
    mean = np.array([s // n + (s % n) / n for s in sums])
    moments = products(fit, dim, lambda x: x - mean)
    drift = moments[0, 1:] / n  # rounding of the mean
    v = moments[1:, 1:] / n - np.outer(drift, drift)
    v = 0.5 * (v + v.T)
    values, axes = feast(spark, v, min(wanted, dim))
    if not len(values):
        return None
    explained = values / np.trace(v)
    scaled = axes / np.sqrt(values)
    second = products(fit, dim, lambda x: (x - mean) @ scaled)
    middle = second[0, 1:] / n
    error = float(np.abs(second[1:, 1:] / n - np.outer(middle, middle) - np.eye(len(values))).max())
    k = len(values)
    exact = np.array(sums, object)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dim)
            white = (x - mean) @ scaled
            far = n * float(np.abs(x).max(initial=0)) + float(max(abs(s) for s in sums))
            if dim * far * far < 2.0**62:
                deviation = ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
            else:  # beyond 64 bits: whole numbers of any size
                deviation = [int(s) for s in ((n * x.astype(object) - exact) ** 2).sum(1)]
            at = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array([str(deviation[i]) for i in at]),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                ],
                ["vec_id", "component", "deviation", "whitened", "explained"],
            )

    schema = f"vec_id {kind}, component int, deviation string, whitened double, explained double"
    out = rows.mapInArrow(run, schema)
    return out.withColumns({"n": F.lit(n).cast("long"), "identity_error": F.lit(error)})


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row of ``vectors`` and component: ``vec_id, component,
    n, deviation, whitened, explained, identity_error``.

    Entries become ``floor(256 c)``; the fit list holds each distinct vector
    once (``n`` of them).  ``whitened`` is the projection of the centred
    vector on the unit eigenvector over the root of its eigenvalue,
    ``deviation`` the exact squared distance from the mean times ``n``
    squared, as text (whole numbers of any size), ``identity_error`` how far
    the whitened covariance is from the identity.  Rows whose vector is
    null, empty or holds null or non-finite entries are left out; rows that
    repeat an id or a vector have rows of their own; vectors of another
    length are a list of their own; components whose eigenvalue is rounding
    (fewer distinct vectors than components) have no rows, so that one
    vector alone or an empty table gives an empty result.  Other columns
    are not read.
    """
    rows = written(usable(vectors, id_col, vector_col))
    lengths = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())
    parts = [_whiten(rows.where(F.size("x") == dim), dim, components) for dim in lengths]
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    out = None
    for part in parts:
        if part is not None:
            part = part.select(*columns)
            out = part if out is None else out.union(part)
    if out is not None:
        return out
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation string, whitened double, explained double, identity_error double"
    return rows.sparkSession.createDataFrame([], schema)
