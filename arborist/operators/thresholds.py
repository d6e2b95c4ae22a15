"""Quantile thresholds of numeric features, per (node, feature).

Definition (exact mode): over the n non-null values of a group, sorted
ascending (NaN largest) and indexed from 0, the threshold for quantile q is
the value at rank ``floor((n-1)*q + 0.5)`` (nearest rank, ties away from
zero).

Distributed plan of the exact mode, the same at every size:

1. every value is put into a cell of a fixed, order-keeping scale (about
   3 % wide) and counted, with the cell's least and greatest value; the
   aggregation is map-side combined, so it shuffles cells, not values;
2. running counts over a group's cells say which cell holds each target
   rank.  A cell with one distinct value is the answer;
3. the others are cut into 2^20 equal parts, only their values are
   counted again, and so on.  Each pass leaves a small share of the rows
   and separates at least a cell's least from its greatest value.

A window holds the cells of one group (at most about 10^5) or the parts
of one cell (at most 2^20), whatever the number of rows or distinct
values.  What reaches the driver is at most one row per node, feature and
quantile.

The approximate mode is one ``percentile_approx`` aggregation (mergeable
sketches, partial aggregation), which is cheaper but not exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import batches, small_frame
from ..settings import QUANTILES

GROUP = ["node_id", "feature"]

# Scale of the first pass: cells per unit of the natural logarithm, and an
# offset of so many units that keeps all magnitudes of doubles above 0.
CELLS_PER_E = 32
MAGNITUDE_OFFSET = 750
OUTER = 1 << 20  # cells of the infinities; NaN is one further
PARTS = 1 << 20  # parts of a cell in the later passes

QUANTILE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("feature", T.StringType()),
        T.StructField("q_index", T.IntegerType()),
        T.StructField("quantile", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)
_OPEN_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("feature", T.StringType()),
        T.StructField("cell", T.LongType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("targets", T.ArrayType(T.StructType(
            [T.StructField("q_index", T.IntegerType()), T.StructField("rank", T.LongType())]
        ))),
    ]
)


def quantile_grid(quantiles) -> F.Column:
    return F.array(
        *[F.struct(F.lit(i).alias("q_index"), F.lit(float(q)).alias("quantile")) for i, q in enumerate(quantiles)]
    )


def nearest_rank(n: F.Column, quantile: F.Column) -> F.Column:
    """0-based rank ``floor((n-1)*q + 0.5)``; ``bround``/``rint`` round half
    to even and ``percentile`` interpolates, so neither fits."""
    return F.floor((n - F.lit(1)).cast("double") * quantile + F.lit(0.5)).cast("long")


def _scale(value: F.Column, per_e: int = CELLS_PER_E) -> F.Column:
    """Order-keeping cell of a value: equal steps of its logarithm, zero, the
    infinities and NaN in cells of their own (``per_e`` up to 700)."""
    size = F.floor(F.log(F.abs(value)) * per_e).cast("long") + MAGNITUDE_OFFSET * per_e
    infinite = F.abs(value) == float("inf")
    cell = F.when(F.isnan(value), OUTER + 1).when(infinite, OUTER).when(value == 0, 0).otherwise(size)
    return F.when((value < 0) & ~F.isnan(value), -cell).otherwise(cell).cast("long")


def _counted(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells with their counts and extremes, and the running count of their group (all keys but the last)."""
    counts = cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    group = Window.partitionBy(*keys[:-1])
    upto = group.orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("cum", F.sum("cnt").over(upto)).withColumn("n", F.sum("cnt").over(group))


def _same(a: float, b: float) -> bool:
    return a == b or (math.isnan(a) and math.isnan(b))


def exact_quantile_rows(cells: DataFrame, quantiles=QUANTILES) -> list[tuple]:
    """Collected rows ``(node_id, feature, q_index, quantile, threshold)`` of
    ``cells (node_id, feature, value double)``; groups without a value have
    none."""
    quantiles = tuple(float(q) for q in quantiles)
    cells = cells.where(F.col("value").isNotNull())
    spark = cells.sparkSession
    inside = (F.col("rank") >= F.col("cum") - F.col("cnt")) & (F.col("rank") < F.col("cum"))
    local = (F.col("rank") - (F.col("cum") - F.col("cnt"))).alias("rank")
    found = (
        _counted(cells.withColumn("cell", _scale(F.col("value"))), *GROUP, "cell")
        .select("*", F.inline(quantile_grid(quantiles)))
        .withColumn("rank", nearest_rank(F.col("n"), F.col("quantile")))
        .where(inside)
        .select(*GROUP, "q_index", local, "lo", "hi")
        .collect()
    )
    out = []
    while found:
        left: dict[tuple, list] = {}
        for r in found:
            if _same(r["lo"], r["hi"]):
                out.append((r["node_id"], r["feature"], r["q_index"], quantiles[r["q_index"]], r["lo"] + 0.0))
            else:
                left.setdefault((r["node_id"], r["feature"], r["lo"], r["hi"]), []).append((r["q_index"], r["rank"]))
        rows = [(n, f, i, lo, hi, targets) for i, ((n, f, lo, hi), targets) in enumerate(sorted(left.items()))]
        found = [r for batch in batches(rows, 6 * len(quantiles)) for r in _refine(spark, cells, batch, inside, local)]
    return out


def _refine(spark: SparkSession, cells: DataFrame, rows: list, inside, local) -> list:
    """One more pass over the values inside the open cells ``rows``."""
    opened = small_frame(spark, rows, _OPEN_SCHEMA)
    value, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    mine = F.broadcast(opened.select(*GROUP, "cell", "lo", "hi"))
    parts = (
        cells.join(mine, GROUP)
        .where((value >= lo) & (value <= hi))
        .withColumn("part", F.floor((value - lo) / (hi - lo) * PARTS).cast("long"))
        .select("cell", "part", "value")
    )
    targets = F.broadcast(opened.select(*GROUP, "cell", F.inline("targets")))
    return _counted(parts, "cell", "part").join(targets, "cell").where(inside).select(
        *GROUP, "q_index", local, "lo", "hi"
    ).collect()


def exact_quantiles(cells: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """Exact nearest-rank thresholds ``(node_id, feature, q_index, quantile,
    threshold)``: a tree-sized frame, computed when this is called."""
    return small_frame(cells.sparkSession, exact_quantile_rows(cells, quantiles), QUANTILE_SCHEMA)


def approx_quantiles(cells: DataFrame, quantiles=QUANTILES, accuracy: int = 10000) -> DataFrame:
    """``percentile_approx`` thresholds, same output schema as :func:`exact_quantiles`."""
    quantiles = [float(q) for q in quantiles]
    return (
        cells.where(F.col("value").isNotNull())
        .groupBy(*GROUP)
        .agg(F.percentile_approx("value", quantiles, accuracy).alias("t"))
        .select(*GROUP, F.posexplode("t").alias("q_index", "threshold"))
        .withColumn("quantile", F.array(*[F.lit(q) for q in quantiles])[F.col("q_index")])
        .select(*GROUP, "q_index", "quantile", "threshold")
    )


def distinct_threshold_rows(rows) -> list[tuple]:
    """Distinct thresholds per (node, feature) with their quantile
    multiplicity and 1-based position, from collected rows ``(node_id,
    feature, q_index, quantile, threshold)`` (tree-sized, in any order).

    Returns ``(node_id, feature, idx, threshold, mult)``; ``idx`` is the
    bucket a value reaches when it is ``>=`` this threshold and below the
    next one.  As in Spark, NaN equals itself and is the largest value.
    """
    mult: dict[tuple, dict[tuple, int]] = {}
    for node_id, feature, _, _, t in rows:
        key = (1, 0.0) if math.isnan(t) else (0, t + 0.0)
        per = mult.setdefault((node_id, feature), {})
        per[key] = per.get(key, 0) + 1
    out = []
    for (node_id, feature), per in sorted(mult.items()):
        for idx, key in enumerate(sorted(per), start=1):
            out.append((node_id, feature, idx, math.nan if key[0] else key[1], per[key]))
    return out
