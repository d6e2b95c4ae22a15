"""Split candidates and their weighted Gini impurity.

Candidates of a (node, feature):

* ordinal: one per distinct threshold t_i; left = rows with ``v >= t_i``,
  i.e. bucket >= i.  The left count of (i, label) is the sum of the
  histogram rows with bucket >= i.
* categorical: one per kept category c (never the sentinel); left =
  rows with ``v = c``, right = every other row of the node, sentinel rows
  included.

Right-hand label counts are never materialised per label.  With label
totals ``a_y`` of the node, ``T_R = sum(a) - T_L`` and
``S_R = sum((a_y - l_y)^2) = sum(a^2) - 2*sum(a_y*l_y) + S_L``, where the
sums over ``l`` only run over labels that have left rows.  So the scoring
works on the sparse histogram and never builds a value x label grid.

Consistent semantics use all rows of the node as the label totals, so a
NULL numeric value counts on the right side, where routing sends it.
Reference semantics leave NULL numeric values out of both sides and
score a threshold shared by m grid quantiles as the original learner's
per-quantile union does: score ``1 - (1 - G)/m``, side sizes times m.

Every frame here is bounded by nodes x features x (quantiles +
categories) x labels rows, independent of the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.gini import SQUARE_TYPE, side_gini, square, tied_gini, weighted_gini
from ..session import maybe_broadcast, persisted, small_frame
from ..settings import CATEGORICAL, FILLER_STRING, ORDINAL, TreeSettings
from .histogram import class_histogram, numeric_cells, threshold_column
from .thresholds import approx_quantiles, distinct_threshold_rows, exact_quantile_rows

CANDIDATE_KEYS = ["node_id", "feature", "kind", "idx", "category"]

THRESHOLD_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("feature", T.StringType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("mult", T.LongType()),
    ]
)


def split_order():
    """Total order of candidates: best score first (no score last), then
    feature name, then threshold / category ascending."""
    return [
        F.asc_nulls_last("child_gini"),
        F.asc("feature"),
        F.asc_nulls_last("threshold"),
        F.asc_nulls_last("category"),
    ]


def compute_thresholds(frame: DataFrame, ordinal, settings: TreeSettings) -> list:
    """Collect the distinct thresholds of every (node, ordinal feature).

    Returns rows ``(node_id, feature, idx, threshold, mult)``; at most
    nodes x features x quantiles of them, whatever the data size.
    """
    if not ordinal:
        return []
    cells = numeric_cells(frame, ordinal)
    if settings.threshold_mode == "approx":
        rows = approx_quantiles(cells, settings.quantiles, settings.approx_accuracy).select(
            "node_id", "feature", "q_index", "quantile", "threshold").collect()
    else:
        rows = exact_quantile_rows(cells, settings.quantiles)
    return distinct_threshold_rows(rows)


def thresholds_frames(spark: SparkSession, rows: list, ordinal, n_quantiles: int) -> tuple[DataFrame, DataFrame | None]:
    """Long ``(node_id, feature, idx, threshold, mult)`` and wide
    ``(node_id, __t<j>_<i>)`` frames of the collected thresholds."""
    long_df = small_frame(spark, rows, THRESHOLD_SCHEMA)
    if not ordinal:
        return long_df, None
    by_node: dict[int, dict[str, list]] = {}
    for node_id, feature, idx, threshold, _ in rows:
        by_node.setdefault(node_id, {}).setdefault(feature, []).append((idx, threshold))
    schema = T.StructType(
        [T.StructField("node_id", T.LongType())]
        + [
            T.StructField(threshold_column(j, i), T.DoubleType())
            for j in range(len(ordinal))
            for i in range(n_quantiles)
        ]
    )
    wide_rows = []
    for node_id, per in sorted(by_node.items()):
        values = []
        for f in ordinal:
            ts = [t for _, t in sorted(per.get(f, []), key=lambda r: r[0])]  # idx: unique, and NaN cannot be sorted
            values += ts + [None] * (n_quantiles - len(ts))
        wide_rows.append((node_id, *values))
    return long_df, small_frame(spark, wide_rows, schema)


def level_histogram(frame: DataFrame, label: str, kinds: dict, settings: TreeSettings, max_nodes: int,
                    freeze=persisted):
    """Thresholds jobs + counts job of one level.

    Returns ``(hist, thresholds_long, threshold_rows)``.  ``hist`` is
    computed in one pass over ``frame`` and passed through ``freeze``, so
    that its readers share that pass: persisted by default, and computed by
    the first of them (the caller unpersists it), ``reliable_checkpoint`` for results handed to a caller.
    It does not grow with the rows.  It is partitioned on (node, feature,
    label): neither a node nor a feature with many labels is one task.
    """
    ordinal = [f for f, k in kinds.items() if k == ORDINAL]
    rows = compute_thresholds(frame, ordinal, settings)
    long_df, wide_df = thresholds_frames(frame.sparkSession, rows, ordinal, len(settings.quantiles))
    hist = class_histogram(frame, label, kinds, wide_df, len(settings.quantiles), max_nodes)
    return freeze(hist.repartition("node_id", "feature", "label")), long_df, rows


def with_label_totals(hist: DataFrame, reference: bool) -> DataFrame:
    """Adds two totals of the row's label in its (node, feature): ``rows``, and
    ``base``, the pool a split's two sides are drawn from.  NULL numeric
    values are in both, except that reference semantics leave them out of
    ``base``."""
    non_null = (F.col("kind") == CATEGORICAL) | (F.col("bucket") >= 0)
    counted = F.when(non_null, F.col("cnt")).otherwise(F.lit(0)) if reference else F.col("cnt")
    label = Window.partitionBy("node_id", "feature", "label")
    return hist.withColumn("base", F.sum(counted).over(label)).withColumn("rows", F.sum("cnt").over(label))


def label_totals(hist: DataFrame, reference: bool) -> DataFrame:
    """``(node_id, feature, label, base, rows)``."""
    return (
        with_label_totals(hist, reference)
        .groupBy("node_id", "feature", "label")
        .agg(F.max("base").alias("base"), F.max("rows").alias("rows"))
    )


def left_counts(hist: DataFrame, reference: bool = False) -> DataFrame:
    """``(node_id, feature, kind, idx, category, label, l, base)``, only where l > 0.

    A histogram row of bucket b is on the left of every ordinal candidate
    i <= b; a row of kept category c is on the left of candidate c.
    """
    ordinal = (F.col("kind") == ORDINAL) & (F.col("bucket") >= 1)
    categorical = (F.col("kind") == CATEGORICAL) & (F.col("category") != F.lit(FILLER_STRING))
    candidates = (
        F.when(ordinal, F.sequence(F.lit(1), F.col("bucket")))
        .when(categorical, F.array(F.lit(None).cast("int")))
        .otherwise(F.array().cast("array<int>"))
    )
    return (
        with_label_totals(hist, reference)
        .select("node_id", "feature", "kind", "category", "label", "cnt", "base", F.explode(candidates).alias("idx"))
        .groupBy(*CANDIDATE_KEYS, "label")
        .agg(F.sum("cnt").alias("l"), F.max("base").alias("base"))
    )


def score_candidates(hist: DataFrame, thresholds: DataFrame, reference: bool = False,
                     threshold_rows: int | None = None) -> DataFrame:
    """All candidates of all (node, feature) groups of ``hist`` with their scores.

    Columns: node_id, feature, kind, selection, threshold, category,
    n_left, n_right, gini_left, gini_right, child_gini, and of the node
    n_rows and n_labels.  The sums per label
    run inside the partitions of ``hist``, as :func:`level_histogram`
    returns it; only partial sums per candidate move after that.
    ``threshold_rows`` is the number of threshold rows (they were collected
    on the driver); the threshold table is broadcast only when that count
    is known and small.
    """
    dec = SQUARE_TYPE
    group = label_totals(hist, reference).groupBy("node_id", "feature").agg(
        F.sum("base").alias("n_all"), F.sum(square(F.col("base"))).alias("sq_all"),
        F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_labels"),
    )
    sums = (
        left_counts(hist, reference)
        .groupBy(*CANDIDATE_KEYS)
        .agg(
            F.sum("l").alias("n_left"),
            F.sum(square(F.col("l"))).alias("sq_left"),
            F.sum(F.col("l").cast(dec) * F.col("base").cast(dec)).alias("cross"),
        )
        .join(group, ["node_id", "feature"])
        .withColumn("n_right", F.col("n_all") - F.col("n_left"))
        .withColumn("sq_right", (F.col("sq_all") - F.lit(2).cast(dec) * F.col("cross") + F.col("sq_left")).cast(dec))
        .join(_bounded(thresholds, threshold_rows), ["node_id", "feature", "idx"], "left")
        .withColumn("mult", F.when(F.col("kind") == ORDINAL, F.col("mult")).otherwise(F.lit(1)).cast("long"))
    )
    g_left = side_gini(F.col("sq_left"), F.col("n_left"))
    g_right = side_gini(F.col("sq_right"), F.col("n_right"))
    child = weighted_gini(F.col("sq_left"), F.col("n_left"), F.col("sq_right"), F.col("n_right"))
    n_left, n_right = F.col("n_left"), F.col("n_right")
    if reference:
        m = F.col("mult")
        g_left, g_right, child = tied_gini(g_left, m), tied_gini(g_right, m), tied_gini(child, m)
        n_left, n_right = n_left * m, n_right * m
    selection = F.when(F.col("kind") == ORDINAL, F.col("threshold").cast("string")).otherwise(F.col("category"))
    return sums.select(
        "node_id",
        "feature",
        "kind",
        selection.alias("selection"),
        "threshold",
        "category",
        n_left.cast("long").alias("n_left"),
        n_right.cast("long").alias("n_right"),
        g_left.alias("gini_left"),
        g_right.alias("gini_right"),
        child.alias("child_gini"),
        "n_rows",
        "n_labels",
    )


def best_per(candidates: DataFrame, keys) -> DataFrame:
    """Top candidate per key group (``row_number() = 1`` under the total order)."""
    w = Window.partitionBy(*keys).orderBy(*split_order())
    return candidates.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def best_per_node(candidates: DataFrame) -> DataFrame:
    """The candidate with a score that is first in :func:`split_order`, per
    node: one map-side combined aggregation.  (A feature has either
    thresholds or categories, so nulls never meet.)"""
    order = ["child_gini", "feature", "threshold", "category"]
    rest = [c for c in candidates.columns if c not in ("node_id", *order)]
    first = F.min(F.struct(*order, *rest)).alias("best")
    return candidates.where(F.col("child_gini").isNotNull()).groupBy("node_id").agg(first).select("node_id", "best.*")


def _bounded(thresholds: DataFrame, rows: int | None) -> DataFrame:
    return maybe_broadcast(thresholds, rows) if rows is not None else thresholds


def side_counts(hist: DataFrame, thresholds: DataFrame, reference: bool = False,
                threshold_rows: int | None = None) -> DataFrame:
    """Per candidate and label of its (node, feature): ``cnt_in`` (left) and
    ``cnt_out`` (right).

    Every label of the group has a row for every candidate, also without
    left rows: candidates (at most one per quantile or kept category) are
    joined to the group's label totals on (node, feature).
    """
    left = left_counts(hist, reference)
    candidates = left.select(*CANDIDATE_KEYS).distinct()
    totals = label_totals(hist, reference).where("base > 0")
    keys = [F.col(f"c.{k}").eqNullSafe(F.col(f"l.{k}")) for k in (*CANDIDATE_KEYS, "label")]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    return (
        candidates.join(totals, ["node_id", "feature"])
        .alias("c")
        .join(left.select(*CANDIDATE_KEYS, "label", "l").alias("l"), on, "left")
        .select(*[F.col(f"c.{k}").alias(k) for k in CANDIDATE_KEYS], F.col("c.label").alias("label"),
                F.coalesce("l.l", F.lit(0)).cast("long").alias("cnt_in"), F.col("c.base").alias("base"))
        .join(_bounded(thresholds.select("node_id", "feature", "idx", "threshold"), threshold_rows),
              ["node_id", "feature", "idx"], "left")
        .select("node_id", "feature", "kind", "threshold", "category", "label", "cnt_in",
                (F.col("base") - F.col("cnt_in")).alias("cnt_out"))
    )
