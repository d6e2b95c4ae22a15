"""Long-format class histograms of features.

Every row of a node contributes one cell per feature.  An ordinal cell
carries the row's *bucket*: how many of the node's sorted distinct
thresholds the value reaches with ``>=`` (0..k), or -1 for NULL.  A
categorical cell carries the (bucketed) category.  One aggregation over
``(node_id, feature, kind, bucket, category, label)`` then yields every
count the scoring needs, for all features and all nodes of a level at
once.  The aggregation is map-side combined, so its shuffle is bounded by
nodes x features x (quantiles + categories) x labels per task, whatever
the number of rows and however skewed the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import col
from ..session import maybe_broadcast
from ..settings import ORDINAL

HIST_KEYS = ["node_id", "feature", "kind", "bucket", "category", "label"]


def numeric_cells(frame: DataFrame, ordinal_features) -> DataFrame:
    """``(node_id, feature, value double)`` for every ordinal feature."""
    pairs = []
    for f in ordinal_features:
        pairs += [F.lit(f), col(f).cast("double")]
    return frame.select("node_id", F.stack(F.lit(len(ordinal_features)), *pairs).alias("feature", "value"))


def threshold_column(feature_index: int, q_index: int) -> str:
    return f"__t{feature_index}_{q_index}"


def bucket_expression(value, feature_index: int, n_quantiles: int):
    """Number of the node's sorted distinct thresholds ``<= value``; -1 for NULL.

    The thresholds are plain double columns (NULL past the last one), and
    the test runs from the highest down, so a row stops at its bucket.
    Array lookups here would keep the stage out of compiled code.
    """
    e = F.when(value.isNull(), F.lit(-1))
    for i in reversed(range(n_quantiles)):
        e = e.when(value >= F.col(threshold_column(feature_index, i)), F.lit(i + 1))
    return e.otherwise(F.lit(0))


def class_histogram(frame: DataFrame, label: str, kinds: dict[str, str], thresholds_wide: DataFrame | None,
                    n_quantiles: int, max_nodes: int) -> DataFrame:
    """``(node_id, feature, kind, bucket, category, label, cnt)``.

    ``frame`` has a ``node_id`` column and holds only the rows of the
    nodes being scored.  ``thresholds_wide`` is ``(node_id,
    __t<j>_<i> double)``: one row per node, threshold i of ordinal feature
    j (in ``kinds`` order).  It is joined on ``node_id`` and broadcast: the
    fit scores so many nodes at a time that it stays within the bounds.

    Buckets and categories are projected first and then melted with
    ``stack``; the aggregation is map-side combined.
    """
    ordinal = [f for f, k in kinds.items() if k == ORDINAL]
    if ordinal and thresholds_wide is not None:
        frame = frame.join(maybe_broadcast(thresholds_wide, max_nodes), "node_id", "left")
    projected, args = [F.col("node_id"), col(label).alias("label")], []
    for j, (f, k) in enumerate(kinds.items()):
        name = f"__v{j}"
        if k == ORDINAL:
            if thresholds_wide is None:
                b = F.when(col(f).isNull(), F.lit(-1)).otherwise(F.lit(0))
            else:
                b = bucket_expression(col(f).cast("double"), ordinal.index(f), n_quantiles)
            projected.append(b.cast("int").alias(name))
            args += [F.lit(f), F.lit(k), F.col(name), F.lit(None).cast("string")]
        else:
            projected.append(col(f).alias(name))
            args += [F.lit(f), F.lit(k), F.lit(None).cast("int"), F.col(name)]
    melted = frame.select(*projected).select(
        "node_id", "label", F.stack(F.lit(len(kinds)), *args).alias("feature", "kind", "bucket", "category")
    )
    return melted.groupBy(*HIST_KEYS).agg(F.count(F.lit(1)).alias("cnt"))
