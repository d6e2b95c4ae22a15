"""Applying a fitted tree: two-way split of a frame and per-leaf statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col, require_free_output
from ..functions.predicates import split_predicate
from ..operators.ordering import restore_order, with_row_index
from ..session import small_frame
from .tree import TreeModel


def split_left_right(model: TreeModel, df: DataFrame, node_id: int = 1, output_col: str = "side") -> DataFrame:
    """Tag every row with the side of ``node_id``'s split it goes to.

    The frame is never physically split: one ``side`` column holds
    ``'left'`` or ``'right'``; filter on it for the two frames.  Reference
    semantics drop rows whose test is NULL (they go to neither side).
    """
    require_free_output(df, output_col)
    node = model.nodes[node_id]
    if not node.is_split:
        raise ValueError(f"node {node_id} is a leaf")
    p = split_predicate(node.feature, node.kind, node.threshold, node.category, model.reference)
    if model.reference:
        side = F.when(p, F.lit("left")).when(~p, F.lit("right"))
        return df.withColumn(output_col, side).where(F.col(output_col).isNotNull())
    return df.withColumn(output_col, F.when(p, F.lit("left")).otherwise(F.lit("right")))


_LEAF_SCHEMA = T.StructType(
    [T.StructField("node_id", T.LongType()), T.StructField("label", T.StringType()), T.StructField("rule", T.StringType())]
)


def leaf_label_mix(model: TreeModel, df: DataFrame) -> DataFrame:
    """``(node_id, actual, cnt)``: how many rows of each actual label reach a
    leaf.  Rows are routed map-side and counted with map-side combine."""
    routed = model.leaf_assignment(df, "__arb_leaf_id").select(
        F.col("__arb_leaf_id").alias("node_id"), col(model.label).cast("string").alias("actual")
    )
    return routed.groupBy("node_id", "actual").agg(F.count(F.lit(1)).alias("cnt"))


def leaf_rule_stats(model: TreeModel, df: DataFrame) -> DataFrame:
    """Per leaf: its path rule, label, rows reaching it and rows it labels
    correctly.  A leaf that no row reaches is listed with 0 rows."""
    table = small_frame(df.sparkSession, [(n.node_id, n.label, n.rule) for n in model.leaves()], _LEAF_SCHEMA)
    hit = F.when(F.col("actual") == F.col("label"), F.col("cnt")).otherwise(F.lit(0))
    return (
        table.join(leaf_label_mix(model, df), "node_id", "left")
        .groupBy("node_id", "rule", "label")
        .agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n_rows"), F.sum(F.coalesce(hit, F.lit(0))).alias("n_correct"))
        .select("node_id", "rule", "label", "n_rows", "n_correct")
    )


def predict_indexed(model: TreeModel, df: DataFrame, *order, output_col: str = "PREDICTED_LABEL",
                    index_col: str = "row_index") -> DataFrame:
    """Predictions with the row number 0..n-1 of every row, in that order.

    Rows are numbered in the given order (in the order of the scan without
    one), labelled by a projection, and sorted back by number, so that the
    output stands as the input did whatever happened in between.  Reference
    semantics drop rows without a leaf; the others keep their numbers.
    """
    numbered = with_row_index(df, *order, name=index_col)
    return restore_order(model.predict(numbered, output_col), index_col, drop=False)


_BOX_SCHEMA = "node_id long, parent_id long, is_leaf boolean, feature string, kind string, threshold double, category string, n_rows long"


def leaf_boxes(node_table: DataFrame) -> DataFrame:
    """``(node_id, feature, kind, lo, hi, category, excluded, n_rows)``: the box
    of every leaf, one row per feature on its path.

    Ordinal: ``lo <= value < hi`` (null: open; reference semantics ``lo <
    value <= hi``).  Categorical: the one ``category`` it must have, or the
    ``excluded`` ones in order.  A missing value meets no ``>=`` and no
    ``=``, so it stays in a leaf whose ``lo`` and ``category`` are null.
    The tests of a path meet by joins on the node table: a leaf's
    ancestors are its heap id shifted right, and the side taken is the bit
    shifted out.  Features that no test names are unbounded and not listed.
    """
    nodes = node_table.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(_BOX_SCHEMA).fields])
    leaves = nodes.where("is_leaf").select("node_id", "n_rows")
    depth = F.floor(F.log2(F.col("node_id"))).cast("int")
    up = leaves.where("node_id > 1").withColumn("step", F.explode(F.sequence(F.lit(0), depth - 1)))
    path = up.select(
        "node_id", "n_rows",
        F.expr("shiftright(node_id, step + 1)").alias("at"),
        (F.expr("shiftright(node_id, step)") % 2 == 0).alias("left"),
    )
    tests = nodes.where("NOT is_leaf").select(F.col("node_id").alias("at"), "feature", "kind", "threshold", "category")
    joined = path.join(tests, "at")
    left = F.col("left")
    return (
        joined.groupBy("node_id", "feature", "kind", "n_rows")
        .agg(
            F.max(F.when(left, F.col("threshold"))).alias("lo"),
            F.min(F.when(~left, F.col("threshold"))).alias("hi"),
            F.max(F.when(left, F.col("category"))).alias("category"),
            F.array_sort(F.collect_set(F.when(~left, F.col("category")))).alias("excluded"),
        )
        .select(
            "node_id", "feature", "kind", "lo", "hi", "category",
            F.when(F.col("category").isNull() & (F.size("excluded") > 0), F.array_join("excluded", ",")).alias("excluded"), "n_rows",
        )
    )
