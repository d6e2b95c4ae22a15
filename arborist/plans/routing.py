"""Routing rows to tree nodes, for trees of any size.

Small trees route with one nested ``CASE WHEN`` expression (one test per
level per row, inside whole-stage codegen).  Its size grows with the
number of split nodes, so a tree with more than
``EXPRESSION_MAX_SPLITS`` splits routes instead level by level: the splits
of one depth (node id -> feature, test, children) are joined on the row's
current node, and a ``CASE`` over the *features* (not the nodes) applies
the test.  A depth with many splits is joined in batches that always fit a
broadcast, so both forms are map-only: the scored table is never shuffled
on a node id, whatever the size of the tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col
from ..functions.predicates import route, split_predicate
from ..session import batches, small_frame
from ..settings import ORDINAL

EXPRESSION_MAX_SPLITS = 128

_SPLIT_SCHEMA = T.StructType(
    [
        T.StructField("__arb_node", T.LongType()),
        T.StructField("__arb_feature", T.IntegerType()),
        T.StructField("__arb_ordinal", T.BooleanType()),
        T.StructField("__arb_threshold", T.DoubleType()),
        T.StructField("__arb_category", T.StringType()),
        T.StructField("__arb_left", T.LongType()),
        T.StructField("__arb_right", T.LongType()),
    ]
)
_LEAF_SCHEMA = T.StructType([T.StructField("__arb_leaf", T.LongType()), T.StructField("__arb_label", T.StringType())])


def _splits(nodes: dict) -> list:
    return [n for n in nodes.values() if n.is_split]


def use_joins(nodes: dict, force: bool | None = None) -> bool:
    return force if force is not None else len(_splits(nodes)) > EXPRESSION_MAX_SPLITS


def assign_leaves(df: DataFrame, nodes: dict, reference: bool, output_col: str = "node_id",
                  joins: bool | None = None, start: int | None = None, codes: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` plus ``output_col``: the id of the node that is not split where
    each row ends (NULL when reference routing loses the row).  With
    ``start``, ``df`` already has ``output_col`` as of that depth, and only
    the splits from there on are applied.  With ``codes`` (and ``start``),
    ``df`` holds a category as its number from 1 in its feature's list."""
    if start is None and not use_joins(nodes, joins):
        return df.withColumn(output_col, route(nodes, lambda n: F.lit(n.node_id).cast("long"), reference))
    splits = sorted(_splits(nodes), key=lambda n: (n.depth, n.node_id))
    if start is not None:
        splits = [n for n in splits if n.depth >= start]
        if not splits:
            return df
    if not splits:
        return df.withColumn(output_col, F.lit(1).cast("long"))
    features = sorted({n.feature for n in splits})
    index = {f: i for i, f in enumerate(features)}
    kinds = {n.feature: n.kind for n in splits}
    f_idx = F.col("__arb_feature")
    num = F.lit(None).cast("double")
    cat = F.lit(None).cast("string")
    for f in features:
        if kinds[f] == ORDINAL or codes is not None:
            num = F.when(f_idx == index[f], col(f).cast("double")).otherwise(num)
        else:
            cat = F.when(f_idx == index[f], col(f)).otherwise(cat)
    threshold = F.col("__arb_threshold")
    ordinal_test = num > threshold if reference else num >= threshold
    equal = cat == F.col("__arb_category") if codes is None else num == threshold
    test = F.when(F.col("__arb_ordinal"), ordinal_test).otherwise(equal)

    def bound(n):
        return n.threshold if codes is None or n.kind == ORDINAL else float(codes[n.feature].index(n.category) + 1)

    current = F.col(output_col)
    moved = F.when(F.col("__arb_node").isNull(), current)
    moved = moved.when(test, F.col("__arb_left"))
    moved = moved.when(~test, F.col("__arb_right")) if reference else moved.otherwise(F.col("__arb_right"))

    if start is None:
        # Every row starts at the root: its split needs no join.
        root = splits[0]
        first = split_predicate(root.feature, root.kind, root.threshold, root.category, reference)
        at = F.when(first, F.lit(root.left_id))
        at = at.when(~first, F.lit(root.right_id)) if reference else at.otherwise(F.lit(root.right_id))
        out, from_depth = df.withColumn(output_col, at.cast("long")), 1
    else:
        out, from_depth = df, start
    for depth in range(from_depth, splits[-1].depth + 1):
        rows = [
            (n.node_id, index[n.feature], n.kind == ORDINAL, bound(n), n.category, n.left_id, n.right_id)
            for n in splits if n.depth == depth
        ]
        # A row moved by one batch is at a child, which no other batch of this depth has.
        for batch in batches(rows, len(_SPLIT_SCHEMA)):
            table = F.broadcast(small_frame(df.sparkSession, batch, _SPLIT_SCHEMA))
            out = (
                out.join(table, current == F.col("__arb_node"), "left")
                .withColumn(output_col, moved)
                .drop(*_SPLIT_SCHEMA.fieldNames())
            )
    return out


def assign_labels(df: DataFrame, nodes: dict, reference: bool, output_col: str,
                  joins: bool | None = None) -> DataFrame:
    """``df`` plus the label of the leaf each row reaches.  Reference
    semantics drop the rows that reach no leaf."""
    if not use_joins(nodes, joins):
        if reference:
            df = df.where(route(nodes, lambda n: F.lit(n.node_id).cast("long"), reference).isNotNull())
        return df.withColumn(output_col, route(nodes, lambda n: F.lit(n.label).cast("string"), reference))
    leaves = sorted((n.node_id, n.label) for n in nodes.values() if not n.is_split)
    routed = assign_leaves(df, nodes, reference, "__arb_at", joins=True)
    if reference:
        routed = routed.where(F.col("__arb_at").isNotNull())
    routed = routed.withColumn(output_col, F.lit(None).cast("string"))
    for batch in batches(leaves, len(_LEAF_SCHEMA)):
        table = F.broadcast(small_frame(df.sparkSession, batch, _LEAF_SCHEMA))
        routed = (
            routed.join(table, F.col("__arb_at") == F.col("__arb_leaf"), "left")
            .withColumn(output_col, F.coalesce("__arb_label", output_col))
            .drop("__arb_leaf", "__arb_label")
        )
    return routed.drop("__arb_at")
