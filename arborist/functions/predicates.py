"""Split predicates and routing expressions built from the node table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import ORDINAL
from .features import col


def value_column(name: str, kind: str) -> Column:
    """Feature value in the type its split compares: double or string."""
    c = col(name)
    return c.cast("double") if kind == ORDINAL else c


def split_predicate(feature: str, kind: str, threshold, category, reference: bool = False) -> Column:
    """Left-side test of a split.

    Ordinal: ``v >= t`` (reference semantics: ``v > t``, the routing test of
    the original learner, which scores with ``>=``).  Categorical: ``v = c``.
    Empty categories are valid.
    """
    if kind == ORDINAL:
        if threshold is None:
            raise ValueError(f"ordinal split on {feature!r} has no threshold")
        v = value_column(feature, kind)
        return v > F.lit(float(threshold)) if reference else v >= F.lit(float(threshold))
    if category is None:
        raise ValueError(f"categorical split on {feature!r} has no category")
    return col(feature) == F.lit(category)


def rule_text(feature: str, kind: str, threshold, category, left: bool, reference: bool = False) -> str:
    if kind == ORDINAL:
        op = (">" if reference else ">=") if left else ("<=" if reference else "<")
        return f"{feature} {op} {threshold!r}"
    op = "=" if left else "!="
    return f"{feature} {op} {category!r}"


def route(nodes: dict, leaf_value, reference: bool = False, node_id: int = 1) -> Column:
    """Nested ``CASE WHEN`` that walks a row from ``node_id`` to a node that
    is not split and returns ``leaf_value(node)`` for it.

    Each row evaluates one predicate per level (the expression is a binary
    tree of ``CASE`` nodes, not a flat list), so the cost per row is the
    depth, and the plan is one projection: no join, no shuffle.

    Consistent semantics send a NULL test result to the right child.
    Reference semantics test ``p`` and ``NOT p`` separately, so a NULL
    result reaches neither child and the expression yields NULL.
    """
    node = nodes[node_id]
    if not node.is_split:
        return leaf_value(node)
    p = split_predicate(node.feature, node.kind, node.threshold, node.category, reference)
    left = route(nodes, leaf_value, reference, node.left_id)
    right = route(nodes, leaf_value, reference, node.right_id)
    if reference:
        return F.when(p, left).when(~p, right)
    return F.when(p, left).otherwise(right)
