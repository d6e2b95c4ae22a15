"""Gini classification trees learned and applied with Spark DataFrame jobs."""

from .operators.bucketing import bucket_rare_categories, category_counts, prepare_frame, top_categories
from .operators.thresholds import approx_quantiles, exact_quantiles
from .plans.columns import (
    best_categorical_split,
    best_ordinal_split,
    best_split_per_column,
    candidate_splits,
    in_out_counts,
    informative_columns,
    rank_columns_by_gini,
)
from .plans.scoring import leaf_rule_stats, split_left_right
from .plans.tree import Node, TreeModel, fit
from .settings import FILLER_STRING, QUANTILES, TreeSettings
from .streaming.scoring import score_stream

__all__ = [
    "FILLER_STRING",
    "QUANTILES",
    "Node",
    "TreeModel",
    "TreeSettings",
    "approx_quantiles",
    "best_categorical_split",
    "best_ordinal_split",
    "best_split_per_column",
    "bucket_rare_categories",
    "candidate_splits",
    "category_counts",
    "exact_quantiles",
    "fit",
    "in_out_counts",
    "informative_columns",
    "leaf_rule_stats",
    "prepare_frame",
    "rank_columns_by_gini",
    "score_stream",
    "split_left_right",
    "top_categories",
]
