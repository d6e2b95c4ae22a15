"""Most frequent label of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import col


def majority_label(df: DataFrame, keys, label: str) -> DataFrame:
    """``(keys..., label, cnt, n_rows)``: the label most rows of a group have
    (ties: the smallest), how many have it, and all rows of the group.

    Counted per (group, label) with map-side combine, so neither a large
    group nor a frequent label is held by one task.
    """
    keys = list(keys)
    counts = df.groupBy(*[col(k) for k in keys], col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__cnt"))
    top = counts.groupBy(*[col(k) for k in keys]).agg(
        F.min(F.struct((-F.col("__cnt")).alias("neg"), F.col("__label").alias("label"))).alias("__top"),
        F.sum("__cnt").alias("n_rows"),
    )
    return top.select(*[col(k) for k in keys], F.col("__top.label").alias("label"), (-F.col("__top.neg")).alias("cnt"), "n_rows")
