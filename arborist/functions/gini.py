"""Gini impurity as column expressions over integer count sums.

For a side with per-label counts c_y and total T the impurity is
``1 - sum(c_y^2) / T^2``; the score of a split is the size-weighted mean of
its two sides, ``(G_L*T_L + G_R*T_R) / (T_L + T_R)``, which equals
``1 - (S_L/T_L + S_R/T_R) / (T_L + T_R)`` with ``S = sum(c_y^2)``.

Squares are summed as ``decimal(38,0)`` (exact, order independent, no
bigint overflow under ANSI) and turned into doubles only for the division.
A side with no rows has no impurity: the division yields NULL (ANSI mode
would raise on 0/0), so such a candidate sorts after every real one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SQUARE_TYPE = "decimal(38,0)"


def square(count: Column) -> Column:
    c = count.cast(SQUARE_TYPE)
    return c * c


def side_gini(sum_sq: Column, total: Column) -> Column:
    """Impurity of one side: ``1 - S/T^2`` (NULL for an empty side)."""
    t = total.cast("double")
    return F.lit(1.0) - F.try_divide(sum_sq.cast("double"), t * t)


def weighted_gini(sum_sq_left: Column, n_left: Column, sum_sq_right: Column, n_right: Column) -> Column:
    """Size-weighted child impurity of a split, NULL when a side is empty."""
    left = F.try_divide(sum_sq_left.cast("double"), n_left.cast("double"))
    right = F.try_divide(sum_sq_right.cast("double"), n_right.cast("double"))
    n = (n_left + n_right).cast("double")
    return F.lit(1.0) - F.try_divide(left + right, n)


def tied_gini(gini: Column, multiplicity: Column) -> Column:
    """Score a threshold shared by ``m`` grid quantiles receives when each
    quantile is counted separately: ``1 - (1 - G) / m``."""
    return F.lit(1.0) - (F.lit(1.0) - gini) / multiplicity.cast("double")
