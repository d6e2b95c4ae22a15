"""Comparison of two frames as multisets, with a tolerance per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col, require_columns

LEFT_ONLY, RIGHT_ONLY, DIFFERS = "left_only", "right_only", "differs"


def _close(a, b, rtol: float, atol: float):
    """Equal, or within ``atol + rtol * |b|``; NaN and the infinities equal only themselves."""
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    finite = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) != float("inf")) & (F.abs(b) != float("inf"))
    return F.coalesce(a.eqNullSafe(b) | (finite & near), F.lit(False))


def frame_diff(left: DataFrame, right: DataFrame, keys, rtol: float = 1e-5, atol: float = 1e-8,
               tolerances: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Differences of ``left`` and ``right``: ``(<keys>, place, status, column,
    left_value, right_value)``, no row where they agree.

    Both must have the same columns.  Rows are paired by their keys; rows
    that share their keys are paired by their place in the order of the
    other columns.  Floating-point columns agree within ``rtol`` and
    ``atol`` (or the column's own ``(rtol, atol)`` in ``tolerances``), all
    others exactly; null agrees with null.  A row without a partner has
    one line with status ``left_only`` or ``right_only``, a pair one line
    for every column that differs, values as text.

    Rows that are equal on both sides cancel out first, in one map-side
    combined count over all columns, so that only what differs is ranked
    and joined, however many copies a row has.
    """
    keys = list(keys)
    require_columns(left, keys)
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"the frames have different columns: {sorted(set(left.columns) ^ set(right.columns))}")
    kinds = {f.name: f.dataType for f in left.schema.fields}
    other = {f.name: f.dataType for f in right.schema.fields}
    wrong = [c for c in kinds if kinds[c] != other[c]]
    if wrong:
        raise ValueError(f"columns of different types: {wrong}")
    tolerances = dict(tolerances or {})
    require_columns(left, list(tolerances))
    values = [c for c in left.columns if c not in keys]
    names = [*keys, *values]
    counts = (
        left.select(*[col(c) for c in names], F.lit(1).alias("__n"))
        .union(right.select(*[col(c) for c in names], F.lit(-1).alias("__n")))
        .groupBy(*[col(c) for c in names])
        .agg(F.sum("__n").alias("__n"))
        .where("__n <> 0")
    )
    # Copies that only one side has: one row each again.
    rest = counts.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.abs("__n").cast("int"))))
    rest = rest.withColumn("__left", F.col("__n") > 0)
    place = Window.partitionBy(*[col(c) for c in keys], "__left").orderBy(*[col(c) for c in values], "__copy")
    ranked = rest.withColumn("place", F.row_number().over(place) - 1)

    def side(is_left: bool, prefix: str) -> DataFrame:
        mine = ranked.where(F.col("__left") == is_left)
        return mine.select(*[col(c).alias(f"{prefix}{i}") for i, c in enumerate(names)], F.col("place").alias(f"{prefix}at"))

    a, b = side(True, "a"), side(False, "b")
    on = F.col("aat") == F.col("bat")
    for i in range(len(keys)):
        on = on & F.col(f"a{i}").eqNullSafe(F.col(f"b{i}"))
    lines = [F.when(F.col("bat").isNull(), _line(LEFT_ONLY)), F.when(F.col("aat").isNull(), _line(RIGHT_ONLY))]
    both = F.col("aat").isNotNull() & F.col("bat").isNotNull()
    for i, c in enumerate(names):
        if i < len(keys):
            continue
        x, y = F.col(f"a{i}"), F.col(f"b{i}")
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            r, t = tolerances.get(c, (rtol, atol))
            same = _close(x.cast("double"), y.cast("double"), r, t)
        else:
            same = x.eqNullSafe(y)
        lines.append(F.when(both & ~same, _line(DIFFERS, c, x, y)))
    lines = F.filter(F.array(*lines), lambda line: line.isNotNull())
    out = a.join(b, on, "full").select(
        *[F.coalesce(f"a{i}", f"b{i}").alias(c) for i, c in enumerate(keys)], F.coalesce("aat", "bat").alias("place"), F.inline(lines))
    return out


def _line(status: str, column: str | None = None, x=None, y=None):
    text = F.lit(None).cast("string")
    return F.struct(
        F.lit(status).alias("status"), F.lit(column).cast("string").alias("column"),
        (text if x is None else x.cast("string")).alias("left_value"), (text if y is None else y.cast("string")).alias("right_value"),
    )
