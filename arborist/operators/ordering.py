"""Row numbers 0..n-1 without a single-task sort, and frames back in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col, require_columns, require_free_output
from ..session import maybe_broadcast, reliable_checkpoint, small_frame

# monotonically_increasing_id: partition number above the position in it.
_POSITION_BITS = 33

_OFFSET_SCHEMA = T.StructType([T.StructField("__arb_part", T.LongType()), T.StructField("__arb_before", T.LongType())])


def with_row_index(df: DataFrame, *order, name: str = "row_index") -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, ... in the given order (column names or
    expressions), or in the order of the scan without one.

    The rows are range-sorted; ties keep the order of the scan, which also
    lets a value that many rows share be spread over tasks.  The sorted
    rows are written with their place in their partition, one number per
    partition reaches the driver, and the partitions' offsets are joined
    back by broadcast: no task sees more than its own range.
    """
    require_free_output(df, name)
    require_columns(df, [o for o in order if isinstance(o, str)])
    if order:
        keys = [col(o) if isinstance(o, str) else o for o in order]
        df = df.withColumn("__arb_scan", F.monotonically_increasing_id()).orderBy(*keys, "__arb_scan").drop("__arb_scan")
    placed = reliable_checkpoint(df.withColumn("__arb_at", F.monotonically_increasing_id()))
    part = F.shiftright("__arb_at", _POSITION_BITS)
    before, rows = 0, []
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part).count().collect()):
        rows.append((p, before))
        before += n
    offsets = maybe_broadcast(small_frame(df.sparkSession, rows, _OFFSET_SCHEMA), len(rows))
    position = F.col("__arb_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    out = placed.join(offsets, part == F.col("__arb_part"))
    return out.withColumn(name, F.col("__arb_before") + position).drop(*_OFFSET_SCHEMA.fieldNames(), "__arb_at")


def restore_order(df: DataFrame, name: str = "row_index", drop: bool = True) -> DataFrame:
    """``df`` range-sorted by the row number ``name``, which is dropped unless asked for."""
    require_columns(df, [name])
    out = df.orderBy(col(name))
    return out.drop(name) if drop else out
