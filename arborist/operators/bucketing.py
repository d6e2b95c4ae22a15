"""Rare-category bucketing of string columns.

A value of a string column is kept when it occurs at least
``min_leaf_size`` times and is among the ``max_cardinality`` most frequent
such values of its column (ties: smaller value first).  Every other value,
and NULL, becomes ``FILLER_STRING``.  A column with no kept value at all
is dropped.

All string columns are counted in one job: the columns are melted into
``(column, value)`` pairs and aggregated once (map-side combined, so a hot
value costs one row per task).  The top-k per column is a ``row_number``
filter, which Spark plans with a partial ``WindowGroupLimit`` before the
shuffle: no task ever holds more than k rows per column per input
partition.  The keep-lists (at most cap x columns values) are the only
data brought to the driver; they become literal ``IN`` lists of one
projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col, feature_kinds, require_columns
from ..session import small_frame
from ..settings import CATEGORICAL, FILLER_STRING, TreeSettings


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def melt_strings(df: DataFrame, columns) -> DataFrame:
    """``(column, value)`` long format of the given string columns."""
    pairs = []
    for c in columns:
        pairs += [F.lit(c), col(c)]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("column", "value"))


def category_counts(df: DataFrame, columns=None) -> DataFrame:
    """Non-null count of every value of every string column: ``(column, value, n)``."""
    columns = string_columns(df) if columns is None else list(columns)
    require_columns(df, columns)
    return (
        melt_strings(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("value").alias("n"))
    )


def top_categories(df: DataFrame, columns=None, min_count: int = 32, max_cardinality: int = 6) -> DataFrame:
    """Kept values per column: ``(column, value, n, rank)``, rank 1 = most frequent."""
    counts = category_counts(df, columns).where(F.col("n") >= F.lit(int(min_count)))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(int(max_cardinality)))


def keep_lists(df: DataFrame, columns, settings: TreeSettings) -> dict[str, list[str]]:
    """Collect the keep-list of every column (bounded by cap x columns rows)."""
    columns = list(columns)
    if not columns:
        return {}
    rows = top_categories(df, columns, settings.min_leaf_size, settings.max_cardinality).collect()
    keep = {c: [] for c in columns}
    for r in sorted(rows, key=lambda r: (r["column"], r["rank"])):
        keep[r["column"]].append(r["value"])
    return keep


def droppable_columns(df: DataFrame, columns=None, settings: TreeSettings | None = None) -> DataFrame:
    """``(column)``: string columns without any value frequent enough to keep."""
    settings = settings or TreeSettings()
    columns = string_columns(df) if columns is None else list(columns)
    schema = T.StructType([T.StructField("column", T.StringType())])
    kept = top_categories(df, columns, settings.min_leaf_size, settings.max_cardinality).select("column").distinct()
    return small_frame(df.sparkSession, [(c,) for c in columns], schema).join(kept, "column", "left_anti")


def apply_keep_lists(df: DataFrame, keep: dict[str, list[str]]) -> DataFrame:
    """One projection: kept values stay, everything else (NULL too) becomes the sentinel;
    columns with an empty keep-list are dropped."""
    out = []
    for name in df.columns:
        if name not in keep:
            out.append(col(name))
        elif keep[name]:
            c = col(name)
            out.append(F.when(c.isin(keep[name]), c).otherwise(F.lit(FILLER_STRING)).alias(name))
    return df.select(*out)


def bucket_rare_categories(df: DataFrame, settings: TreeSettings | None = None, columns=None, exclude=()) -> DataFrame:
    """Bucket every string column (or the given ones) of ``df``."""
    settings = settings or TreeSettings()
    columns = string_columns(df) if columns is None else list(columns)
    columns = [c for c in columns if c not in set(exclude)]
    return apply_keep_lists(df, keep_lists(df, columns, settings))


def prepare_frame(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None, persist=None):
    """Select label + features, bucket categorical features.

    Returns ``(frame, kinds, keep)``: the prepared frame (label cast to
    string), the kind of every surviving feature and the keep-lists used.
    Reference semantics bucket with default settings and also bucket a
    string label (a label without frequent values is an error there).
    Rows without a label are dropped, or an error with ``null_label="error"``.
    ``persist``, when given, is applied to the column-pruned input before
    the keep-lists are counted, so that the raw input is read only once.
    """
    settings = settings or TreeSettings()
    kinds = feature_kinds(df, label, features)
    label_is_string = isinstance(df.schema[label].dataType, T.StringType)
    frame = df.select(col(label), *[col(f) for f in kinds])
    if settings.null_label == "error" and not frame.where(col(label).isNull()).isEmpty():
        raise ValueError(f"label column {label!r} has null values")
    frame = frame.where(col(label).isNotNull())
    if persist is not None:
        frame = persist(frame)
    to_bucket = [f for f, k in kinds.items() if k == CATEGORICAL]
    if settings.reference and label_is_string:
        to_bucket.append(label)
    keep = keep_lists(frame, to_bucket, settings.bucketing_settings())
    if settings.reference and label_is_string and not keep.get(label):
        raise ValueError(f"label column {label!r} has no frequent value and would be dropped")
    frame = apply_keep_lists(frame, keep)
    kinds = {f: k for f, k in kinds.items() if f in frame.columns}
    frame = frame.withColumn(label, col(label).cast("string"))
    return frame, kinds, keep
