"""Split search over every column of a frame (one node: the whole frame).

These are the building blocks of one tree level exposed on their own:
all candidates, the best split of each column, the columns ranked by
their best split, and the per-label in/out counts behind a score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import feature_kinds
from ..operators import cells
from ..operators.bucketing import prepare_frame
from ..operators.splits import THRESHOLD_SCHEMA, best_per, level_histogram, score_candidates, side_counts, split_order
from ..session import maybe_broadcast, persisted, reliable_checkpoint, small_frame, spread
from ..settings import CATEGORICAL, ORDINAL, TreeSettings


def root_histogram(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None):
    """Prepared frame as node 1: ``(hist, thresholds, kinds)``.

    The column-pruned input is persisted while the thresholds and the
    histogram are computed (one raw read) and released before returning.
    Thresholds and histogram come from one table of cells; rows are read
    again only in cells that hold a threshold and several values.  The
    histogram is written to the checkpoint folder, which is all the
    returned (lazy) frames read.
    """
    settings = settings or TreeSettings()
    exact = settings.threshold_mode == "exact"
    held: list = []

    def encode(selected: DataFrame) -> DataFrame:
        if exact:
            selected = cells.encoded(selected, feature_kinds(df, label, features))
        if settings.persist_input:
            held.append(persisted(spread(selected)))
            return held[0]
        return selected

    try:
        frame, kinds, keep = prepare_frame(df, label, features, settings, encode)
        frame = frame.withColumn("node_id", F.lit(1).cast("long"))
        if exact and kinds:
            hist, thresholds, rows = _from_cells(frame, cells.encoding(label, kinds, keep), settings, held)
        else:
            hist, thresholds, rows = level_histogram(frame, label, kinds, settings, max_nodes=1, freeze=reliable_checkpoint)
    finally:
        # Everything returned reads the checkpointed histogram, not the input.
        for frame in held:
            frame.unpersist()
    return hist, maybe_broadcast(thresholds, len(rows)), kinds


def _from_cells(frame: DataFrame, enc: cells.Encoding, settings: TreeSettings, held: list):
    counts = persisted(cells.count_cells(frame, enc, [1], {}))
    held.append(counts)
    found = cells.level_thresholds(counts, frame, enc, [1], settings.quantiles)
    held.extend(parts for parts, _ in found.passes)
    rows, _ = cells.bucketed(counts, found, [1], enc)
    hist = reliable_checkpoint(cells.long_histogram(rows, enc).repartition("node_id", "feature", "label"))
    named = [(n, enc.names[f], idx, t, m) for n, f, idx, t, m in found.rows]
    return hist, small_frame(frame.sparkSession, named, THRESHOLD_SCHEMA), named


def candidate_splits(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    settings = settings or TreeSettings()
    hist, thresholds, _ = root_histogram(df, label, features, settings)
    return score_candidates(hist, thresholds, settings.reference)


def best_split_per_column(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    """Best candidate of every feature (one row per feature with a candidate)."""
    return best_per(candidate_splits(df, label, features, settings), ["node_id", "feature"])


def rank_columns_by_gini(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    """Best split of every column, ranked (``rank`` 1 = the split a tree takes)."""
    best = best_split_per_column(df, label, features, settings)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("node_id").orderBy(*split_order())))


def _best_of_kind(df, label, feature, kind, settings):
    """Best split of one column of the given kind (checked from the schema,
    no job); a categorical column that bucketing drops has no row."""
    settings = settings or TreeSettings()
    if feature_kinds(df, label, [feature]).get(feature) != kind:
        raise ValueError(f"{feature!r} is not a {kind} column")
    return best_split_per_column(df, label, [feature], settings)


def best_ordinal_split(df: DataFrame, label: str, feature: str, settings: TreeSettings | None = None) -> DataFrame:
    return _best_of_kind(df, label, feature, ORDINAL, settings)


def best_categorical_split(df: DataFrame, label: str, feature: str, settings: TreeSettings | None = None) -> DataFrame:
    return _best_of_kind(df, label, feature, CATEGORICAL, settings)


def informative_columns(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    """Features that have at least one two-sided candidate: ``(feature, kind)``."""
    best = best_split_per_column(df, label, features, settings)
    return best.where(F.col("child_gini").isNotNull()).select("feature", "kind")


def in_out_counts(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    """Per candidate and label, the left (``cnt_in``) and right (``cnt_out``) counts."""
    settings = settings or TreeSettings()
    hist, thresholds, _ = root_histogram(df, label, features, settings)
    return side_counts(hist, thresholds, settings.reference)


def zero_filled_histogram(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> DataFrame:
    """``(feature, kind, threshold, category, label, cnt, label_total)``: the left
    count of every label in every candidate, 0 where it has none.

    Each label's counts are one sparse vector per feature and the zeros are
    read from it, so no grid of values and labels is joined; exact
    thresholds, whatever the settings' mode.
    """
    settings = (settings or TreeSettings()).with_(threshold_mode="exact")
    held: list = []

    def encode(selected: DataFrame) -> DataFrame:
        held.append(persisted(spread(cells.encoded(selected, feature_kinds(df, label, features)))))
        return held[0]

    try:
        frame, kinds, keep = prepare_frame(df, label, features, settings, encode)
        enc = cells.encoding(label, kinds, keep)
        frame = frame.withColumn("node_id", F.lit(1).cast("long"))
        counts = persisted(cells.count_cells(frame, enc, [1], {}))
        held.append(counts)
        found = cells.level_thresholds(counts, frame, enc, [1], settings.quantiles)
        held.extend(parts for parts, _ in found.passes)
        rows, facts = cells.bucketed(counts, found, [1], enc)
        width = cells.slots(enc, len(settings.quantiles))
        filled = reliable_checkpoint(
            cells.zero_filled(rows, enc, width, settings.reference).join(facts.drop("opened"), ["node_id", "feature"], "left")
        )
    finally:
        for frame in held:
            frame.unpersist()
    category = F.lit(None).cast("string")
    for j, f in enumerate(enc.names):
        if enc.categories.get(f):
            kept = F.array(*[F.lit(c) for c in enc.categories[f]])
            category = F.when(F.col("feature") == j, F.try_element_at(kept, F.col("idx"))).otherwise(category)
    threshold = F.when(F.col("feature").isin(enc.ordinals), F.try_element_at("ts", F.col("idx")))
    out = filled.select(
        enc.name().alias("feature"), enc.kind().alias("kind"), threshold.alias("threshold"), category.alias("category"),
        "label", F.col("l").cast("long").alias("cnt"), F.col("base").cast("long").alias("label_total"),
    )
    # Slots past a feature's last candidate, and labels that reference semantics leave out.
    return out.where((F.col("threshold").isNotNull() | F.col("category").isNotNull()) & (F.col("label_total") > 0))
