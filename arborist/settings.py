"""Learner settings and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. They must stay equal to the original learner's for equal
# results; they are stated here once, in natural order.
#   * default settings: max depth 4, minimum leaf size 32, category cap 6
#   * quantile grid used for ordinal thresholds (0.8 is absent on purpose)
#   * sentinel value that replaces rare, over-cap or null categories
#   * kind names of a split
# ---------------------------------------------------------------------------
DEFAULT_MAX_DEPTH = 4
DEFAULT_MIN_LEAF_SIZE = 32
DEFAULT_MAX_CARDINALITY = 6
QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.9)
FILLER_STRING = "FILLER_STRING"
ORDINAL = "ordinal"
CATEGORICAL = "categorical"

# Heap node ids (root 1, children 2i and 2i+1) must fit in a signed long;
# deeper trees are refused, not cut.
MAX_SUPPORTED_DEPTH = 62

SEMANTICS = ("consistent", "reference")
THRESHOLD_MODES = ("exact", "approx")
NULL_LABELS = ("drop", "error")


@dataclass(frozen=True)
class TreeSettings:
    """Settings of one tree.

    ``semantics="consistent"`` scores and routes with the same ``>=`` test,
    counts null numeric values on the right side, stops on pure nodes and
    keeps the label out of category bucketing.  ``semantics="reference"``
    reproduces the original learner's observable behaviour instead: route
    with ``>``, tied quantiles counted once per quantile, nulls in neither
    child, default settings for bucketing, string labels bucketed, no
    purity stop.
    """

    max_depth: int = DEFAULT_MAX_DEPTH
    min_leaf_size: int = DEFAULT_MIN_LEAF_SIZE
    max_cardinality: int = DEFAULT_MAX_CARDINALITY
    quantiles: tuple[float, ...] = field(default=QUANTILES)
    semantics: str = "consistent"
    threshold_mode: str = "exact"
    approx_accuracy: int = 10000
    # Rows without a label teach nothing: ``drop`` leaves them out, ``error``
    # refuses an input that has any.
    null_label: str = "drop"
    # Persist the prepared (bucketed, column-pruned) input for the duration
    # of a fit: every level reads it twice.  MEMORY_AND_DISK, released after.
    persist_input: bool = True

    def __post_init__(self):
        if not 0 <= self.max_depth <= MAX_SUPPORTED_DEPTH:
            raise ValueError(f"max_depth must be in [0, {MAX_SUPPORTED_DEPTH}], got {self.max_depth}")
        if self.min_leaf_size < 1:
            raise ValueError(f"min_leaf_size must be >= 1, got {self.min_leaf_size}")
        if self.max_cardinality < 1:
            raise ValueError(f"max_cardinality must be >= 1, got {self.max_cardinality}")
        if not self.quantiles or any(not 0.0 <= q <= 1.0 for q in self.quantiles):
            raise ValueError(f"quantiles must be a non-empty list within [0, 1], got {self.quantiles}")
        if self.semantics not in SEMANTICS:
            raise ValueError(f"semantics must be one of {SEMANTICS}, got {self.semantics!r}")
        if self.threshold_mode not in THRESHOLD_MODES:
            raise ValueError(f"threshold_mode must be one of {THRESHOLD_MODES}, got {self.threshold_mode!r}")
        if self.null_label not in NULL_LABELS:
            raise ValueError(f"null_label must be one of {NULL_LABELS}, got {self.null_label!r}")
        object.__setattr__(self, "quantiles", tuple(float(q) for q in self.quantiles))

    @property
    def reference(self) -> bool:
        return self.semantics == "reference"

    def with_(self, **changes) -> "TreeSettings":
        return replace(self, **changes)

    def bucketing_settings(self) -> "TreeSettings":
        """Settings used to bucket categories during fit.

        The original learner buckets with the default settings whatever the
        tree's own settings are; reference semantics keep that.
        """
        if self.reference:
            return TreeSettings(semantics="reference")
        return self
