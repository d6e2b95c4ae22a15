"""Level-wise fit of a binary classification tree and its node table.

The model is a table of nodes with heap ids (root 1, children 2i and
2i+1).  The prepared input (label + features, categories bucketed, cell
numbers of the numeric features) is persisted for the fit, in exact mode
with labels and categories as numbers.  Fitting grows the tree one depth
at a time, for every open node of the level in the same Spark jobs:

1. ``node_id`` of every row = one step of ``routing.assign_leaves`` from
   the ids of the level above (map-only), persisted for the level's passes;
2. counts: the level's table of cells (``operators.cells``), persisted.
   Only the rows of the smaller child of every split are counted; the
   larger child is the parent's counts minus its sibling's.  Features that
   are constant in a node are left out below it;
3. thresholds: exact nearest-rank quantiles per (node, numeric feature)
   from that table; rows are read again only in cells that hold a target
   rank and several values.  Collected (bounded by nodes x features x
   quantiles);
4. scores: label counts of all candidates from the table; one row per
   candidate is collected;
5. children are appended on the driver; a child is closed when it reaches
   the maximum depth or its side of the split is smaller than the minimum
   leaf size.

A level with many open nodes runs in batches, so that what is broadcast
or collected at once stays within fixed bounds.  Every ``ROUTE_LEVELS``
levels the rows are written with their node id, which cuts their lineage.

Reference semantics lose rows between a node and its children, so there
every open node is counted from its rows.  The approximate threshold mode
reads the rows once for thresholds and once for the counts.

After the last level one aggregation labels every leaf with its most
frequent label (ties: smaller label).  Only tree-sized data ever reaches
the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import feature_kinds, require_free_output
from ..functions.predicates import rule_text
from ..operators import cells
from ..operators.bucketing import prepare_frame
from ..operators.labels import majority_label
from ..operators.splits import best_per_node, level_histogram, score_candidates
from ..session import TASK_ROWS, batches, narrowed, persisted, reliable_checkpoint, small_frame, spread
from ..settings import ORDINAL, TreeSettings
from .routing import assign_labels, assign_leaves

PREDICTED_LABEL = "PREDICTED_LABEL"

NODE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType(), False),
        T.StructField("parent_id", T.LongType()),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("is_leaf", T.BooleanType(), False),
        T.StructField("feature", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("selection", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("child_gini", T.DoubleType()),
        T.StructField("n_left", T.LongType()),
        T.StructField("n_right", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("left_id", T.LongType()),
        T.StructField("right_id", T.LongType()),
        T.StructField("rule", T.StringType()),
    ]
)


@dataclass
class Node:
    node_id: int
    depth: int
    parent_id: int | None = None
    closed: bool = False  # no split will be tried (depth or size stop)
    is_split: bool = False
    feature: str | None = None
    kind: str | None = None
    selection: str | None = None
    threshold: float | None = None
    category: str | None = None
    child_gini: float | None = None
    n_left: int | None = None
    n_right: int | None = None
    n_rows: int | None = None
    label: str | None = None
    rule: str = ""

    @property
    def left_id(self) -> int:
        return 2 * self.node_id

    @property
    def right_id(self) -> int:
        return 2 * self.node_id + 1


class TreeModel:
    """A fitted tree: node table + routing expressions."""

    def __init__(self, nodes: dict[int, Node], label: str, kinds: dict[str, str], settings: TreeSettings):
        self.nodes = nodes
        self.label = label
        self.kinds = kinds
        self.settings = settings

    @property
    def reference(self) -> bool:
        return self.settings.reference

    def leaves(self) -> list[Node]:
        return [n for n in self.nodes.values() if not n.is_split]

    def leaf_assignment(self, df: DataFrame, output_col: str = "node_id", joins: bool | None = None) -> DataFrame:
        """Add the id of the leaf each row reaches (map-only; see ``routing``)."""
        require_free_output(df, output_col)
        out = assign_leaves(df, self.nodes, self.reference, output_col, joins)
        return out.where(F.col(output_col).isNotNull()) if self.reference else out

    def predict(self, df: DataFrame, output_col: str = PREDICTED_LABEL, joins: bool | None = None) -> DataFrame:
        """Add the predicted label: map-only, row order kept, no shuffle.

        Works unchanged on a streaming DataFrame.  Reference semantics drop
        rows whose split value is NULL (they reach no leaf).
        """
        require_free_output(df, output_col)
        return assign_labels(df, self.nodes, self.reference, output_col, joins)

    def node_rows(self) -> list[tuple]:
        rows = []
        for n in sorted(self.nodes.values(), key=lambda n: n.node_id):
            rows.append(
                (
                    n.node_id, n.parent_id, n.depth, not n.is_split, n.feature, n.kind, n.selection,
                    n.threshold, n.category, n.child_gini, n.n_left, n.n_right, n.n_rows, n.label,
                    n.left_id if n.is_split else None, n.right_id if n.is_split else None, n.rule,
                )
            )
        return rows

    def node_table(self, spark: SparkSession) -> DataFrame:
        return small_frame(spark, self.node_rows(), NODE_SCHEMA)

    def __repr__(self) -> str:
        lines = []
        for n in sorted(self.nodes.values(), key=lambda n: (n.depth, n.node_id)):
            what = f"split {n.feature} {n.selection!r}" if n.is_split else f"leaf -> {n.label!r}"
            lines.append(f"{'  ' * n.depth}[{n.node_id}] n={n.n_rows} {what}")
        return "\n".join(lines)


def _split(node: Node, best, settings: TreeSettings, nodes: dict) -> list[int]:
    node.is_split = True
    node.feature, node.kind, node.selection = best["feature"], best["kind"], best["selection"]
    node.threshold, node.category = best["threshold"], best["category"]
    node.child_gini, node.n_left, node.n_right = best["child_gini"], best["n_left"], best["n_right"]
    opened = []
    for child_id, size, left in ((node.left_id, node.n_left, True), (node.right_id, node.n_right, False)):
        depth = node.depth + 1
        closed = depth >= settings.max_depth or size < settings.min_leaf_size
        text = rule_text(node.feature, node.kind, node.threshold, node.category, left, settings.reference)
        rule = f"{node.rule} AND {text}" if node.rule else text
        nodes[child_id] = Node(child_id, depth, parent_id=node.node_id, closed=closed, rule=rule)
        if not closed:
            opened.append(child_id)
    return opened


def fit(df: DataFrame, label: str, features=None, settings: TreeSettings | None = None) -> TreeModel:
    """Fit a tree predicting ``label`` from ``features`` (default: all other columns)."""
    settings = settings or TreeSettings()
    held: list = []

    def encode(selected: DataFrame) -> DataFrame:
        if settings.threshold_mode == "exact":
            selected = cells.encoded(selected, feature_kinds(df, label, features))
        if settings.persist_input:
            held.append(persisted(spread(selected)))
            return held[-1]
        return selected

    try:
        frame, kinds, keep = prepare_frame(df, label, features, settings, encode)
        model, rows = _grow(_Rows(frame, held), label, kinds, keep, settings)
        _label_leaves(model, rows)
    finally:
        for frame in held:
            frame.unpersist()
    return model


# Nodes of a level that are worked on together, at most (an IN list of their ids).
BATCH_NODES = 4096
# Levels between two writes of the rows with their node ids.
ROUTE_LEVELS = 6


class _Rows:
    """The rows of a fit, with their node ids as of depth ``start`` (None:
    without).  ``held`` are the frames persisted for them: the ids of a level
    are persisted when a level is opened, as all its passes read them, and
    what they were made from is released when the level is done."""

    def __init__(self, frame: DataFrame, held: list):
        self.frame, self.held = frame, held
        self.start: int | None = None
        self.codes: dict[str, list[str]] | None = None  # categories by number
        self.labels: list[str] | None = None  # labels by number

    def number(self, enc: cells.Encoding, settings: TreeSettings) -> None:
        self.labels = cells.label_numbers(self.frame, enc.label)
        self._keep(cells.numbered(self.frame, enc, self.labels), 0, settings)
        self.codes = enc.categories

    def routed(self, nodes: dict[int, Node], reference: bool) -> DataFrame:
        """The rows in the nodes where they end; rows that reference routing loses are left out."""
        out = assign_leaves(self.frame, nodes, reference, "node_id", start=self.start, codes=self.codes)
        return out.where(F.col("node_id").isNotNull()) if reference else out

    def open_level(self, nodes: dict[int, Node], depth: int, settings: TreeSettings) -> DataFrame:
        routed = self.routed(nodes, settings.reference)
        if depth and depth % ROUTE_LEVELS == 0:
            self.frame, self.start = reliable_checkpoint(routed), depth
        elif depth and settings.persist_input:
            self._keep(routed, depth, settings)
        else:
            return routed
        return self.frame

    def close_level(self) -> None:
        """Release what the level's own rows, read and so kept by now, were made from."""
        if self.start is not None:
            for frame in self.held:
                if frame is not self.frame:
                    frame.unpersist()
            self.held[:] = [frame for frame in self.held if frame is self.frame]

    def _keep(self, frame: DataFrame, depth: int, settings: TreeSettings) -> None:
        self.frame, self.start = frame, depth
        if settings.persist_input:
            self.held.append(persisted(frame))
            self.frame = self.held[-1]


def _grow(rows: _Rows, label: str, kinds: dict, keep: dict, settings: TreeSettings) -> tuple[TreeModel, _Rows]:
    nodes: dict[int, Node] = {1: Node(1, 0, closed=settings.max_depth == 0)}
    frontier = [] if nodes[1].closed or not kinds else [1]
    level = None
    if frontier and settings.threshold_mode == "exact":
        enc = replace(cells.encoding(label, kinds, keep), coded=True)
        level = _KeptCounts(enc, settings)
        rows.number(enc, settings)
    try:
        while frontier:
            routed = rows.open_level(nodes, nodes[frontier[0]].depth, settings)
            if level is not None:
                found = level.best_splits(routed, frontier, nodes)
            else:
                found = {}
                width = 1 + len(kinds) * len(settings.quantiles)
                for run in batches(frontier, width):
                    for i in range(0, len(run), BATCH_NODES):
                        found |= _best_splits(routed, run[i : i + BATCH_NODES], label, kinds, settings)
            rows.close_level()
            next_frontier = []
            for node_id in frontier:
                node, best = nodes[node_id], found.get(node_id)
                if best is not None:
                    node.n_rows = best["n_rows"]
                pure = best is not None and best["n_labels"] <= 1
                if best is None or (pure and not settings.reference):
                    node.closed = True
                    continue
                next_frontier.extend(_split(node, best, settings, nodes))
            frontier = next_frontier
    finally:
        if level is not None:
            level.release()
    return TreeModel(nodes, label, kinds, settings), rows


class _KeptCounts:
    """The tables of cells of one level, in batches of nodes, and the next
    level's from them.  ``counted`` is how many cells of rows each level
    counted (nodes x features that were melted), for tests and tuning."""

    def __init__(self, enc: cells.Encoding, settings: TreeSettings):
        self.enc, self.settings = enc, settings
        self.tables: list[tuple[list[int], DataFrame]] = []
        self.root_rows = 0  # of the root's table: no node's has more
        self.constant: dict[int, set[int]] = {}  # features of a node that no descendant can split on
        self.counted: list[list[tuple[int, int]]] = []

    def release(self) -> None:
        for _, table in self.tables:
            table.unpersist()

    def best_splits(self, routed: DataFrame, frontier: list[int], nodes: dict[int, Node]) -> dict:
        """Statistics and best split of every node of ``frontier`` that has a split."""
        before, self.tables = self.tables, self._next(routed, frontier, nodes)
        found: dict = {}
        # Threshold and candidate cells of a node: what a batch broadcasts and collects per node.
        width = 12 * len(self.enc.kinds) * cells.slots(self.enc, len(self.settings.quantiles))
        constant: dict[int, set[int]] = {}
        for ids, table in self.tables:
            for run in batches(ids, width):
                for r in self._batch(routed, table, run):
                    if r["constant"]:
                        constant.setdefault(r["node_id"], set()).add(r["feature"])
                    self._take(found, r)
        for ids, _ in self.tables:
            for n in ids:
                constant.setdefault(n, set()).update(self.constant.get(n >> 1, ()))
        self.constant = constant
        for _, table in before:
            table.unpersist()
        return {n: _Best(r, self.enc) for n, (_, r) in found.items()}

    def _take(self, found: dict, r) -> None:
        """Keep the first by score, feature name, then threshold or category (their order is that of ``idx``)."""
        if r["child_gini"] is None:
            return
        order = (r["child_gini"], self.enc.names[r["feature"]], r["idx"])
        if r["node_id"] not in found or order < found[r["node_id"]][0]:
            found[r["node_id"]] = (order, r)

    def _next(self, routed: DataFrame, frontier: list[int], nodes: dict[int, Node]) -> list[tuple[list[int], DataFrame]]:
        out: list[tuple[list[int], DataFrame]] = []
        dead = {n: self.constant.get(n >> 1, set()) for n in frontier}
        if not self.tables or self.settings.reference:
            for i in range(0, len(frontier), BATCH_NODES):
                ids = frontier[i : i + BATCH_NODES]
                self._note(ids, dead)
                out.append((ids, cells.count_cells(routed, self.enc, ids, {n: dead[n] for n in ids if dead[n]})))
        else:
            opened = set(frontier)
            for parents, table in self.tables:
                mine = [p for p in parents if nodes[p].is_split and (2 * p in opened or 2 * p + 1 in opened)]
                for i in range(0, len(mine), BATCH_NODES // 2):
                    part = mine[i : i + BATCH_NODES // 2]
                    smaller = {p: 2 * p + (nodes[p].n_right < nodes[p].n_left) for p in part}
                    ids = [c for p in part for c in (2 * p, 2 * p + 1) if c in opened]
                    gone = {p: self.constant[p] for p in part if self.constant.get(p)}
                    self._note(list(smaller.values()), {c: gone.get(p, set()) for p, c in smaller.items()})
                    out.append((ids, cells.next_cells(table, routed, self.enc, smaller, ids, gone)))
        depth = nodes[frontier[0]].depth
        if not depth:
            table = persisted(narrowed(out[0][1], TASK_ROWS))
            self.root_rows = table.count()
            return [(out[0][0], table)]
        freeze = reliable_checkpoint if depth % ROUTE_LEVELS == 0 else persisted
        return [(ids, freeze(narrowed(table, self._most_rows(ids, nodes)))) for ids, table in out]

    def _most_rows(self, ids: list[int], nodes: dict[int, Node]) -> int:
        """Bound of the rows in the table of ``ids``: a row has one cell of a
        feature, and a node's cells and labels are among the root's."""
        sizes = [nodes[n >> 1].n_right if n & 1 else nodes[n >> 1].n_left for n in ids]
        return sum(min(size * len(self.enc.names), self.root_rows) for size in sizes)

    def _note(self, ids: list[int], dead: dict[int, set[int]]) -> None:
        self.counted.append([(n, len(self.enc.names) - len(dead.get(n, ()))) for n in ids])

    def _batch(self, routed: DataFrame, table: DataFrame, ids: list[int]) -> list:
        enc, quantiles, reference = self.enc, self.settings.quantiles, self.settings.reference
        found = cells.level_thresholds(table, routed, enc, ids, quantiles)
        try:
            rows, facts = cells.bucketed(table, found, ids, enc)
            return cells.scored_candidates(rows, facts, enc, len(quantiles), reference).collect()
        finally:
            found.release()


class _Best:
    """A collected best candidate under the names that :func:`_split` reads."""

    def __init__(self, row, enc: cells.Encoding):
        feature = enc.names[row["feature"]]
        kind = enc.kinds[feature]
        category = None if kind == ORDINAL else enc.categories[feature][row["idx"] - 1]
        self._values = {
            **{k: row[k] for k in ("child_gini", "n_left", "n_right", "n_rows", "n_labels")},
            "feature": feature, "kind": kind, "threshold": row["threshold"], "category": category,
            "selection": row["text"] if kind == ORDINAL else category,
        }

    def __getitem__(self, name: str):
        return self._values[name]


def _best_splits(routed: DataFrame, node_ids: list[int], label: str, kinds: dict, settings: TreeSettings) -> dict:
    """Statistics and best split of a batch of nodes from a histogram of
    their rows, for approximate thresholds: one row for each node that has
    a split reaches the driver."""
    mine = routed.where(F.col("node_id").isin(node_ids))
    hist, thresholds, rows = level_histogram(mine, label, kinds, settings, max_nodes=len(node_ids))
    try:
        best = best_per_node(score_candidates(hist, thresholds, settings.reference, len(rows)))
        return {r["node_id"]: r for r in best.collect()}
    finally:
        hist.unpersist()


def _label_leaves(model: TreeModel, rows: _Rows) -> None:
    """One aggregation labels every leaf and counts every node's rows; its
    rows, one per leaf, reach the driver a partition at a time."""
    per_leaf = majority_label(rows.routed(model.nodes, model.reference), ["node_id"], model.label)
    name = (lambda y: y) if rows.labels is None else rows.labels.__getitem__
    found = {r["node_id"]: (r["n_rows"], name(r["label"])) for r in per_leaf.toLocalIterator()}
    for leaf in model.leaves():
        leaf.n_rows, leaf.label = found.get(leaf.node_id, (0, None))
    # Inner nodes: sum of their children, bottom-up.
    for node in sorted(model.nodes.values(), key=lambda n: -n.depth):
        if node.is_split and node.n_rows is None:
            node.n_rows = (model.nodes[node.left_id].n_rows or 0) + (model.nodes[node.right_id].n_rows or 0)
