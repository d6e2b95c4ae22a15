"""Kept cell counts of a tree level, and everything a level reads from them.

A numeric value lies in a cell of the fixed scale of ``thresholds``; the
cell numbers are encoded once, with the input.  A level is one table

    (node_id, feature, cell, category, label, cnt, lo, hi)

of the open nodes: rows per cell (or category) and label, with bounds of
the values.  It is bounded by nodes x features x cells x labels, whatever
the number of rows, and it answers the ranks of the quantile grid and the
label counts of all candidates.  Only cells that hold a target rank and
more than one value are read again, cut into parts, with their labels.

The table of the next level needs the rows of the smaller child of every
split only: what the larger child has is the parent's count minus its
sibling's.  Both come from one aggregation over the union of the parents'
table and the smaller children's rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import col
from ..functions.gini import SQUARE_TYPE, square, tied_gini, weighted_gini
from ..session import BROADCAST_ROW_LIMIT, narrowed, persisted, small_frame
from ..settings import CATEGORICAL, FILLER_STRING, ORDINAL
from .thresholds import PARTS, _same, _scale, distinct_threshold_rows, nearest_rank, quantile_grid

KEYS = ["feature", "cell", "category", "label"]

# Cells per unit of the natural logarithm: about 0.4 % wide, so the cells
# that hold a threshold hold few rows.
CELLS_PER_E = 256

_OPEN_SCHEMA = T.StructType(
    [
        T.StructField("open", T.IntegerType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("cell", T.IntegerType()),
        T.StructField("from_", T.DoubleType()),
        T.StructField("to_", T.DoubleType()),
        T.StructField("targets", T.ArrayType(T.StructType(
            [T.StructField("q_index", T.IntegerType()), T.StructField("rank", T.LongType())]
        ))),
    ]
)
_FACT_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("ts", T.ArrayType(T.DoubleType())),
        T.StructField("mult", T.ArrayType(T.LongType())),
        T.StructField("opened", T.ArrayType(T.IntegerType())),
    ]
)
_LABEL_SCHEMA = T.StructType([T.StructField("__label", T.StringType()), T.StructField("__number", T.IntegerType())])
_PART_SCHEMA = T.StructType([T.StructField("open", T.IntegerType()), T.StructField("part", T.LongType())])


@dataclass(frozen=True)
class Encoding:
    """Features by number: names, kinds, and the kept categories in order."""

    label: str
    kinds: dict[str, str]
    categories: dict[str, list[str]]
    # The rows hold the kept categories' numbers (see :func:`numbered`), not their texts.
    coded: bool = False

    @property
    def category_type(self) -> str:
        return "int" if self.coded else "string"

    @property
    def names(self) -> list[str]:
        return list(self.kinds)

    @property
    def ordinals(self) -> list[int]:
        return [j for j, f in enumerate(self.names) if self.kinds[f] == ORDINAL]

    def name(self) -> F.Column:
        return F.element_at(F.array(*[F.lit(f) for f in self.names]), F.col("feature") + 1)

    def kind(self) -> F.Column:
        return F.when(F.col("feature").isin(self.ordinals), F.lit(ORDINAL)).otherwise(F.lit(CATEGORICAL))


def encoding(label: str, kinds: dict[str, str], keep: dict[str, list[str]]) -> Encoding:
    ordered = {f: sorted(keep.get(f, []), key=lambda c: c.encode()) for f, k in kinds.items() if k == CATEGORICAL}
    return Encoding(label, kinds, ordered)


def encoded(frame: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``frame`` plus the cell number of every ordinal feature (NULL for
    NULL), in columns numbered by the order of the ordinal features."""
    ordinals = [f for f, k in kinds.items() if k == ORDINAL]
    return frame.withColumns({
        f"__c{i}": _scale(col(f).cast("double"), CELLS_PER_E).cast("int") for i, f in enumerate(ordinals)
    })


def label_numbers(frame: DataFrame, label: str) -> list[str] | None:
    """All labels in the order of their bytes, or None if they are too many to broadcast."""
    rows = frame.select(col(label)).distinct().limit(BROADCAST_ROW_LIMIT + 1).collect()
    return sorted((r[0] for r in rows), key=lambda y: y.encode()) if len(rows) <= BROADCAST_ROW_LIMIT else None


def numbered(frame: DataFrame, enc: Encoding, labels: list[str] | None) -> DataFrame:
    """The prepared rows in numbers, which are cached and read by the column
    without decoding texts, all of them in node 1: ordinal features as
    doubles, a category as its number among the kept ones from 1 (others 0),
    a label as its number in ``labels`` (None: as it is)."""
    y = col(enc.label)
    if labels is not None:
        table = small_frame(frame.sparkSession, list(zip(labels, range(len(labels)))), _LABEL_SCHEMA)
        frame = frame.join(F.broadcast(table), y == F.col("__label"))
        y = F.col("__number").alias(enc.label)
    out = []
    for f in enc.names:
        if enc.kinds[f] == ORDINAL:
            out.append(col(f).cast("double").alias(f))
        else:
            at = F.array_position(F.array(*[F.lit(c) for c in enc.categories[f]]), col(f))
            out.append(F.coalesce(F.when(col(f) != FILLER_STRING, at), F.lit(0)).cast("int").alias(f))
    numbers = [F.col(f"__c{i}") for i in range(len(enc.ordinals))]
    return frame.select(F.lit(1).cast("long").alias("node_id"), y, *out, *numbers)


def melted(routed: DataFrame, enc: Encoding, features: list[int]) -> DataFrame:
    """``(node_id, feature, cell, category, value, label)``: one row per row and listed feature."""
    args = []
    for j in features:
        f = enc.names[j]
        if enc.kinds[f] == ORDINAL:
            args += [F.lit(j), F.col(f"__c{enc.ordinals.index(j)}"), F.lit(None).cast(enc.category_type), col(f).cast("double")]
        else:
            args += [F.lit(j), F.lit(None).cast("int"), col(f), F.lit(None).cast("double")]
    return routed.select(
        "node_id", col(enc.label).alias("label"), F.stack(F.lit(len(features)), *args).alias("feature", "cell", "category", "value")
    )


def _alive(node, dead: dict[int, set[int]]):
    """Condition that the row's feature is not among the dead ones of ``node``."""
    by_feature: dict[int, list[int]] = {}
    for n, features in dead.items():
        for j in features:
            by_feature.setdefault(j, []).append(n)
    gone = F.lit(False)
    for j, nodes in sorted(by_feature.items()):
        gone = gone | ((F.col("feature") == j) & node.isin(nodes))
    return ~gone


def count_cells(routed: DataFrame, enc: Encoding, nodes: list[int], dead: dict[int, set[int]]) -> DataFrame:
    """The table of ``nodes``, from all their rows.  Features that are ``dead``
    in a node (by node id) are not counted, and not melted where dead in all."""
    live = [j for j in range(len(enc.names)) if any(j not in dead.get(n, ()) for n in nodes)]
    rows = melted(routed.where(F.col("node_id").isin(nodes)), enc, live).where(_alive(F.col("node_id"), dead))
    return rows.groupBy("node_id", *KEYS).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )


def next_cells(parents: DataFrame, routed: DataFrame, enc: Encoding, smaller: dict[int, int], open_nodes: list[int],
               dead: dict[int, set[int]]) -> DataFrame:
    """The table of ``open_nodes`` from the ``parents``' table and the rows of
    the ``smaller`` children (parent -> child id) alone.

    ``dead`` is by parent.  A larger child inherits its parent's bounds of
    a cell, which enclose its own.
    """
    parent_ids = [p for p in smaller if 2 * p in open_nodes or 2 * p + 1 in open_nodes]
    small_ids = [smaller[p] for p in parent_ids]
    live = [j for j in range(len(enc.names)) if any(j not in dead.get(p, ()) for p in parent_ids)]
    none = F.lit(None).cast("double")
    rows = melted(routed.where(F.col("node_id").isin(small_ids)), enc, live).select(
        F.shiftright("node_id", 1).alias("parent"), *KEYS, F.lit(0).cast("long").alias("all"), F.lit(1).cast("long").alias("small"),
        none.alias("lo"), none.alias("hi"), F.col("value").alias("s_lo"), F.col("value").alias("s_hi"),
    )
    # Parents whose larger child stays open: the others give nothing but their smaller child's rows.
    kept = [p for p in parent_ids if smaller[p] ^ 1 in open_nodes]
    before = parents.where(F.col("node_id").isin(kept)).select(
        F.col("node_id").alias("parent"), *KEYS, F.col("cnt").alias("all"), F.lit(0).cast("long").alias("small"),
        "lo", "hi", none.alias("s_lo"), none.alias("s_hi"),
    )
    both = rows.union(before).where(_alive(F.col("parent"), dead)).groupBy("parent", *KEYS).agg(
        F.sum("all").alias("all"), F.sum("small").alias("small"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("s_lo").alias("s_lo"), F.max("s_hi").alias("s_hi"),
    )
    right_small = [p for p in parent_ids if smaller[p] & 1]
    small_id = 2 * F.col("parent") + F.col("parent").isin(right_small).cast("int")
    pair = F.array(
        F.struct(small_id.alias("node_id"), F.col("small").alias("cnt"), F.col("s_lo").alias("lo"), F.col("s_hi").alias("hi")),
        F.struct(small_id.bitwiseXOR(F.lit(1)).alias("node_id"), (F.col("all") - F.col("small")).alias("cnt"), "lo", "hi"),
    )
    out = both.select(*KEYS, F.inline(pair)).select("node_id", *KEYS, "cnt", "lo", "hi")
    return out.where((F.col("cnt") > 0) & F.col("node_id").isin(open_nodes))


def _with_running(counts: DataFrame, group: list[str], key: str) -> DataFrame:
    upto = Window.partitionBy(*group).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("cum", F.sum("cnt").over(upto)).withColumn("n", F.sum("cnt").over(Window.partitionBy(*group)))


_INSIDE = "rank >= cum - cnt AND rank < cum"


@dataclass
class LevelThresholds:
    """Thresholds of some nodes: ``rows (node_id, feature number, idx,
    threshold, mult)``, the cells that were opened, and the part counts of
    those ``(open, part, label, cnt, lo, hi)``, a frame per pass."""

    rows: list[tuple]
    opened: list[tuple]
    passes: list[tuple[DataFrame, list[tuple]]]

    def release(self) -> None:
        for parts, _ in self.passes:
            parts.unpersist()


def level_thresholds(cells: DataFrame, routed: DataFrame, enc: Encoding, nodes: list[int], quantiles) -> LevelThresholds:
    """Exact nearest-rank thresholds of ``nodes`` from their table; reads rows
    again only in cells that hold a target rank and several values."""
    quantiles = tuple(float(q) for q in quantiles)
    out = LevelThresholds([], [], [])
    if not enc.ordinals:
        return out
    mine = cells.where(F.col("node_id").isin(nodes) & F.col("cell").isNotNull())
    totals = mine.groupBy("node_id", "feature", "cell").agg(
        F.sum("cnt").alias("cnt"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ranks = [nearest_rank(F.col("n"), F.lit(q)) for q in quantiles]
    found = (
        _with_running(totals, ["node_id", "feature"], "cell")
        .where(reduce(or_, [(r >= F.col("cum") - F.col("cnt")) & (r < F.col("cum")) for r in ranks]))
        .select("*", F.inline(quantile_grid(quantiles)))
        .withColumn("rank", nearest_rank(F.col("n"), F.col("quantile")))
        .where(_INSIDE)
        .select("node_id", "feature", "cell", "q_index", (F.col("rank") - (F.col("cum") - F.col("cnt"))).alias("rank"), "cnt", "lo", "hi")
        .collect()
    )
    values: list[tuple] = []
    while found:
        left: dict[tuple, list] = {}
        held: dict[tuple, int] = {}  # rows of the cell, or of the parts of it that are cut again
        for r in found:
            if _same(r["lo"], r["hi"]):
                values.append((r["node_id"], r["feature"], r["q_index"], quantiles[r["q_index"]], r["lo"] + 0.0))
            else:
                key = (r["node_id"], r["feature"], r["cell"], r["lo"], r["hi"])
                left.setdefault(key, []).append((r["q_index"], r["rank"]))
                held[key] = r["cnt"]
        if not left:
            break
        if out.passes:  # parts that are cut again count in the next pass only
            again = {(r["open"], r["part"]) for r in found if not _same(r["lo"], r["hi"])}
            out.passes[-1] = (out.passes[-1][0], sorted(again))
        first = len(out.opened)
        opened = [(first + i, *key, targets) for i, (key, targets) in enumerate(sorted(left.items(), key=lambda x: x[0]))]
        out.opened.extend(opened)
        parts = persisted(narrowed(_parts(routed, enc, opened), sum(held.values())))
        out.passes.append((parts, []))
        found = _ranked_parts(parts, opened)
    out.rows = distinct_threshold_rows(values)
    return out


def _parts(routed: DataFrame, enc: Encoding, opened: list[tuple]) -> DataFrame:
    """Counts ``(open, part, label, cnt, lo, hi)`` of the rows in the opened cells."""
    spark = routed.sparkSession
    features = sorted({o[2] for o in opened})
    table = F.broadcast(small_frame(spark, opened, _OPEN_SCHEMA).drop("targets"))
    value, lo, hi = F.col("value"), F.col("from_"), F.col("to_")
    rows = melted(routed, enc, features).join(table, ["node_id", "feature", "cell"]).where((value >= lo) & (value <= hi))
    part = F.floor((value - lo) / (hi - lo) * PARTS).cast("long").alias("part")
    return rows.select("open", part, "label", "value").groupBy("open", "part", "label").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def _ranked_parts(parts: DataFrame, opened: list[tuple]) -> list:
    targets = F.broadcast(small_frame(parts.sparkSession, opened, _OPEN_SCHEMA).select(
        "open", "node_id", "feature", "cell", F.inline("targets")))
    totals = parts.groupBy("open", "part").agg(F.sum("cnt").alias("cnt"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return (
        _with_running(totals, ["open"], "part").join(targets, "open").where(_INSIDE)
        .select("open", "part", "node_id", "feature", "cell", "q_index", (F.col("rank") - (F.col("cum") - F.col("cnt"))).alias("rank"), "cnt", "lo", "hi")
        .collect()
    )


def _facts(found: LevelThresholds) -> list[tuple]:
    by: dict[tuple, tuple[list, list, set]] = {}
    for node_id, feature, _, threshold, mult in found.rows:  # in the order of idx
        ts, ms, _ = by.setdefault((node_id, feature), ([], [], set()))
        ts.append(threshold)
        ms.append(mult)
    for o in found.opened:
        by.setdefault((o[1], o[2]), ([], [], set()))[2].add(o[3])
    return [(n, f, ts, ms, sorted(cells)) for (n, f), (ts, ms, cells) in sorted(by.items())]


def bucketed(cells: DataFrame, found: LevelThresholds, nodes: list[int], enc: Encoding) -> tuple[DataFrame, DataFrame]:
    """``(rows, facts)``: rows ``(node_id, feature, bucket, category, label,
    cnt, lo, hi)`` of ``nodes``, bucket = thresholds reached (-1 for NULL,
    NULL for a category), and the thresholds per (node, feature).

    A cell that was not opened lies on one side of every threshold or is
    the threshold, so its least value tells its bucket; opened cells come
    as their parts.
    """
    spark = cells.sparkSession
    facts = F.broadcast(small_frame(spark, _facts(found), _FACT_SCHEMA))
    wide = ["node_id", "feature", "cell", "category", "label", "cnt", "lo", "hi"]
    mine = cells.where(F.col("node_id").isin(nodes)).select(*wide)
    rows = mine.join(facts, ["node_id", "feature"], "left").where(
        "cell IS NULL OR opened IS NULL OR NOT array_contains(opened, cell)")
    if found.opened:
        place = F.broadcast(small_frame(spark, found.opened, _OPEN_SCHEMA).select("open", "node_id", "feature", "cell"))
        for parts, again in found.passes:
            if again:
                parts = parts.join(F.broadcast(small_frame(spark, again, _PART_SCHEMA)), ["open", "part"], "left_anti")
            inner = parts.join(place, "open").withColumn("category", F.lit(None).cast(enc.category_type)).select(*wide)
            rows = rows.union(inner.join(facts, ["node_id", "feature"], "left"))
    # One test for each threshold, not a function over the array: those are not compiled.
    most = max((r[2] for r in found.rows), default=0)
    reached = sum((F.when(F.get("ts", F.lit(i)) <= F.col("lo"), 1).otherwise(0) for i in range(most)), F.lit(0))
    bucket = F.when(F.col("feature").isin(enc.ordinals), F.when(F.col("cell").isNull(), F.lit(-1)).otherwise(reached))
    return rows.withColumn("bucket", bucket.cast("int")).select(
        "node_id", "feature", "bucket", "category", "label", "cnt", "lo", "hi"), facts


def long_histogram(rows: DataFrame, enc: Encoding) -> DataFrame:
    """The histogram of ``histogram.class_histogram`` from :func:`bucketed` rows."""
    return rows.groupBy(
        "node_id", enc.name().alias("feature"), enc.kind().alias("kind"), "bucket", "category", "label"
    ).agg(F.sum("cnt").alias("cnt"))


def slots(enc: Encoding, n_quantiles: int) -> int:
    return max([n_quantiles, *map(len, enc.categories.values())])


def label_vectors(rows: DataFrame, enc: Encoding, width: int) -> DataFrame:
    """``(node_id, feature, label, s0 .. s<width>, rest, rows, ...)``: one row
    per label that the (node, feature) has, with its count in every slot.
    Slot of an ordinal row: its bucket, of a category: its number among the
    kept ones from 1; NULL values and the sentinel are in ``rest``.  One
    map-side combined exchange, spread by label."""
    number = F.col("category") if enc.coded else F.lit(None).cast("int")
    for j, f in enumerate(enc.names):
        if enc.categories.get(f) and not enc.coded:
            at = F.array_position(F.array(*[F.lit(c) for c in enc.categories[f]]), F.col("category")).cast("int")
            number = F.when(F.col("feature") == j, F.when(F.col("category") != FILLER_STRING, at)).otherwise(number)
    ordinal = F.col("feature").isin(enc.ordinals)
    slot = F.when(ordinal, F.when(F.col("bucket") >= 0, F.col("bucket"))).otherwise(F.when(number > 0, number))
    sums = [F.expr(f"sum(if(slot = {i}, cnt, 0)) AS s{i}") for i in range(width + 1)]
    rest = ["sum(if(slot IS NULL, cnt, 0)) AS rest", "sum(cnt) AS rows", "min(lo) AS lo", "max(hi) AS hi",
            "min(category) AS c_lo", "max(category) AS c_hi"]
    return rows.withColumn("slot", slot).groupBy("node_id", "feature", "label").agg(*sums, *map(F.expr, rest))


def zero_filled(rows: DataFrame, enc: Encoding, width: int, reference: bool = False) -> DataFrame:
    """``(node_id, feature, idx, label, l, base, ...)``: a row for every
    candidate ``idx`` from 1 and every label of its (node, feature), with
    the label's left count ``l``, 0 where it has none, and the pool
    ``base`` that both sides are drawn from.

    The zeros come from the label's own vector of slot counts: no grid of
    values and labels is joined.  Candidates past a feature's last have
    ``l`` 0 for every label.
    """
    ordinal = f"feature IN ({', '.join(map(str, enc.ordinals))})" if enc.ordinals else "false"
    left = [f"if({ordinal}, {' + '.join(f's{k}' for k in range(i, width + 1))}, s{i})" for i in range(1, width + 1)]
    base = f"if({ordinal}, rows - rest, rows)" if reference else "rows"
    options = ", ".join(f"named_struct('idx', {i}, 'l', {e})" for i, e in enumerate(left, 1))
    return label_vectors(rows, enc, width).selectExpr(
        "node_id", "feature", "label", f"{base} AS base", "rows", "rest", "lo", "hi", "c_lo", "c_hi", f"inline(array({options}))")


def scored_candidates(rows: DataFrame, facts: DataFrame, enc: Encoding, n_quantiles: int, reference: bool) -> DataFrame:
    """``(node_id, feature, idx, child_gini, n_left, n_right, n_rows, n_labels,
    constant, threshold, text)`` of all candidates; ``child_gini`` is null
    for a candidate with an empty side, ``constant`` says that the feature
    has one value only, so that no descendant can split on it."""
    dec = SQUARE_TYPE
    sums = (
        zero_filled(rows, enc, slots(enc, n_quantiles), reference)
        .groupBy("node_id", "feature", "idx")
        .agg(
            F.sum("l").alias("n_left"), F.sum("base").alias("n_all"), F.sum(square(F.col("l"))).alias("sq_left"),
            F.sum(square(F.col("base"))).alias("sq_all"), F.sum(F.col("l").cast(dec) * F.col("base").cast(dec)).alias("cross"),
            F.sum("rows").alias("n_rows"), F.sum("rest").alias("rest"), F.count(F.lit(1)).alias("n_labels"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("c_lo").alias("c_lo"), F.max("c_hi").alias("c_hi"),
        )
        .join(facts.drop("opened"), ["node_id", "feature"], "left")
    )
    n_left, n_right = F.col("n_left"), F.col("n_all") - F.col("n_left")
    sq_right = (F.col("sq_all") - F.lit(2).cast(dec) * F.col("cross") + F.col("sq_left")).cast(dec)
    child = weighted_gini(F.col("sq_left"), n_left, sq_right, n_right)
    if reference:
        m = F.coalesce(F.try_element_at("mult", F.col("idx")), F.lit(1)).cast("long")
        child, n_left, n_right = tied_gini(child, m), n_left * m, n_right * m
    ordinal = F.col("feature").isin(enc.ordinals)
    threshold = F.when(ordinal, F.try_element_at("ts", F.col("idx")))
    one_value = F.col("lo").isNull() | ((F.col("lo") == F.col("hi")) & (F.col("rest") == 0))
    constant = F.when(ordinal, one_value).otherwise(F.col("c_lo") == F.col("c_hi"))
    return sums.select(
        "node_id", "feature", "idx", child.alias("child_gini"), n_left.cast("long").alias("n_left"), n_right.cast("long").alias("n_right"),
        "n_rows", "n_labels", constant.alias("constant"), threshold.alias("threshold"), threshold.cast("string").alias("text"),
    )
