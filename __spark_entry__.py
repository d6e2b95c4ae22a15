"""

Every query reads the supplied tables under ``sf_dir`` whole and runs one
operator (or a whole fit) of the package on them.  Scores are rounded to
9 digits in both the Spark query and its SQL twin so that the value hash
compares the same numbers; nothing else is trimmed.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arborist import TreeSettings, fit  # noqa: E402
from arborist.operators import bucketing, histogram, thresholds  # noqa: E402
from arborist.operators.labels import majority_label  # noqa: E402
from arborist.operators.splits import with_label_totals  # noqa: E402
from arborist.plans import columns  # noqa: E402
from arborist.operators.compare import frame_diff  # noqa: E402
from arborist.plans.scoring import leaf_boxes, leaf_label_mix, leaf_rule_stats, predict_indexed, split_left_right  # noqa: E402
from arborist.session import checkpoint_dir  # noqa: E402
from arborist.sources.tables import FEATURE_SETS, read_csv_inferred, read_table  # noqa: E402
from oracle_queries import ORACLE_SQL  # noqa: E402

# The training-data operators are optional: without their subpackage all else works.
try:
    import corpus_pipeline  # noqa: E402
    from arborist.llm.queries import ORACLE_SQL as LLM_SQL  # noqa: E402
    from arborist.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ImportError:  # the folders, or a library that only they need, are absent
    corpus_pipeline, LLM_QUERIES, LLM_SQL = None, {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 9


def _r(name: str):
    return F.round(F.col(name), DIGITS).alias(name)


def _load(spark: SparkSession, sf_dir: str, name: str):
    """Feature set and its rows.  The supplied tables hold no NULL: here a
    discount of 0 becomes one, so that queries meet them."""
    fs = FEATURE_SETS[name]
    df = fs.load(spark, sf_dir)
    if name == "lineitem":
        df = df.withColumn("l_discount", F.when(F.col("l_discount") != 0.0, F.col("l_discount")))
    return fs, df


def _lineitem_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with NaN for a discount of up to 0.04 (about half the rows)."""
    nan = F.when(F.col("l_discount") <= 0.04, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    return FEATURE_SETS["lineitem"].load(spark, sf_dir).withColumn("l_discount", nan)


def _ranked(spark, sf_dir, name, settings=None):
    fs, df = _load(spark, sf_dir, name)
    out = columns.rank_columns_by_gini(df, fs.label, list(fs.features), settings)
    return out.select("rank", "feature", "kind", "threshold", "category", "n_left", "n_right", _r("child_gini"))


# --- bucketing ---------------------------------------------------------------

def q_category_counts(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return bucketing.category_counts(part, ["p_name", "p_brand", "p_type"])


def q_top_categories(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return bucketing.top_categories(docs, ["lang", "source"], 32, 6)


def q_droppable_columns(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    return bucketing.droppable_columns(customer, ["c_name", "c_mktsegment"], TreeSettings())


def q_bucket_rare_categories(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return bucketing.bucket_rare_categories(part, TreeSettings(), ["p_name", "p_brand", "p_type"])


def q_prepare_frame(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "part")
    frame, _, _ = bucketing.prepare_frame(df, fs.label, list(fs.features), TreeSettings())
    return frame


# --- histograms and thresholds -----------------------------------------------

def q_class_histogram(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "orders")
    hist, _, _ = columns.root_histogram(df, fs.label, list(fs.features))
    return hist


def q_nearest_rank_quantiles(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    cells = histogram.numeric_cells(li.withColumn("node_id", F.col("l_linenumber").cast("long")), feats)
    return thresholds.exact_quantiles(cells)


def q_label_totals_window(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "lineitem")
    hist, _, _ = columns.root_histogram(df, fs.label, ["l_linestatus"])
    out = with_label_totals(hist, reference=False)
    return out.select("node_id", "feature", "category", "label", "cnt", F.col("base").alias("label_total"),
                      (F.col("base") - F.col("cnt")).alias("cnt_out"))


def q_majority_label(spark, sf_dir):
    return majority_label(read_table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus")


# --- candidates and scores -----------------------------------------------------

def q_categorical_in_out_counts(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "documents")
    out = columns.in_out_counts(df, fs.label, ["lang", "source"])
    return out.select("feature", "category", "label", "cnt_in", "cnt_out")


def q_ordinal_in_out_counts(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "lineitem")
    out = columns.in_out_counts(df, fs.label, ["l_quantity", "l_discount", "l_tax"])
    return out.select("feature", "threshold", "label", "cnt_in", "cnt_out")


def q_sparse_in_out_counts(spark, sf_dir):
    """Label lang against a copy of itself: most labels have no left row."""
    docs = read_table(spark, sf_dir, "documents").withColumn("same", F.col("lang"))
    out = columns.in_out_counts(docs, "lang", ["same", "n_chars"])
    return out.select("feature", "threshold", "category", "label", "cnt_in", "cnt_out")


def _nan_candidates(spark, sf_dir, settings=None):
    fs = FEATURE_SETS["lineitem"]
    c = columns.candidate_splits(_lineitem_nan(spark, sf_dir), fs.label, ["l_discount", "l_tax"], settings)
    nan = F.isnan("threshold")
    return c.select("feature", nan.alias("nan_threshold"), F.when(~nan, F.col("threshold")).alias("threshold"),
                    "n_left", "n_right", _r("child_gini"))


def q_candidates_nan(spark, sf_dir):
    return _nan_candidates(spark, sf_dir)


def q_candidates_nan_reference(spark, sf_dir):
    return _nan_candidates(spark, sf_dir, TreeSettings(semantics="reference"))


def q_best_split_unsigned(spark, sf_dir):
    """A feature of type decimal(20,0), as Spark reads unsigned 64-bit integers."""
    fs, df = _load(spark, sf_dir, "orders")
    df = df.withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,0)"))
    out = columns.best_ordinal_split(df, fs.label, "o_custkey")
    return out.select("feature", "kind", "threshold", "selection", "n_left", "n_right", _r("child_gini"))


def _candidates(spark, sf_dir, name, settings=None):
    fs, df = _load(spark, sf_dir, name)
    return columns.candidate_splits(df, fs.label, list(fs.features), settings)


def q_candidate_totals(spark, sf_dir):
    return _candidates(spark, sf_dir, "lineitem").select("feature", "kind", "threshold", "category", "n_left", "n_right")


def q_gini_per_side(spark, sf_dir):
    c = _candidates(spark, sf_dir, "lineitem")
    return c.select("feature", "kind", "threshold", "category", _r("gini_left"), _r("gini_right"))


def q_weighted_gini(spark, sf_dir):
    c = _candidates(spark, sf_dir, "documents")
    return c.select("feature", "kind", "threshold", "category", "n_left", "n_right", _r("child_gini"))


def q_best_categorical_split(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "orders")
    out = columns.best_categorical_split(df, fs.label, "o_orderpriority")
    return out.select("feature", "kind", "selection", "n_left", "n_right", _r("child_gini"))


def q_best_ordinal_split(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "orders")
    out = columns.best_ordinal_split(df, fs.label, "o_totalprice")
    return out.select("feature", "kind", "threshold", "n_left", "n_right", _r("child_gini"))


def q_best_split_per_column(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "part")
    out = columns.best_split_per_column(df, fs.label, list(fs.features))
    return out.select("feature", "kind", "threshold", "category", "n_left", "n_right", _r("child_gini"))


def q_rank_columns_by_gini(spark, sf_dir):
    return _ranked(spark, sf_dir, "documents")


def q_rank_columns_by_gini_reference(spark, sf_dir):
    return _ranked(spark, sf_dir, "lineitem", TreeSettings(semantics="reference"))


def q_informative_columns(spark, sf_dir):
    fs, df = _load(spark, sf_dir, "documents")
    return columns.informative_columns(df, fs.label, list(fs.features))


# --- tree ----------------------------------------------------------------------

NODE_COLUMNS = ["node_id", "parent_id", "depth", "is_leaf", "feature", "kind", "threshold", "category",
                "n_left", "n_right", "n_rows", "label"]


def _model(spark, sf_dir, name, settings):
    fs, df = _load(spark, sf_dir, name)
    return fs, df, fit(df, fs.label, list(fs.features), settings)


def q_fit_node_table(spark, sf_dir):
    _, _, model = _model(spark, sf_dir, "lineitem", TreeSettings())
    return model.node_table(spark).select(*NODE_COLUMNS, _r("child_gini"))


def q_fit_node_table_reference(spark, sf_dir):
    _, _, model = _model(spark, sf_dir, "lineitem", TreeSettings(max_depth=3, semantics="reference"))
    return model.node_table(spark).select(*NODE_COLUMNS, _r("child_gini"))


def q_predict_reference(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "lineitem", TreeSettings(max_depth=3, semantics="reference"))
    return model.predict(df).select(fs.key, "PREDICTED_LABEL")


def q_leaf_labels(spark, sf_dir):
    _, _, model = _model(spark, sf_dir, "orders", TreeSettings(max_depth=3))
    return model.node_table(spark).where("is_leaf").select("node_id", "label", "n_rows")


def q_predict_depth2(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "orders", TreeSettings(max_depth=2))
    return model.predict(df).select(fs.key, "PREDICTED_LABEL")


def q_leaf_assignment(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "documents", TreeSettings(max_depth=3, min_leaf_size=10))
    return model.leaf_assignment(df).select(fs.key, "node_id")


def q_split_left_right(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "part", TreeSettings(max_depth=1))
    return split_left_right(model, df).select(fs.key, "side")


def q_leaf_rule_stats(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "lineitem", TreeSettings(max_depth=2))
    return leaf_rule_stats(model, df)


def q_leaf_label_mix(spark, sf_dir):
    _, df, model = _model(spark, sf_dir, "lineitem", TreeSettings(max_depth=2))
    return leaf_label_mix(model, df)


def q_fit_pruned_node_table(spark, sf_dir):
    """Two features that are constant, one at once and one below the root."""
    part = FEATURE_SETS["part"].load(spark, sf_dir)
    part = part.withColumn("big", (F.col("p_size") >= 25).cast("int")).withColumn("one", F.lit("same"))
    model = fit(part, "p_type", ["big", "one", "p_size", "p_brand"], TreeSettings(max_depth=4, min_leaf_size=20))
    return model.node_table(spark).select(*NODE_COLUMNS, _r("child_gini"))


def q_fit_deep_node_table(spark, sf_dir):
    """Twelve levels: rows are routed on from node ids that were written."""
    fs = FEATURE_SETS["orders"]
    model = fit(fs.load(spark, sf_dir), fs.label, list(fs.features), TreeSettings(max_depth=12, min_leaf_size=400))
    return model.node_table(spark).select(*NODE_COLUMNS, _r("child_gini"))


def q_leaf_boxes(spark, sf_dir):
    _, _, model = _model(spark, sf_dir, "lineitem", TreeSettings(max_depth=3))
    return leaf_boxes(model.node_table(spark))


def q_predict_indexed(spark, sf_dir):
    fs, df, model = _model(spark, sf_dir, "orders", TreeSettings(max_depth=2))
    out = predict_indexed(model, df, F.desc("o_totalprice"), F.asc("o_orderkey"))
    return out.select(fs.key, "row_index", "PREDICTED_LABEL")


def q_zero_filled_histogram(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumn("same", F.col("lang"))
    return columns.zero_filled_histogram(docs, "lang", ["same", "source", "n_chars"])


def q_frame_diff(spark, sf_dir):
    """Orders against a copy with small and large changes, lost and repeated rows."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    other = orders.where(key % 101 != 0).withColumns({
        "o_totalprice": F.when(key % 7 == 0, price * 1.0000000001).when(key % 97 == 0, price + 1.5).otherwise(price),
        "o_orderstatus": F.when(key % 89 == 0, F.lit("?")).otherwise(F.col("o_orderstatus")),
    })
    other = other.union(orders.where(key % 211 == 0))
    return frame_diff(orders, other, ["o_custkey", "o_orderkey"])


def q_csv_inferred(spark, sf_dir):
    """Customers written as CSV with two broken lines, read back with inferred types."""
    customer = read_table(spark, sf_dir, "customer")
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    customer.write.option("header", True).csv(path)
    lines = [(",".join(customer.columns) + "\n1,2\ntoo,many,fields,in,this,line",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)
    rows, bad = read_csv_inferred(spark, path, customer.columns)
    types = F.lit(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields))
    return rows.crossJoin(F.broadcast(bad.agg(F.sum("n").alias("n_bad")))).withColumn("types", types)


def q_predict_join_route(spark, sf_dir):
    """A deeper tree, routed by joins on the splits of each depth."""
    fs, df, model = _model(spark, sf_dir, "orders", TreeSettings(max_depth=5))
    return model.predict(df, joins=True).select(fs.key, "PREDICTED_LABEL")


_QUERIES = {
    "category_counts": q_category_counts,
    "top_categories": q_top_categories,
    "droppable_columns": q_droppable_columns,
    "bucket_rare_categories": q_bucket_rare_categories,
    "prepare_frame": q_prepare_frame,
    "class_histogram": q_class_histogram,
    "nearest_rank_quantiles": q_nearest_rank_quantiles,
    "label_totals_window": q_label_totals_window,
    "majority_label": q_majority_label,
    "categorical_in_out_counts": q_categorical_in_out_counts,
    "ordinal_in_out_counts": q_ordinal_in_out_counts,
    "candidate_totals": q_candidate_totals,
    "gini_per_side": q_gini_per_side,
    "weighted_gini": q_weighted_gini,
    "best_categorical_split": q_best_categorical_split,
    "best_ordinal_split": q_best_ordinal_split,
    "best_split_per_column": q_best_split_per_column,
    "rank_columns_by_gini": q_rank_columns_by_gini,
    "rank_columns_by_gini_reference": q_rank_columns_by_gini_reference,
    "informative_columns": q_informative_columns,
    "fit_node_table": q_fit_node_table,
    "fit_node_table_reference": q_fit_node_table_reference,
    "leaf_labels": q_leaf_labels,
    "predict_depth2": q_predict_depth2,
    "predict_reference": q_predict_reference,
    "leaf_assignment": q_leaf_assignment,
    "split_left_right": q_split_left_right,
    "leaf_rule_stats": q_leaf_rule_stats,
    "leaf_label_mix": q_leaf_label_mix,
    "predict_join_route": q_predict_join_route,
    "sparse_in_out_counts": q_sparse_in_out_counts,
    "candidates_nan": q_candidates_nan,
    "candidates_nan_reference": q_candidates_nan_reference,
    "best_split_unsigned": q_best_split_unsigned,
    "fit_pruned_node_table": q_fit_pruned_node_table,
    "fit_deep_node_table": q_fit_deep_node_table,
    "leaf_boxes": q_leaf_boxes,
    "predict_indexed": q_predict_indexed,
    "zero_filled_histogram": q_zero_filled_histogram,
    "frame_diff": q_frame_diff,
    "csv_inferred": q_csv_inferred,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every column of documents joined with labels, ranked by its best split."""
    return q_rank_columns_by_gini(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {**_QUERIES, **LLM_QUERIES}
    if corpus_pipeline is not None:
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = {k: v for k, v in ORACLE_SQL.items() if k in _QUERIES} | LLM_SQL
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
