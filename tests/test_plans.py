"""Physical-plan properties the design relies on at scale."""

from pyspark.sql import functions as F

from arborist import TreeSettings, fit, session
from arborist.operators import bucketing, splits, thresholds
from arborist.sources.tables import FEATURE_SETS

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_predict_is_map_only(spark):
    fs = FEATURE_SETS["orders"]
    df = fs.load(spark, SF)
    model = fit(df, fs.label, list(fs.features), TreeSettings(max_depth=2))
    for joins in (False, True):
        plan = plan_of(model.predict(df, joins=joins))
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan_of(model.predict(df, joins=True))


def test_no_routing_join_shuffles(spark, monkeypatch):
    # Also with the lowest bound, where every split is a batch of its own.
    monkeypatch.setattr(session, "BROADCAST_ROW_LIMIT", 1)
    fs = FEATURE_SETS["orders"]
    df = fs.load(spark, SF)
    model = fit(df, fs.label, list(fs.features), TreeSettings(max_depth=3))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(model.predict(df, joins=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert not any(x in plan for x in ("Exchange hashpartitioning", "SortMergeJoin", "NestedLoop"))


def test_threshold_passes_shuffle_cells_not_values(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    cells = orders.select(F.lit(1).cast("long").alias("node_id"), F.lit("p").alias("feature"),
                          F.col("o_totalprice").cast("double").alias("value"))
    distinct = cells.select("value").distinct().count()
    shuffled = thresholds._counted(cells.withColumn("cell", thresholds._scale(F.col("value"))),
                                   "node_id", "feature", "cell").count()
    assert shuffled < distinct / 4


def test_top_k_is_limited_before_the_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_of(bucketing.top_categories(docs, ["lang", "source"], 1, 3))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_reads_only_label_and_features(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    frame, _, _ = bucketing.prepare_frame(li, "l_returnflag", ["l_quantity", "l_linestatus"], TreeSettings())
    plan = plan_of(frame)
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string>" in plan


def test_level_histogram_broadcasts_thresholds(spark):
    fs = FEATURE_SETS["lineitem"]
    frame, kinds, _ = bucketing.prepare_frame(fs.load(spark, SF), fs.label, list(fs.features), TreeSettings())
    frame = frame.withColumn("node_id", F.when(F.col("l_tax") > 0.03, F.lit(2)).otherwise(F.lit(3)).cast("long"))
    hist, _, _ = splits.level_histogram(frame, fs.label, kinds, TreeSettings(), 2, freeze=lambda d: d)
    plan = plan_of(hist)
    assert "BroadcastHashJoin" in plan and "partial_count" in plan
    # The fit persists the histogram: one pass over the rows, shared by all that score it.
    hist, threshold_rows, rows = splits.level_histogram(frame, fs.label, kinds, TreeSettings(), 2)
    try:
        scored = splits.score_candidates(hist, threshold_rows, False, len(rows))
        plan = plan_of(splits.best_per_node(scored))
        assert "InMemoryTableScan" in plan and "partial_min" in plan
        above = plan.split("InMemoryRelation")[0]
        assert "FileScan" not in above
    finally:
        hist.unpersist()
