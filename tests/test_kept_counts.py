"""Kept cell counts, row numbers, zero fill, leaf boxes, frame comparison, CSV types."""

import math
import random

import pytest
from pyspark.sql import functions as F

from arborist import TreeSettings, fit
from arborist.operators import cells
from arborist.operators.compare import frame_diff
from arborist.operators.ordering import restore_order, with_row_index
from arborist.plans import columns, tree
from arborist.plans.scoring import leaf_boxes, predict_indexed
from arborist.sources.tables import infer_text_types, read_csv_inferred


@pytest.fixture
def frame(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        k = rnd.choice("abc")
        n = rnd.choice([None, 0.0, -3.5, float("nan"), rnd.gauss(100, 30), rnd.gauss(100, 0.001)])
        y = "x" if (k == "a") != (n is not None and n > 90) else rnd.choice("yz")
        rows.append((i, n, rnd.randint(0, 3), k, 7, y))
    return spark.createDataFrame(rows, "id int, n double, m int, k string, one int, y string").repartition(3)


FEATURES = ["n", "m", "k", "one"]


@pytest.fixture
def recorded(monkeypatch):
    kept = []
    init = tree._KeptCounts.__init__
    monkeypatch.setattr(tree._KeptCounts, "__init__", lambda self, *a: (init(self, *a), kept.append(self))[0])
    return kept


def test_larger_children_and_constant_features_are_not_counted(frame, recorded):
    model = fit(frame, "y", FEATURES, TreeSettings(max_depth=4, min_leaf_size=5))
    counted = recorded[0].counted
    assert counted[0] == [(1, 4)]
    for run in counted[1:]:
        for node, features in run:
            size = lambda i: model.nodes[i].n_rows
            assert size(node) <= size(node ^ 1)
            assert features <= 3  # ``one`` is constant at the root
    below_k = [n for n in model.nodes.values() if n.feature == "k" and n.is_split]
    again = {f for run in counted for n, f in run}
    assert not below_k or min(again) <= 3


def test_subtracted_counts_equal_counted_ones(frame):
    kinds = {"n": "ordinal", "m": "ordinal", "k": "categorical"}
    rows = cells.encoded(frame.select("n", "m", "k", "y"), kinds)
    enc = cells.encoding("y", kinds, {"k": ["a", "b", "c"]})
    parents = cells.count_cells(rows.withColumn("node_id", F.lit(1).cast("long")), enc, [1], {})
    routed = rows.withColumn("node_id", F.when(F.col("m") >= 3, F.lit(2)).otherwise(F.lit(3)).cast("long"))
    key = ["node_id", *cells.KEYS, "cnt"]
    got = cells.next_cells(parents, routed, enc, {1: 2}, [2, 3], {}).select(*key)
    want = cells.count_cells(routed, enc, [2, 3], {}).select(*key)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    only_large = cells.next_cells(parents, routed, enc, {1: 2}, [3], {1: {1}})
    assert {(r["node_id"], r["feature"]) for r in only_large.collect()} == {(3, 0), (3, 2)}


@pytest.mark.parametrize("semantics", ["consistent", "reference"])
def test_written_node_ids_give_the_same_tree(frame, monkeypatch, semantics):
    settings = TreeSettings(max_depth=5, min_leaf_size=5, semantics=semantics)
    want = repr(fit(frame, "y", FEATURES, settings).node_rows())  # as text: a threshold may be NaN
    monkeypatch.setattr(tree, "ROUTE_LEVELS", 2)
    assert repr(fit(frame, "y", FEATURES, settings).node_rows()) == want


def test_levels_route_one_depth_and_small_tables_take_few_tasks(spark, frame, recorded, monkeypatch):
    settings = TreeSettings(max_depth=4, min_leaf_size=5)
    want = repr(fit(frame, "y", FEATURES, settings).node_rows())
    steps, tasks = [], []
    route, batch, parts = tree.assign_leaves, tree._KeptCounts._batch, cells._ranked_parts

    def routed(df, nodes, *args, **kw):
        steps.append((kw["start"], max((n.depth for n in nodes.values() if n.is_split), default=-1)))
        return route(df, nodes, *args, **kw)

    def seen(df):
        tasks.append(df.rdd.getNumPartitions())
        return df

    monkeypatch.setattr(tree, "assign_leaves", routed)
    monkeypatch.setattr(tree._KeptCounts, "_batch", lambda self, rows, table, ids: batch(self, rows, seen(table), ids))
    monkeypatch.setattr(cells, "_ranked_parts", lambda df, opened: parts(seen(df), opened))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert repr(fit(frame, "y", FEATURES, settings).node_rows()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert steps == [(0, -1), (0, 0), (1, 1), (2, 2), (3, 3)]  # the levels, then the leaves
    assert len(tasks) >= 8 and set(tasks) == {1}


@pytest.mark.parametrize("semantics", ["consistent", "reference"])
def test_numbered_rows_give_the_same_tree(spark, monkeypatch, semantics):
    rnd = random.Random(5)
    cats, ys = ["\U0001f600", "\uffee", "FILLER_STRING", "a", None], ["\U0001f600", "\uffee", "", "b"]
    rows = [(rnd.choice(cats), rnd.choice([None, 1, 2, 3, 40]), rnd.choice(ys)) for _ in range(800)]
    if semantics == "reference":  # its routing loses NULL categories, its fit does not
        rows = [(c or "a", n, y) for c, n, y in rows]
    df = spark.createDataFrame([(c, n, y if c != "a" else "b") for c, n, y in rows], "c string, n int, y string")
    settings = TreeSettings(max_depth=3, min_leaf_size=5, semantics=semantics)
    model = fit(df, "y", ["c", "n"], settings)
    assert {n.category for n in model.nodes.values() if n.kind == "categorical"} <= set(cats[:2]) | {"a"}
    at = model.leaf_assignment(df).groupBy("node_id", "y").count().collect()
    by: dict = {}
    for r in at:
        by.setdefault(r["node_id"], []).append((-r["count"], r["y"].encode(), r["y"]))
    for leaf in model.leaves():
        if leaf.node_id in by:
            assert leaf.label == min(by[leaf.node_id])[2] and leaf.n_rows == -sum(c for c, _, _ in by[leaf.node_id])
    monkeypatch.setattr(cells, "BROADCAST_ROW_LIMIT", 2)  # more labels than that stay as they are
    assert repr(fit(df, "y", ["c", "n"], settings).node_rows()) == repr(model.node_rows())
    assert repr(fit(df, "y", ["c", "n"], settings.with_(persist_input=False)).node_rows()) == repr(model.node_rows())


def test_row_index(spark):
    df = spark.range(5_000, numPartitions=7).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("v"))
    scan = with_row_index(df).collect()
    assert sorted(r["row_index"] for r in scan) == list(range(5_000)) and all(r["id"] == r["row_index"] for r in scan)
    by = sorted((r["row_index"], r["v"], r["id"]) for r in with_row_index(df, F.asc_nulls_last("v"), name="at").withColumnRenamed("at", "row_index").collect())
    assert [b[0] for b in by] == list(range(5_000))
    assert [(b[1] is None, b[1] or 0, b[2]) for b in by] == sorted((b[1] is None, b[1] or 0, b[2]) for b in by)
    plan = with_row_index(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert [r["id"] for r in restore_order(with_row_index(df, F.desc("id"))).collect()] == list(range(4_999, -1, -1))
    assert with_row_index(df.where("false"), "v").count() == 0
    with pytest.raises(ValueError):
        with_row_index(df, name="ID")


def test_predictions_keep_the_order(frame):
    model = fit(frame, "y", ["m", "k"], TreeSettings(max_depth=2, min_leaf_size=5))
    rows = predict_indexed(model, frame, F.desc("id")).collect()
    assert [r["row_index"] for r in rows] == list(range(600)) and [r["id"] for r in rows] == list(range(599, -1, -1))
    want = {r["id"]: r["PREDICTED_LABEL"] for r in model.predict(frame).collect()}
    assert all(want[r["id"]] == r["PREDICTED_LABEL"] for r in rows)


def test_zero_fill_without_a_grid(spark):
    # Two values and three labels, three pairs of which occur: six rows.
    df = spark.createDataFrame([("A", "X"), ("B", "Y"), ("A", "Z")], "col1 string, col2 string")
    out = columns.zero_filled_histogram(df, "col2", ["col1"], TreeSettings(min_leaf_size=1))
    assert sorted((r["category"], r["label"], r["cnt"]) for r in out.collect()) == [
        ("A", "X", 1), ("A", "Y", 0), ("A", "Z", 1), ("B", "X", 0), ("B", "Y", 1), ("B", "Z", 0)]
    assert "Cartesian" not in out._jdf.queryExecution().executedPlan().toString()


def test_leaf_boxes_are_disjoint_and_count_their_rows(spark, frame):
    model = fit(frame, "y", FEATURES, TreeSettings(max_depth=4, min_leaf_size=5))
    by: dict = {n.node_id: [] for n in model.leaves()}
    for r in leaf_boxes(model.node_table(spark)).collect():
        by[r["node_id"]].append(r)

    def inside(row, box):
        v = row[box["feature"]]
        if box["kind"] == "categorical":
            return v == box["category"] if box["category"] is not None else v not in (box["excluded"] or "").split(",")
        if v is None:
            return box["lo"] is None
        order = lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x)  # noqa: E731  NaN is the largest
        return (box["lo"] is None or order(v) >= order(box["lo"])) and (box["hi"] is None or order(v) < order(box["hi"]))

    hits = {n: 0 for n in by}
    for row in frame.collect():
        found = [n for n, boxes in by.items() if all(inside(row, b) for b in boxes)]
        assert len(found) == 1
        hits[found[0]] += 1
    assert hits == {n.node_id: n.n_rows for n in model.leaves()}


def test_frame_diff(spark):
    schema = "k int, v double, s string"
    nan, inf = float("nan"), float("inf")
    a = [(1, 1.0, "x"), (1, 2.0, "x"), (2, nan, None), (3, inf, "y"), (4, 5.0, "z"), (None, 1.0, "n"), (6, 1.0, "c"), (6, 1.0, "c"), (7, 0.0, "t")]
    b = [(1, 2.0, "x"), (1, 1.0 + 1e-9, "x"), (2, nan, None), (3, -inf, "y"), (4, 5.5, None), (None, 1.0, "n"), (6, 1.0, "c"), (8, 1.0, "q"), (7, 0.4, "t")]
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    got = sorted(((r["k"], r["place"], r["status"], r["column"], r["left_value"], r["right_value"])
                  for r in frame_diff(left, right, ["k"], tolerances={"v": (0.0, 0.4)}).collect()), key=repr)
    assert got == [
        (3, 0, "differs", "v", "Infinity", "-Infinity"), (4, 0, "differs", "s", "z", None), (4, 0, "differs", "v", "5.0", "5.5"),
        (6, 0, "left_only", None, None, None), (8, 0, "right_only", None, None, None),
    ]
    assert frame_diff(left, left.repartition(5), ["k"]).count() == 0
    many = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(1.0).alias("v"), F.lit("h").alias("s"))
    assert frame_diff(many, many.limit(19_998), ["k"]).count() == 2
    with pytest.raises(ValueError):
        frame_diff(left, right.drop("s"), ["k"])
    with pytest.raises(ValueError):
        frame_diff(left, right.withColumn("v", F.col("v").cast("float")), ["k"])


def test_text_types(spark):
    rows = [("1", "1", "1.5", "true", "2020-01-31", "2020-01-31 10:00:00", "x", None), ("-7", "9" * 19, "1e3", "FALSE", "1999-12-01", "2020-02-01T00:00:01.5", "1", None),
            (None, "2", "NaN", None, None, None, "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string, h string").repartition(3)
    assert infer_text_types(df) == {"a": "bigint", "b": "double", "c": "double", "d": "boolean", "e": "date", "f": "timestamp_ntz", "g": "string", "h": "string"}
    assert infer_text_types(df.where("false"), ["a"]) == {"a": "string"}


def test_csv_lines_with_other_field_counts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2\n3,\"y,z\"\n4,a,b\n")
    (tmp_path / "b.csv").write_text("id,name\n5,\n4,a,b\n")
    rows, bad = read_csv_inferred(spark, str(tmp_path), ["id", "name"])
    assert sorted((r["id"], r["name"]) for r in rows.where("id <> 5").collect()) == [(1, "x"), (3, "y,z")]
    assert rows.where("id = 5").first()["name"] is None and rows.schema["id"].dataType.simpleString() == "bigint"
    assert sorted((r["line"], r["n"]) for r in bad.collect()) == [("2", 1), ("4,a,b", 2)]
