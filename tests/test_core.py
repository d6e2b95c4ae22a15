"""Operators on inline fixtures, checked against the brute-force oracle."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from arborist import FILLER_STRING, TreeSettings, fit
from arborist.functions.features import feature_kinds
from arborist import session
from arborist.operators import bucketing, thresholds
from arborist.operators.labels import majority_label
from arborist.operators.splits import with_label_totals
from arborist.plans import columns, routing
from arborist.plans.scoring import leaf_label_mix, leaf_rule_stats, split_left_right

NULLS = [
    (1.0, "a", "x"), (None, "a", "y"), (2.0, "b", "y"), (2.0, "b", "x"),
    (5.0, FILLER_STRING, "y"), (None, "b", "x"), (7.0, "a", "y"),
]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_settings_validation():
    with pytest.raises(ValueError):
        TreeSettings(max_depth=-1)
    with pytest.raises(ValueError):
        TreeSettings(min_leaf_size=0)
    with pytest.raises(ValueError):
        TreeSettings(semantics="other")
    assert TreeSettings(semantics="reference").bucketing_settings() == TreeSettings(semantics="reference")
    s = TreeSettings(max_depth=2, min_leaf_size=5, max_cardinality=3)
    assert s.bucketing_settings() is s


def test_feature_kinds(spark):
    df = spark.createDataFrame([(1, 2.0, "a", True, "y")], "i int, d double, s string, b boolean, y string")
    assert feature_kinds(df, "y", ["i", "d", "s"]) == {"i": "ordinal", "d": "ordinal", "s": "categorical"}
    with pytest.raises(ValueError, match="b: boolean"):
        feature_kinds(df, "y")
    with pytest.raises(ValueError, match="not found"):
        feature_kinds(df, "missing")
    clash = spark.createDataFrame([(1, "y")], "node_id int, y string")
    with pytest.raises(ValueError, match="collide"):
        feature_kinds(clash, "y")


def test_bucketing_nulls_cap_and_drop(spark):
    data = [("a", "p", "u")] * 5 + [("b", "q", "u")] * 5 + [("c", None, "u")] * 2 + [(None, "p", "v")] * 3
    df = spark.createDataFrame(data, "k string, m string, y string")
    out = rows_of(bucketing.bucket_rare_categories(df, TreeSettings(min_leaf_size=3, max_cardinality=1)))
    # k: a and b tie at 5, cap 1 keeps the smaller value; c (rare) and NULL become the sentinel.
    assert {r["k"] for r in out} == {"a", FILLER_STRING}
    assert sum(r["k"] == FILLER_STRING for r in out) == 10
    assert {r["m"] for r in out} == {"p", FILLER_STRING}
    # y: u (12) kept, v (3) kept at min 3, cap 1 keeps u only.
    assert {r["y"] for r in out} == {"u", FILLER_STRING}
    dropped = bucketing.droppable_columns(df, ["k", "m"], TreeSettings(min_leaf_size=100))
    assert sorted(r["column"] for r in dropped.collect()) == ["k", "m"]
    assert "k" not in bucketing.bucket_rare_categories(df, TreeSettings(min_leaf_size=100), ["k"]).columns


def test_label_not_bucketed_unless_reference(spark):
    data = [(float(i), "common") for i in range(40)] + [(100.0, "rare")]
    df = spark.createDataFrame(data, "n double, y string")
    frame, _, _ = bucketing.prepare_frame(df, "y", ["n"], TreeSettings())
    assert {r["y"] for r in frame.collect()} == {"common", "rare"}
    frame, _, _ = bucketing.prepare_frame(df, "y", ["n"], TreeSettings(semantics="reference"))
    assert {r["y"] for r in frame.collect()} == {"common", FILLER_STRING}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_exact_quantiles_match_nearest_rank(spark, parts):
    rnd = random.Random(parts)
    rows = []
    for node in (1, 2, 3):
        for f in ("u", "v"):
            n = rnd.randint(1, 60)
            for _ in range(n):
                v = None if rnd.random() < 0.1 else float(rnd.choice(range(0, 12 * node)))
                rows.append((node, f, v))
    df = spark.createDataFrame(rows, "node_id long, feature string, value double")
    got = {(r["node_id"], r["feature"], r["q_index"]): r["threshold"]
           for r in thresholds.exact_quantiles(df.repartition(parts)).collect()}
    for node in (1, 2, 3):
        for f in ("u", "v"):
            vals = [v for (nn, ff, v) in rows if nn == node and ff == f]
            for i, q in enumerate(brute.QUANTILES):
                assert got.get((node, f, i)) == brute.nearest_rank(vals, q)


def _quantiles(spark, values):
    df = spark.createDataFrame([(1, "f", v) for v in values], "node_id long, feature string, value double")
    got = sorted(thresholds.exact_quantiles(df.repartition(5)).collect(), key=lambda r: r["q_index"])
    return [r["threshold"] for r in got]


def test_exact_quantiles_of_many_distinct_values(spark):
    vals = [float(v) for v in range(1000)] + [500.0] * 300
    assert _quantiles(spark, vals) == [brute.nearest_rank(vals, q) for q in brute.QUANTILES]


def test_exact_quantiles_need_several_passes(spark, monkeypatch):
    # Two parts per cell: every pass only halves a cell, so the rank is found in many passes.
    monkeypatch.setattr(thresholds, "PARTS", 2)
    vals = [1000.0 + i * 1e-9 for i in range(200)] + [-5e-324, 0.0, -0.0, 5e-324, -1e308, 1e308]
    assert _quantiles(spark, vals) == [brute.nearest_rank(vals, q) for q in brute.QUANTILES]


def test_exact_quantiles_of_extreme_values(spark):
    inf = float("inf")
    vals = [-inf, -1e308, -2.5, -2.5, -1e-300, 0.0, 1e-300, 3.0, 1e308, inf, inf]
    assert _quantiles(spark, vals) == [brute.nearest_rank(vals, q) for q in brute.QUANTILES]
    nan = float("nan")
    got = _quantiles(spark, [nan] * 5 + [1.0] * 5)
    assert got[:4] == [1.0] * 4 and all(v != v for v in got[4:])


def test_nan_thresholds_merge_in_any_order():
    nan = float("nan")
    rows = [(1, "f", i, 0.1, t) for i, t in enumerate([1.0, float("nan"), 0.5, nan, -0.0, 0.0])]
    got = thresholds.distinct_threshold_rows(rows)
    assert [(r[2], r[4]) for r in got] == [(1, 2), (2, 1), (3, 1), (4, 2)]
    assert [r[3] for r in got[:3]] == [0.0, 0.5, 1.0] and got[3][3] != got[3][3]


def test_nan_is_one_candidate(spark):
    data = [(float("nan") if i % 10 < 4 else float(i % 100), "ab"[i % 3 == 0]) for i in range(1000)]
    df = spark.createDataFrame(data, "n double, y string")
    for semantics in ("consistent", "reference"):
        got = columns.candidate_splits(df, "y", ["n"], TreeSettings(semantics=semantics)).collect()
        assert sum(r["threshold"] != r["threshold"] for r in got) == 1


@pytest.mark.parametrize("value", ["${env:HOME}", "${spark.app.name}", "it's", 'say "x"', "back\\slash", "new\nline", ""])
def test_values_are_never_read_as_sql(spark, value):
    data = [(value, "a")] * 40 + [("other", "b")] * 40
    df = spark.createDataFrame(data, "k string, y string")
    model = fit(df, "y", ["k"], TreeSettings(max_depth=1))
    want = sorted(data)
    for joins in (False, True):
        assert sorted((r["k"], r["PREDICTED_LABEL"]) for r in model.predict(df, joins=joins).collect()) == want
    assert model.nodes[1].category in {r["category"] for r in model.node_table(spark).collect()}
    labels = fit(spark.createDataFrame([(1.0, value)] * 40 + [(2.0, "b")] * 40, "n double, y string"), "y", ["n"],
                 TreeSettings(max_depth=1))
    assert {r["label"] for r in labels.node_table(spark).collect()} == {None, value, "b"}


def test_in_out_counts_hold_labels_without_left_rows(spark):
    df = spark.createDataFrame([(1, "k1", "a")] * 40 + [(2, "k2", "b")] * 40, "n int, k string, y string")
    out = columns.in_out_counts(df, "y", ["n", "k"]).collect()
    got = {(r["threshold"], r["category"], r["label"]): (r["cnt_in"], r["cnt_out"]) for r in out}
    assert got[2.0, None, "a"] == (0, 40) and got[None, "k1", "b"] == (0, 40) and got[None, "k2", "a"] == (0, 40)
    totals = {(r["threshold"], r["category"]): (r["n_left"], r["n_right"])
              for r in columns.candidate_splits(df, "y", ["n", "k"]).collect()}
    for (t, c), sides in totals.items():
        mine = [v for k, v in got.items() if k[:2] == (t, c)]
        assert tuple(map(sum, zip(*mine))) == sides


def test_null_label_policy(spark):
    df = spark.createDataFrame([(1.0, "a")] * 40 + [(2.0, None)], "n double, y string")
    assert bucketing.prepare_frame(df, "y", ["n"])[0].count() == 40
    with pytest.raises(ValueError, match="null values"):
        fit(df, "y", ["n"], TreeSettings(null_label="error"))
    with pytest.raises(ValueError, match="null_label"):
        TreeSettings(null_label="guess")


def test_outputs_never_overwrite_columns(spark):
    df = spark.createDataFrame([(float(i), "a" if i < 50 else "b", 7, 8, 9) for i in range(100)],
                               "n double, y string, side int, predicted_label int, node_id int")
    model = fit(df.select("n", "y"), "y", ["n"], TreeSettings(max_depth=1))
    for call in (lambda: split_left_right(model, df), lambda: model.predict(df), lambda: model.leaf_assignment(df)):
        with pytest.raises(ValueError, match="already has a column"):
            call()
    assert model.predict(df, output_col="mine").where("node_id = 9").count() == 100


def test_unsigned_feature(spark):
    df = spark.createDataFrame([(i, "a" if i < 50 else "b") for i in range(100)], "u long, y string")
    df = df.withColumn("u", F.col("u").cast("decimal(20,0)"))
    assert feature_kinds(df, "y") == {"u": "ordinal"}
    model = fit(df, "y", ["u"], TreeSettings(max_depth=1))
    assert model.nodes[1].threshold == 50.0
    with pytest.raises(ValueError, match="decimal"):
        feature_kinds(df.withColumn("u", F.col("u").cast("decimal(20,2)")), "y")


def test_leaf_without_rows_is_listed(spark):
    data = [(float(i), "a" if i < 50 else "b") for i in range(100)]
    df = spark.createDataFrame(data, "n double, y string")
    model = fit(df, "y", ["n"], TreeSettings(max_depth=1))
    stats = {r["rule"]: (r["n_rows"], r["n_correct"]) for r in leaf_rule_stats(model, df.where("n < 50")).collect()}
    assert stats == {"n >= 50.0": (0, 0), "n < 50.0": (50, 50)}
    mix = {(r["node_id"], r["actual"]): r["cnt"] for r in leaf_label_mix(model, df).collect()}
    assert mix == {(2, "b"): 50, (3, "a"): 50}


@pytest.mark.parametrize("semantics", ["consistent", "reference"])
def test_candidates_match_brute_force(spark, semantics):
    # Integer label: reference semantics would bucket a 7-row string label away.
    data = [(n, k, 0 if y == "x" else 1) for n, k, y in NULLS]
    df = spark.createDataFrame(data, "n double, k string, y int")
    settings = TreeSettings(min_leaf_size=1, semantics=semantics)
    got = rows_of(columns.candidate_splits(df, "y", ["n", "k"], settings))
    frame, kinds, _ = bucketing.prepare_frame(df, "y", ["n", "k"], settings)
    want = brute.candidates(rows_of(frame), "y", kinds, reference=semantics == "reference")
    key = lambda c: (c["feature"], c["threshold"] or 0.0, c["category"] or "")
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert (g["feature"], g["threshold"], g["category"]) == (w["feature"], w["threshold"], w["category"])
        assert (g["n_left"], g["n_right"]) == (w["n_left"], w["n_right"])
        assert close(g["child_gini"], w["score"])
    # The sentinel is never a candidate.
    assert FILLER_STRING not in {g["category"] for g in got}


def test_tied_quantiles_reference_multiplicity(spark):
    # 10 rows, 2 values: most quantiles tie on the same threshold.
    df = spark.createDataFrame([(1.0, 0)] * 6 + [(2.0, 1)] * 4, "n double, y int")
    ref = rows_of(columns.candidate_splits(df, "y", ["n"], TreeSettings(semantics="reference")))
    con = rows_of(columns.candidate_splits(df, "y", ["n"], TreeSettings()))
    t2_ref = [r for r in ref if r["threshold"] == 2.0][0]
    t2_con = [r for r in con if r["threshold"] == 2.0][0]
    assert (t2_con["n_left"], t2_con["n_right"]) == (4, 6) and close(t2_con["child_gini"], 0.0)
    # nearest ranks of the grid over 10 values: 1,2,3,4,5,5,6,8 -> value 2.0 for ranks >= 6: q=.7 and .9
    assert (t2_ref["n_left"], t2_ref["n_right"]) == (8, 12)
    assert close(t2_ref["child_gini"], 0.5)


def test_constant_feature_gives_leaf(spark):
    df = spark.createDataFrame([(3.0, "a")] * 40 + [(3.0, "b")] * 30, "n double, y string")
    model = fit(df, "y", ["n"], TreeSettings())
    assert len(model.nodes) == 1 and model.nodes[1].label == "a" and not model.nodes[1].is_split


def test_boundary_routing_ge_vs_gt(spark):
    data = [(1, "lo")] * 40 + [(5, "hi")] * 40 + [(9, "hi")] * 40
    df = spark.createDataFrame(data, "n int, y string")
    con = fit(df, "y", ["n"], TreeSettings(max_depth=1))
    assert con.nodes[1].threshold == 5.0
    assert con.nodes[2].n_rows == 80 and con.nodes[2].label == "hi"
    ref = fit(df, "y", ["n"], TreeSettings(max_depth=1, semantics="reference"))
    # Scored with >= but routed with >: rows equal to the threshold go right.
    assert ref.nodes[2].n_rows == 40 and ref.nodes[3].n_rows == 80


def test_predict_keeps_rows_and_reference_drops_nulls(spark):
    data = [(float(i % 10) if i % 7 else None, "a" if i % 10 < 5 else "b") for i in range(200)]
    df = spark.createDataFrame(data, "n double, y string")
    con = fit(df, "y", ["n"], TreeSettings(max_depth=2, min_leaf_size=5))
    pred = con.predict(df)
    assert pred.count() == 200 and pred.where(F.col("PREDICTED_LABEL").isNull()).count() == 0
    ref = fit(df, "y", ["n"], TreeSettings(max_depth=2, min_leaf_size=5, semantics="reference"))
    n_null = sum(1 for r in data if r[0] is None)
    assert ref.predict(df).count() == 200 - n_null


@pytest.mark.parametrize("semantics", ["consistent", "reference"])
@pytest.mark.parametrize("depth,min_leaf", [(0, 32), (1, 32), (3, 5), (4, 20)])
def test_fit_matches_brute_force(spark, semantics, depth, min_leaf):
    rnd = random.Random(depth * 100 + min_leaf)
    data = []
    for _ in range(300):
        a = None if rnd.random() < 0.05 else float(rnd.randint(0, 30))
        b = rnd.choice(["p", "q", "r", "s", "t"] + ["rare%d" % rnd.randint(0, 50)])
        c = rnd.randint(0, 4)
        y = "X" if (a or 0) > 12 and b in "pq" else ("Y" if c > 2 else rnd.choice("XYZ"))
        data.append((a, b, c, y))
    df = spark.createDataFrame(data, "a double, b string, c int, y string")
    settings = TreeSettings(max_depth=depth, min_leaf_size=min_leaf, semantics=semantics)
    model = fit(df, "y", ["a", "b", "c"], settings)
    frame, kinds, _ = bucketing.prepare_frame(df, "y", ["a", "b", "c"], settings)
    want = brute.fit([r.asDict() for r in frame.collect()], "y", kinds, depth, min_leaf, semantics == "reference")
    assert set(model.nodes) == set(want)
    for node_id, w in want.items():
        n = model.nodes[node_id]
        assert (not n.is_split) == w["is_leaf"], node_id
        assert n.depth == w["depth"] and n.n_rows == w["n_rows"], node_id
        if w["is_leaf"]:
            assert n.label == w["label"], node_id
        else:
            assert (n.feature, n.threshold, n.category) == (w["feature"], w["threshold"], w["category"])
            assert (n.n_left, n.n_right) == (w["n_left"], w["n_right"])


def test_scoring_helpers(spark):
    data = [(float(i), "a" if i < 50 else "b") for i in range(100)]
    df = spark.createDataFrame(data, "n double, y string").withColumn("id", F.monotonically_increasing_id())
    model = fit(df, "y", ["n"], TreeSettings(max_depth=1))
    sides = {r["side"]: r["count"] for r in split_left_right(model, df).groupBy("side").count().collect()}
    assert sides == {"left": 50, "right": 50}
    stats = rows_of(leaf_rule_stats(model, df))
    assert sum(r["n_rows"] for r in stats) == 100 and all(r["n_rows"] == r["n_correct"] for r in stats)
    assert {r["rule"] for r in stats} == {"n >= 50.0", "n < 50.0"}
    assigned = model.leaf_assignment(df)
    assert assigned.select("node_id").distinct().count() == 2


def test_label_totals_stay_within_a_node(spark):
    schema = "node_id long, feature string, kind string, bucket int, category string, label string, cnt long"
    cells = [(1, "f", "categorical", None, "a", "x", 3), (1, "f", "categorical", None, "b", "x", 2),
             (2, "f", "categorical", None, "a", "x", 5)]
    out = with_label_totals(spark.createDataFrame(cells, schema), False)
    assert sorted((r["node_id"], r["category"], r["base"]) for r in out.collect()) == [(1, "a", 5), (1, "b", 5), (2, "a", 5)]


def test_majority_label(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("j", None)], "g string, y string")
    out = {r["g"]: (r["label"], r["cnt"], r["n_rows"]) for r in majority_label(df, ["g"], "y").collect()}
    assert out == {"k": ("a", 2, 4), "j": (None, 1, 1)}


def test_rank_columns_order_and_informative(spark):
    data = [(float(i), i % 2, "a" if i < 60 else "b", "P" if i < 60 else "Q") for i in range(120)]
    df = spark.createDataFrame(data, "n double, parity int, k string, y string")
    ranked = sorted(rows_of(columns.rank_columns_by_gini(df, "y", ["n", "parity", "k"])), key=lambda r: r["rank"])
    assert ranked[0]["child_gini"] == 0.0
    assert [r["rank"] for r in ranked] == [1, 2, 3]
    info = {r["feature"] for r in columns.informative_columns(df, "y", ["n", "parity", "k"]).collect()}
    assert info == {"n", "parity", "k"}


@pytest.mark.parametrize("semantics", ["consistent", "reference"])
def test_join_routing_matches_expression_routing(spark, semantics):
    rnd = random.Random(11)
    data = [(i, None if rnd.random() < 0.05 else float(rnd.randint(0, 50)), rnd.choice("pqrs"), rnd.choice("XYZ"))
            for i in range(600)]
    df = spark.createDataFrame(data, "id long, a double, b string, y string")
    model = fit(df, "y", ["a", "b"], TreeSettings(max_depth=5, min_leaf_size=5, semantics=semantics))
    assert sum(n.is_split for n in model.nodes.values()) > 3
    by_expr = {(r["id"], r["node_id"]) for r in model.leaf_assignment(df, joins=False).collect()}
    by_join = {(r["id"], r["node_id"]) for r in model.leaf_assignment(df, joins=True).collect()}
    assert by_expr == by_join
    p_expr = {(r["id"], r["PREDICTED_LABEL"]) for r in model.predict(df, joins=False).collect()}
    p_join = {(r["id"], r["PREDICTED_LABEL"]) for r in model.predict(df, joins=True).collect()}
    assert p_expr == p_join and len(p_expr) == len(by_expr)


def test_csv_source_with_inferred_schema(spark, tmp_path):
    from arborist.sources.tables import read_csv

    path = tmp_path / "passengers.csv"
    lines = ["fare,port,klass"] + [f"{10 + (i % 50)}.5,{'CQS'[i % 3]},{1 if i % 50 > 30 else 3}" for i in range(300)]
    path.write_text("\n".join(lines) + "\n")
    df = read_csv(spark, str(path))
    assert dict(df.dtypes) == {"fare": "double", "port": "string", "klass": "int"}
    model = fit(df, "klass", None, TreeSettings(max_depth=1))
    assert model.nodes[1].is_split and model.nodes[1].feature == "fare"
    assert {model.nodes[2].label, model.nodes[3].label} == {"1", "3"}


def test_approx_threshold_mode_fits(spark):
    data = [(float(i), "a" if i < 300 else "b") for i in range(1000)]
    df = spark.createDataFrame(data, "n double, y string")
    model = fit(df, "y", ["n"], TreeSettings(max_depth=1, threshold_mode="approx"))
    root = model.nodes[1]
    assert root.is_split and root.threshold in {float(i) for i in range(1000)}
    assert model.predict(df).count() == 1000


def test_candidates_equal_with_tolerance(spark):
    from pyspark.testing import assertDataFrameEqual

    df = spark.createDataFrame(NULLS, "n double, k string, y string")
    settings = TreeSettings(min_leaf_size=1)
    got = columns.candidate_splits(df, "y", ["n", "k"], settings).select(
        "feature", "threshold", "category", "n_left", "n_right", "child_gini")
    frame, kinds, _ = bucketing.prepare_frame(df, "y", ["n", "k"], settings)
    want = [(c["feature"], c["threshold"], c["category"], c["n_left"], c["n_right"], c["score"])
            for c in brute.candidates(rows_of(frame), "y", kinds)]
    expected = spark.createDataFrame(
        want, "feature string, threshold double, category string, n_left long, n_right long, child_gini double")
    assertDataFrameEqual(got, expected, rtol=1e-9, atol=1e-9)


def test_fit_in_batches_matches_brute_force(spark, monkeypatch):
    # Bounds so small that every level runs node by node and every routing
    # join takes one split at a time.
    monkeypatch.setattr(session, "BROADCAST_ROW_LIMIT", 1)
    monkeypatch.setattr(routing, "EXPRESSION_MAX_SPLITS", 0)
    rnd = random.Random(5)
    data = [(float(rnd.randint(0, 40)), rnd.choice("pq"), rnd.choice("XY") if rnd.random() < 0.5 else "Z")
            for _ in range(400)]
    df = spark.createDataFrame(data, "a double, b string, y string")
    settings = TreeSettings(max_depth=3, min_leaf_size=10)
    model = fit(df, "y", ["a", "b"], settings)
    frame, kinds, _ = bucketing.prepare_frame(df, "y", ["a", "b"], settings)
    want = brute.fit([r.asDict() for r in frame.collect()], "y", kinds, 3, 10)
    assert set(model.nodes) == set(want)
    for node_id, w in want.items():
        n = model.nodes[node_id]
        assert n.n_rows == w["n_rows"] and (not n.is_split) == w["is_leaf"]
        if not w["is_leaf"]:
            assert (n.feature, n.threshold, n.category) == (w["feature"], w["threshold"], w["category"])
