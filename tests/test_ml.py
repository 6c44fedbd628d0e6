"""Training and attribution: rows, AUC above chance on separable data, additivity."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import attribution as attr
from riskframe.operators import metrics as met
from riskframe.operators import train as tr


def _separable(spark, n=400):
    df = spark.range(n).select(F.col("id").alias("k"), F.rand(11).alias("a"), F.rand(12).alias("b"),
                               F.rand(13).alias("c"))
    return df.withColumn("label", ((F.col("a") + 0.5 * F.col("b")) > 0.75).cast("int"))


def test_models_beat_chance(spark):
    df = _separable(spark)
    vec = tr.assemble(df, ["a", "b", "c"], ["k", "label"])
    train, valid = vec.where("k % 4 != 0"), vec.where("k % 4 = 0")
    total = tr.total_weight(train, "label", "balanced")
    for est, scheme in [(tr.logistic(1.0, total), "balanced"), (tr.boosted_trees(10, 0.3, 3, 5), "pos_ratio"),
                        (tr.random_forest(10, 5, 2), "balanced")]:
        _m, scores = tr.fit_and_score(est, train, valid, "k", "label", "m", scheme)
        auc = met.roc_auc(scores).first().roc_auc
        assert auc > 0.8


def _brute_shap(tree, x, n):
    """Exact Shapley values of the path-dependent conditional expectation."""
    def cond_exp(node, s):
        if tree.left[node] < 0:
            return tree.value[node]
        f = tree.feature[node]
        l, r = tree.left[node], tree.right[node]
        if f in s:
            return cond_exp(l if x[f] <= tree.threshold[node] else r, s)
        c = tree.cover[node]
        return (tree.cover[l] * cond_exp(l, s) + tree.cover[r] * cond_exp(r, s)) / c

    phi = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for sub in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                phi[i] += w * (cond_exp(0, set(sub) | {i}) - cond_exp(0, set(sub)))
    return phi


def test_tree_shap_matches_brute_force_and_adds_up(spark, tmp_path):
    df = _separable(spark)
    vec = tr.assemble(df, ["a", "b", "c"], ["k", "label"])
    model = tr.boosted_trees(5, 0.5, 3, 5, subsample=1.0, feature_fraction=1.0).fit(
        tr.with_weights(vec, "label", "none"))
    trees = attr.read_trees(model, str(tmp_path / "gbt"))
    rows = vec.orderBy("k").limit(5).collect()
    base = attr.base_value(trees)
    for r in rows:
        x = r.features.toArray()
        phi = attr.ensemble_contributions(trees, x[None])[0]
        brute = 2.0 * sum(t.weight * _brute_shap(t, x, 3) for t in trees)
        assert np.allclose(phi, brute, atol=1e-9)
        margin = sum(t.weight * _leaf_value(t, x) for t in trees)
        assert math.isclose(base + phi.sum(), 2.0 * margin, abs_tol=1e-9)
    long = attr.attribute(model, vec.limit(20), "k", ["a", "b", "c"], str(tmp_path / "gbt2"))
    assert long.count() == 60 and long.rdd.getNumPartitions() > 1
    whole = attr.ensemble_contributions(trees, np.stack([r.features.toArray() for r in vec.orderBy("k").limit(20).collect()]))
    got = {(r.k, r.feature): r.contribution for r in long.collect()}
    assert all(math.isclose(got[k, f], whole[k, j], abs_tol=1e-9) for k in range(20) for j, f in enumerate("abc"))


def _leaf_value(tree, x):
    node = 0
    while tree.left[node] >= 0:
        node = tree.left[node] if x[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
    return tree.value[node]


def test_grids_blend_and_boards_of_trained_models(spark):
    from riskframe.plans import modeling as mdl

    sf = "/root/testdata/sf0.001"
    tables = [mdl.forest_grid(spark, sf, {"n_estimators": [3], "max_depth": [None], "min_samples_leaf": [5], "min_samples_split": [10, 20]}),
              mdl.boosted_grid(spark, sf, {"n_estimators": [2], "learning_rate": [0.05], "num_leaves": [7], "min_child_samples": [5]}),
              mdl.network_grid(spark, sf, {"hidden_dims": [(4, 3)], "dropout": [0.2], "learning_rate": [0.001], "epochs": [3]})]
    assert [t.count() for t in tables] == [2, 1, 1]
    assert [len(tr.expand_grid(g)) for g in (mdl.LOGISTIC_GRID, mdl.FOREST_GRID, mdl.BOOSTED_GRID, mdl.NETWORK_GRID)] == [3, 24, 24, 24]
    sweep = mdl.hybrid_sweep(spark, sf, n_iter=2).collect()
    assert len(sweep) == 5 and sweep[0].roc_auc >= sweep[-1].roc_auc
    board = {(r.kind, r.model) for r in mdl.trained_leaderboard(spark, sf, n_iter=2).collect()}
    assert board == {(k, m) for k in ("default", "tuned") for m in ("boosted_trees", "logistic_regression", "hybrid")}
    losses = [x for _, x in mdl.network_history(mdl.train_network(spark, sf, (4, 3), epochs=5)[0])]
    assert len(losses) == 5 and losses[-1] <= losses[0]


def test_label_guard_and_reorder(spark):
    import pytest
    from riskframe.plans import modeling as mdl

    a = spark.createDataFrame([(1, 0, 0.2), (2, 1, 0.7)], "k long, label int, score double")
    b = spark.createDataFrame([(1, 0, 0.3), (2, 0, 0.6)], "k long, label int, score double")
    assert met.align_scores(a, a, ["k"]).count() == 2
    with pytest.raises(Exception, match="labels of the two score tables differ"):
        met.align_scores(a, b, ["k"]).collect()
    got = mdl.reorder(spark.createDataFrame([("x", 1), ("y", 2)], "experiment string, v int"), ["y", "z", "x"]).collect()
    assert [(r.experiment, r.v) for r in got] == [("y", 2), ("z", None), ("x", 1)]


def test_sparse_one_hot(spark):
    from riskframe.operators import prepare as prep

    df = spark.createDataFrame([(i, f"c{i % 1500}") for i in range(3000)] + [(-1, None)], "k int, c string")
    rows = prep.one_hot_vectors(df, ["c"]).collect()
    assert {r.c_onehot.size for r in rows} == {1501} and all(r.c_onehot.values.tolist() == [1.0] for r in rows)


def test_grids_run_side_by_side_and_go_on_after_a_stop(spark, tmp_path):
    import pytest

    vec = tr.assemble(_separable(spark, 200), ["a", "b", "c"], ["k", "label"])
    train, valid = vec.where("k % 4 != 0"), vec.where("k % 4 = 0")
    grid, built = {"C": [0.01, 1.0, 100.0]}, []

    def build(C):
        built.append(C)
        if C == 100.0 and built.count(C) == 1:
            raise RuntimeError("lost")
        return tr.logistic(C, 150.0)

    search = lambda g: tr.grid_search(build, g, train, valid, "k", "label", "balanced", results=f"{tmp_path}/grid", workers=2)
    with pytest.raises(RuntimeError, match="lost"):
        search(grid)
    table, best, model = search(grid)
    assert built.count(0.01) <= 3 and built.count(1.0) == 1 and table.count() == 3  # the first point is also built to see its kind
    rows = {r.grid_index: r for r in table.collect()}
    own = tr.fit_and_score(tr.logistic(1.0, 150.0), train, valid, "k", "label", "m", "balanced")[1]
    assert abs(met.roc_auc(own).first().roc_auc - rows[1].roc_auc) < 1e-12
    assert best in tr.expand_grid(grid) and abs(met.roc_auc(tr.score_table(model, valid, "k", "label", "m")).first().roc_auc - table.first().roc_auc) < 1e-12
    with pytest.raises(ValueError, match="another grid"):
        search({"C": [2.0]})


def test_class_weights_are_joined_without_dealing_the_rows_by_class(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(100)], "k int, label int").repartition(5, "k")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with a table whose size is not known
    try:
        for out in (tr.with_weights(df, "label", "balanced"), tr.oversample_positives(df, "label")):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert tr.with_weights(df, "label", "balanced").groupBy("label").agg(F.sum("weight").alias("w")).where("abs(w - 50) < 1e-9").count() == 2
        assert tr.oversample_positives(df, "label").count() == 90 + 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_stacked_bases_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    import pytest

    from riskframe.plans import modeling as mdl

    class Met(Exception):
        pass

    all_there = threading.Barrier(4, timeout=20)

    def base(*a):
        all_there.wait()
        raise Met

    for name in ("train_logistic", "train_forest", "train_boosted", "train_network"):
        monkeypatch.setattr(mdl, name, base)
    for name in ("prepared", "binned"):
        monkeypatch.setattr(mdl, name, lambda *a, **k: None)
    with pytest.raises(Met):
        mdl.stacked(spark, "/root/testdata/sf0.001")


def test_both_profiles_share_one_fit(spark, monkeypatch):
    from riskframe.operators import prepare as prep
    from riskframe.plans import modeling as mdl

    calls, fit = [], prep.fit_medians
    monkeypatch.setattr(prep, "fit_medians", lambda *a, **k: calls.append(1) or fit(*a, **k))
    for cache in ("_READY", "_FITTED"):
        monkeypatch.setattr(mdl, cache, {})
    scaled, plain = (mdl.prepared(spark, "/root/testdata/sf0.001", scale) for scale in (True, False))
    assert len(calls) == 1 and scaled.names == plain.names and scaled.dropped == plain.dropped
    train = mdl.split_frames(spark, "/root/testdata/sf0.001")[1]
    alone = prep.build_ready(train, None, mdl.KEY, mdl.TARGET, scale_numeric=True)[2]
    shared = prep.build_ready(train, None, mdl.KEY, mdl.TARGET, scale_numeric=True, unscaled=mdl._fitted(spark, "/root/testdata/sf0.001", train))[2]
    assert alone == shared
