"""Leaf-wise boosting on binned tables: brute force, both pass kinds, masks, draws, progress."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import binning, boosting
from riskframe.operators import metrics as met
from riskframe.operators.boosting import BoostSpec


def _table(spark, n=600, features=5, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0.2) | (rng.random(n) < 0.05)).astype(int)
    rows = [(int(i), int(y[i]), [None if rng.random() < 0.02 else float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "k long, label int, x array<double>").repartition(4, "k")


@pytest.fixture(scope="module")
def binned(spark):
    df = _table(spark)
    bins = binning.fit_bins(df, F.col("x"), [f"f{i}" for i in range(5)], 16)
    return binning.bin_table(df, F.col("x"), bins, ["k", "label"]).cache(), bins


def _matrix(table):
    rows = table.orderBy("k").collect()
    return np.array([list(r.bins) for r in rows]), np.array([r.label for r in rows])


def _json(models):
    return [[t.to_json() for t in m.trees] for m in models]


def test_bins_follow_the_cuts(spark, binned):
    table, bins = binned
    src = {r.k: r.x for r in _table(spark).collect()}
    for r in table.collect():
        for j, v in enumerate(src[r.k]):
            want = 0 if v is None else sum(v > c for c in bins.cuts[j])
            assert r.bins[j] == want
    odd = spark.createDataFrame([(1, [math.nan, 1.0]), (2, [None, 1.0]), (3, [2.0, 1.0]), (4, [5.0, 1.0])], "k int, x array<double>")
    fitted = binning.fit_bins(odd, F.col("x"), ["a", "b"])
    assert fitted.cuts[0].tolist() == [2.0] and fitted.cuts[1].tolist() == [] and fitted.n_bins == 2
    assert [list(r.bins) for r in binning.bin_table(odd, F.col("x"), fitted, ["k"]).orderBy("k").collect()] == [[0, 0], [0, 0], [0, 0], [1, 0]]


def _brute_tree(x, g, h, spec, features):
    """Best-first growth in plain Python: {path: split} and the leaves' rows."""
    def best(rows):
        found = None
        G, H = g[rows].sum(), h[rows].sum()
        for f in features:
            for b in range(x[:, f].max() + 1):
                left = rows[x[rows, f] <= b]
                right = rows[x[rows, f] > b]
                if min(len(left), len(right)) < spec.min_child or min(h[left].sum(), h[right].sum()) < boosting.MIN_HESSIAN:
                    continue
                gain = g[left].sum() ** 2 / (h[left].sum() + spec.l2) + g[right].sum() ** 2 / (h[right].sum() + spec.l2) - G**2 / (H + spec.l2)
                if gain > boosting.MIN_GAIN and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, b, left, right)
        return found

    leaves = {"": np.arange(len(x))}
    while len(leaves) < spec.num_leaves:
        options = [(best(rows), path) for path, rows in leaves.items()]
        options = [(s, p) for s, p in options if s]
        if not options:
            break
        (_, _, _, left, right), path = max(options, key=lambda o: o[0][0])
        del leaves[path]
        leaves[path + "0"], leaves[path + "1"] = left, right
    return leaves


@pytest.mark.parametrize("in_memory_rows, num_leaves, min_child", [(0, 9, 5), (150, 31, 30), (150, 9, 5), (10**9, 4, 20), (10**9, 31, 30)])
def test_trees_equal_brute_force(binned, in_memory_rows, num_leaves, min_child):
    table, bins = binned
    x, y = _matrix(table)
    spec = BoostSpec("m", tuple(range(5)), rounds=3, learning_rate=0.3, num_leaves=num_leaves, min_child=min_child, feature_fraction=0.8, positive_weight=2.0, l2=1.0)
    (model,) = boosting.fit(table, bins.n_bins, [spec], "k", "label", in_memory_rows=in_memory_rows)
    margin = np.full(len(x), math.log(y.sum() * 2.0 / (len(y) - y.sum())))
    for t, tree in enumerate(model.trees):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, 2.0, 1.0)
        g, h = w * (p - y), w * p * (1 - p)
        leaves = _brute_tree(x, g, h, spec, spec.tree_features(t))
        assert tree.n_leaves == len(leaves) <= num_leaves and (tree.cover[tree.feature < 0] >= min_child).all()
        own = tree.leaf_of(x)
        for rows in leaves.values():
            assert len(set(own[rows])) == 1 and tree.cover[own[rows[0]]] == len(rows)
            assert math.isclose(tree.value[own[rows[0]]], -0.3 * g[rows].sum() / (h[rows].sum() + 1.0), abs_tol=1e-6)
        margin += tree.value[own]


def test_passes_partitions_and_company_change_nothing(binned):
    table, bins = binned
    one = BoostSpec("one", (0, 1, 2, 3, 4), rounds=4, num_leaves=8, min_child=10, row_fraction=0.7)
    two = BoostSpec("two", (1, 3), rounds=6, num_leaves=5, min_child=20, learning_rate=0.2)
    fit = lambda t, specs, **kw: _json(boosting.fit(t, bins.n_bins, specs, "k", "label", **kw))
    both = fit(table, [one, two])
    assert both == fit(table.repartition(1), [one, two], in_memory_rows=0) == fit(table.repartition(7), [one, two], in_memory_rows=100, store_every=2)
    assert both == fit(table, [one]) + fit(table, [two])
    assert {f for t in both[1] for f in t["feature"]} <= {-1, 1, 3} and [len(t) for t in both] == [4, 6]


def test_few_cells_at_a_time_change_nothing(binned, monkeypatch):
    table, bins = binned
    specs = [BoostSpec(n, (0, 1, 2), rounds=2, num_leaves=9, min_child=5) for n in "abc"]
    want = _json(boosting.fit(table, bins.n_bins, specs, "k", "label", in_memory_rows=0))
    monkeypatch.setattr(boosting, "MAX_CELLS", 60)
    assert _json(boosting.fit(table, bins.n_bins, specs, "k", "label", in_memory_rows=0)) == want


def test_scores_rank_and_loss_falls(binned):
    table, bins = binned
    models = boosting.fit(table, bins.n_bins, [BoostSpec("m", tuple(range(5)), rounds=25, learning_rate=0.3, num_leaves=8, min_child=5)], "k", "label")
    stages = boosting.score(table, models, "k", "label", [(f"after {r}", 0, r) for r in (0, 5, 25)])
    loss = -F.avg(F.when(F.col("label") == 1, F.log("score")).otherwise(F.log(1 - F.col("score"))))
    got = {r.model: r.loss for r in stages.groupBy("model").agg(loss.alias("loss")).collect()}
    assert got["after 25"] < got["after 5"] < got["after 0"]
    assert met.roc_auc(boosting.score(table, models, "k", "label")).first().roc_auc > 0.9


def test_a_stopped_run_goes_on(binned, tmp_path, monkeypatch):
    table, bins = binned
    spec = BoostSpec("m", (0, 1, 2, 3), rounds=7, num_leaves=6, min_child=10)
    want = _json(boosting.fit(table, bins.n_bins, [spec], "k", "label"))
    grow, calls = boosting._grow_trees, []

    def stops(*args):
        calls.append(args)
        if len(calls) == 6:
            raise KeyboardInterrupt
        return grow(*args)

    monkeypatch.setattr(boosting, "_grow_trees", stops)
    with pytest.raises(KeyboardInterrupt):
        boosting.fit(table, bins.n_bins, [spec], "k", "label", progress=f"{tmp_path}/p", store_every=2)
    assert _json(boosting.fit(table, bins.n_bins, [spec], "k", "label", progress=f"{tmp_path}/p", store_every=2)) == want
    assert len(calls) == 6 + 3  # rounds 5 to 7 only
    with pytest.raises(ValueError, match="another run"):
        boosting.fit(table, bins.n_bins, [BoostSpec("other", (0,), rounds=7)], "k", "label", progress=f"{tmp_path}/p")


def test_nothing_to_learn(spark, binned):
    table, bins = binned
    spec = BoostSpec("m", (0, 1), rounds=2)
    (empty,) = boosting.fit(table.where("k < 0"), bins.n_bins, [spec], "k", "label")
    assert empty.trees == [] and boosting.score(table.where("k < 0"), [empty], "k", "label").count() == 0
    (alike,) = boosting.fit(table.withColumn("label", F.lit(1)), bins.n_bins, [spec], "k", "label")
    assert all(t.n_leaves == 1 and t.value.tolist() == [0.0] for t in alike.trees)
    (none,) = boosting.fit(table, bins.n_bins, [BoostSpec("none", (), rounds=1)], "k", "label")
    assert none.trees[0].n_leaves == 1


def test_histograms_of_many_rows_equal_counting_one_by_one():
    rng = np.random.default_rng(8)
    for n in (5, 3000, 20_000):
        bins, slot = rng.integers(0, 7, (n, 3)).astype(np.uint8), rng.integers(0, 2, n)
        g, h = rng.integers(-(2**30), 2**30, n), rng.integers(0, 2**30, n)
        found = boosting._histogram(bins, g, h, slot, 2, 7)
        want = np.zeros((2, 3, 7, 3), np.int64)
        for f in range(3):
            for column, values in enumerate((np.ones(n, np.int64), g, h)):
                np.add.at(want[:, f, :, column], (slot, bins[:, f]), values)
        assert (found == want).all()


def test_a_leaf_of_a_hundred_thousand_rows_is_grown_in_one_pass(monkeypatch):
    assert boosting.IN_MEMORY_ROWS >= 120_000
    calls = []

    def passed(kind):
        def run(state, work, *rest):
            calls.append(kind)
            return []
        return run

    monkeypatch.setattr(boosting, "_histogram_pass", passed("histograms"))
    monkeypatch.setattr(boosting, "_subtree_pass", passed("subtrees"))
    model = boosting.BoostedModel(BoostSpec("m", (0, 1), min_child=2), 0.0)
    boosting._grow_trees(None, [model], 0, [0], 0, 120_000, 4, 1.0, "label", boosting.IN_MEMORY_ROWS)
    assert calls == ["subtrees"]


@pytest.mark.parametrize("n_bins", [7, 100])
def test_paired_bins_count_as_one_by_one(n_bins, monkeypatch):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, n_bins, (5000, 5)).astype(np.uint8)
    g, h = rng.integers(-(2**30), 2**30, 5000), rng.integers(0, 2**30, 5000)
    data = boosting.PairedBins(5000, 5, n_bins)
    data.fill(0, bins[:3000]), data.fill(3000, bins[3000:])
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 3000)
    monkeypatch.setattr(boosting, "SUM_ROWS", 1000)
    for rows in (None, np.arange(0, 5000, 2), np.arange(100)):
        own = np.arange(5000) if rows is None else rows
        for features in ([0, 1, 2, 3, 4], [1, 4], [2]):
            got = data.histogram(np.array(features), rows, g[own], h[own])
            assert (got == boosting._histogram(bins[np.ix_(own, features)], g[own], h[own], np.zeros(len(own), np.int64), 1, n_bins)[0]).all()
    assert all((data.column(f, np.arange(5000)) == bins[:, f]).all() for f in range(5))


def test_a_table_that_a_task_holds_is_trained_without_a_pass(binned, monkeypatch):
    table, bins = binned
    specs = [BoostSpec("a", (0, 1, 2, 3, 4), rounds=5, num_leaves=8, min_child=10, row_fraction=0.7), BoostSpec("b", (3, 1), rounds=3, num_leaves=5, positive_weight=2.0), BoostSpec("c", (), rounds=1)]
    want = _json(boosting.fit(table, bins.n_bins, specs, "k", "label", in_memory_rows=100))
    monkeypatch.setattr(boosting, "_grow_trees", lambda *a: pytest.fail("a pass for a tree"))
    assert _json(boosting.fit(table, bins.n_bins, specs, "k", "label")) == want


def test_pairs_in_a_file_give_the_same_trees(binned, monkeypatch):
    table, bins = binned
    x, y = _matrix(table)
    spec, trees = BoostSpec("m", (0, 1, 2, 3, 4), rounds=3, num_leaves=8, min_child=10), []
    for limit in (10**9, 0):
        monkeypatch.setattr(boosting, "MEMORY_BYTES", limit)
        data = boosting.PairedBins(len(x), 5, bins.n_bins)
        data.fill(0, x.astype(np.uint8))
        assert isinstance(data.pairs, np.memmap) == (limit == 0)
        trees.append([t.to_json() for t in boosting._train_paired(data, y.astype(float), np.arange(len(x)), spec, 0.0, 2.0**30)])
    assert trees[0] == trees[1]


def test_rows_without_a_label_change_nothing_between_the_paths(binned, tmp_path):
    table, bins = binned
    gaps = table.withColumn("label", F.when(F.col("k") % 17 != 3, F.col("label")))
    specs = [BoostSpec("m", (0, 1, 2, 3, 4), rounds=3, num_leaves=8, min_child=10)]
    assert _json(boosting.fit(gaps, bins.n_bins, specs, "k", "label")) == _json(boosting.fit(gaps, bins.n_bins, specs, "k", "label", progress=f"{tmp_path}/p"))
