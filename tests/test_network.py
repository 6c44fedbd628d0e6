"""Distributed network steps: finite differences, weights as repeats, company, partitions, history."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as met
from riskframe.operators import network
from riskframe.operators.network import NetworkSpec


@pytest.mark.parametrize("hidden, dropout", [((), 0.0), ((5,), 0.0), ((6, 4), 0.4)])
def test_gradient_equals_finite_differences(hidden, dropout):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(12, 3)), rng.integers(0, 2, 12).astype(float)
    weight, hashed = rng.uniform(0.5, 2, 12), rng.integers(-(2**62), 2**62, 12)
    spec = NetworkSpec("m", hidden, dropout, positive_weight=3.0)
    flat = spec.initial(3)
    loss = lambda f: network.loss_and_gradient(spec, f, x, y, weight, hashed, 2)[0]
    gradient = network.loss_and_gradient(spec, flat, x, y, weight, hashed, 2)[1]
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-6 - gradient[i]) < 1e-5


def test_dropout_masks_follow_the_key_and_keep_the_mean():
    hashed = np.random.default_rng(2).integers(-(2**62), 2**62, 4000)
    mask = network._keep_mask(hashed, 10, 0.3, 5)
    assert (mask == network._keep_mask(hashed[::-1], 10, 0.3, 5)[::-1]).all() and abs(mask.mean() - 1) < 0.02
    assert (network._keep_mask(hashed, 10, 0.3, 6) != mask).any() and set(np.unique(mask)) == {0.0, 1 / 0.7}


def _rows(spark, n=500):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] > 0.1).astype(int)
    return spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(n)], "k long, label int, x array<double>")


def _fit(df, specs, **kw):
    return network.fit(df, F.col("x"), 4, specs, "k", "label", batch_size=kw.pop("batch_size", 128), **kw)


def test_steps_equal_a_plain_loop(spark):
    df = _rows(spark)
    spec = NetworkSpec("m", (6,), 0.2, 0.01, epochs=2, positive_weight=1.5)
    (net,) = _fit(df.repartition(7), [spec])
    rows = network._deal(df, F.col("x"), "k", "label", None, 4).orderBy("batch", "__hash").collect()
    flat, m, v, step = spec.initial(4), 0.0, 0.0, 0
    for epoch in range(2):
        for batch in np.random.default_rng((42, epoch)).permutation(range(4)):
            own = [r for r in rows if r.batch == batch]
            x = np.array([np.frombuffer(bytes(r.x)) for r in own])
            _, g = network.loss_and_gradient(spec, flat, x, np.array([r.label for r in own], float), np.ones(len(own)), np.array([r["__hash"] for r in own]), epoch)
            g, step = g / len(own), step + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            flat = flat - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(net.parameters, flat, atol=1e-7)


def test_a_row_of_weight_two_counts_twice(spark):
    df = _rows(spark, 200)
    spec = NetworkSpec("m", (5,), 0.3, 0.01, epochs=2)
    weighted = _fit(df, [spec], weight=F.when(F.col("k") % 3 == 0, 2).otherwise(1), batch_size=10**6)[0]
    twice = _fit(df.unionByName(df.where("k % 3 = 0")), [spec], batch_size=10**6)[0]
    assert np.allclose(weighted.parameters, twice.parameters, atol=1e-7) and np.allclose(weighted.history, twice.history)


def test_company_changes_nothing_and_the_loss_falls(spark):
    df = _rows(spark)
    specs = [NetworkSpec("a", (8, 4), 0.1, 0.02, epochs=12), NetworkSpec("b", (3,), 0.0, 0.005, epochs=2)]
    both = _fit(df, specs)
    alone = [_fit(df.repartition(2), [s])[0] for s in specs]
    assert all(np.allclose(p.parameters, q.parameters, atol=1e-6) for p, q in zip(both, alone))
    assert [len(n.history) for n in both] == [12, 2] and both[0].history[-1] < both[0].history[0]
    scores = network.score(df, F.col("x"), both, "k", "label")
    auc = {r.model: r.roc_auc for r in met.roc_auc(scores, ["model"]).collect()}
    assert scores.count() == 1000 and auc["a"] > 0.75


def test_nulls_and_empty_tables(spark):
    df = _rows(spark, 50)
    spec = NetworkSpec("m", (3,), epochs=1)
    holes = df.withColumn("x", F.when(F.col("k") < 5, F.array(*[F.lit(None).cast("double")] * 4)).otherwise(F.col("x")))
    assert np.isfinite(_fit(holes, [spec])[0].parameters).all()
    (empty,) = _fit(df.where("k < 0"), [spec])
    assert np.allclose(empty.parameters, spec.initial(4)) and empty.history == [0.0]


def test_every_partition_of_the_blocks_is_one_piece_of_a_batch(spark):
    dealt = network._deal(_rows(spark), F.col("x"), "k", "label", None, 5)
    blocks = network._blocks(dealt, "label", 5, 3).rdd.map(tuple)
    found = blocks.mapPartitionsWithIndex(lambda i, rows: [(i // 3, h) for _, _, hashed, _ in rows for h in np.frombuffer(hashed, np.int64).tolist()]).collect()
    assert blocks.getNumPartitions() == 15 and sorted(found) == sorted((r.batch, r["__hash"]) for r in dealt.collect())


def test_a_step_is_one_job_without_a_shuffle_and_equal_runs_are_trained_once(spark, monkeypatch):
    calls = []
    step = network._gradient_job
    monkeypatch.setattr(network, "_gradient_job", lambda blocks, parts, specs, *a: calls.append(len(specs)) or step(blocks, parts, specs, *a))
    specs = [NetworkSpec("a", (4,), 0.1, 0.02, epochs=3), NetworkSpec("b", (4,), 0.1, 0.02, epochs=1), NetworkSpec("c", (3,), 0.1, 0.02, epochs=1)]
    spark.sparkContext.setJobGroup("network", "fit")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    a, b, c = _fit(_rows(spark), specs)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("network"))
    spark.sparkContext._jsc.clearJobGroup()
    assert calls == [2] * 4 + [1] * 8 and jobs <= 12 + 8  # one job for each step, and the dealing
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert [len(n.history) for n in (a, b, c)] == [3, 1, 1] and a.history[:1] == b.history
    alone = _fit(_rows(spark), specs[1:2])[0]
    assert (alone.parameters == b.parameters).all() and alone.history == b.history and (a.parameters != b.parameters).any()


@pytest.mark.parametrize("memory", [0, 10**9])
def test_many_steps_are_taken_in_one_task_for_each_model_with_the_same_result(spark, monkeypatch, memory):
    specs = [NetworkSpec("a", (4,), 0.1, 0.02, epochs=5), NetworkSpec("b", (4,), 0.1, 0.02, epochs=2), NetworkSpec("c", (3, 2), 0.2, 0.02, epochs=3), NetworkSpec("d", (2,), epochs=0)]
    weight = F.when(F.col("k") % 3 == 0, 2.5).otherwise(1)
    monkeypatch.setattr(network, "IN_TASK_STEPS", 10**9)
    want = _fit(_rows(spark), specs, weight=weight)
    monkeypatch.setattr(network, "IN_TASK_STEPS", 16)
    monkeypatch.setattr(network, "_MEMORY_BYTES", memory)
    monkeypatch.setattr(network, "_gradient_job", lambda *a: pytest.fail("a job for a step"))
    got = _fit(_rows(spark), specs, weight=weight)
    assert all((p.parameters == q.parameters).all() and p.history == q.history for p, q in zip(want, got))
    assert [len(n.history) for n in got] == [5, 2, 3, 0]
