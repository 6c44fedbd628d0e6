"""Metric identities on the hand-made example and against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M

LABELS = [1, 0, 1, 0, 1, 0]
SCORES = [0.9, 0.8, 0.7, 0.3, 0.3, 0.125]


@pytest.fixture
def six(spark):
    return spark.createDataFrame(list(zip(range(6), LABELS, SCORES)), "k long, label int, score double")


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(labels, scores):
    P = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 0)
        dtp = sum(1 for y, s in zip(labels, scores) if s == t and y == 1)
        ap += dtp / P * tp / (tp + fp)
    return ap


def test_hand_example(six):
    r = M.binary_metrics(six).first()
    assert math.isclose(r.roc_auc, 0.7222222222, rel_tol=1e-9)
    assert math.isclose(r.average_precision, 0.7555555556, rel_tol=1e-9)
    for v in (r.accuracy, r.precision, r.recall, r.f1):
        assert math.isclose(v, 2 / 3)


def test_pr_curve(six):
    rows = sorted(M.pr_curve(six).collect(), key=lambda r: r.threshold)
    assert [r.threshold for r in rows] == [0.125, 0.3, 0.7, 0.8, 0.9]
    exp_p = [1 / 2, 3 / 5, 2 / 3, 1 / 2, 1.0]
    exp_r = [1.0, 1.0, 2 / 3, 1 / 3, 1 / 3]
    for r, p, rc in zip(rows, exp_p, exp_r):
        assert math.isclose(r.precision, p) and math.isclose(r.recall, rc)


def test_best_f1_lowest_tie(six):
    r = M.best_f1_metrics(six).first()
    assert math.isclose(r.best_f1_from_sweep, 0.75)
    assert math.isclose(r.threshold, 0.13, abs_tol=1e-9)


def test_no_predicted_positive(six):
    r = M.binary_metrics(six, threshold=0.99).first()
    assert r.precision == 0.0 and r.f1 == 0.0 and r.recall == 0.0


def test_sweep_equals_pointwise_and_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, label int, score double").repartition(5)
    labels, scores = [r[1] for r in rows], [r[2] for r in rows]
    # few buckets -> many distinct scores per bucket and windows across bucket edges
    rm = M.ranking_metrics(df, buckets=4).first()
    assert math.isclose(rm.roc_auc, brute_auc(labels, scores), rel_tol=1e-12)
    assert math.isclose(rm.average_precision, brute_ap(labels, scores), rel_tol=1e-12)
    table = {r.threshold: r for r in M.threshold_table(df, M.report_grid()).collect()}
    assert len(table) == 19
    for t in (M.report_grid()[0], M.report_grid()[9], M.report_grid()[18]):
        one = M.binary_metrics(df, threshold=t).first()
        row = table[t]
        assert math.isclose(row.f1, one.f1) and math.isclose(row.accuracy, one.accuracy)
        tp = sum(1 for y, s in zip(labels, scores) if s >= t and y == 1)
        assert row.tp == tp
        assert row.tp + row.fp + row.fn + row.tn == len(rows)


def test_grouped_invariance(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randint(0, 1), rnd.random()) for g in ("a", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "m string, k long, label int, score double")
    got = {r.m: r for r in M.ranking_metrics(df, ["m"], buckets=8).collect()}
    for g in ("a", "b"):
        ls = [r[2] for r in rows if r[0] == g]
        ss = [r[3] for r in rows if r[0] == g]
        assert math.isclose(got[g].roc_auc, brute_auc(ls, ss), rel_tol=1e-12)
    shuffled = df.repartition(7, F.rand(1))
    again = {r.m: r for r in M.ranking_metrics(shuffled, ["m"], buckets=3).collect()}
    for g in ("a", "b"):
        assert math.isclose(got[g].average_precision, again[g].average_precision, rel_tol=1e-12)


def test_grid_drift():
    grid = M.tuning_grid()
    assert len(grid) == 91 and grid[63] == 0.6800000000000002
    assert len(M.report_grid()) == 19
