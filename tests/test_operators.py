"""Unit tests of profiling, quantiles, preparation and expressions on hand-made rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import exprs as ex
from riskframe.operators import prepare as prep
from riskframe.operators import profile as prof
from riskframe.operators.quantiles import exact_quantiles


def test_exact_quantiles_small_and_bracketed(spark):
    rnd = random.Random(5)
    vals = [rnd.choice([rnd.random(), 0.5, 0.25]) for _ in range(3000)]
    df = spark.createDataFrame([(v, v * 2 if i % 7 else None) for i, v in enumerate(vals)], "a double, b double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    for acc in (10, 100, 10_000):  # narrow and whole-range brackets take the same path
        got = {(r.column, r.p): r.quantile
               for r in exact_quantiles(df, ["a", "b"], probs, accuracy=acc).collect()}
        for c, data in (("a", vals), ("b", [v * 2 for i, v in enumerate(vals) if i % 7])):
            for p in probs:
                assert math.isclose(got[(c, p)], float(np.quantile(data, p)), rel_tol=1e-12, abs_tol=1e-15)


def test_grouped_quantiles_both_paths(spark):
    rows = [(g, float(v)) for g in ("x", "y") for v in range(1 if g == "x" else 5, 40)]
    df = spark.createDataFrame(rows, "g string, v double")
    for acc in (5, 10_000):
        got = {(r.g, r.p): r.quantile for r in exact_quantiles(df, ["v"], [0.25, 0.5], ["g"], accuracy=acc).collect()}
        for g in ("x", "y"):
            data = [v for gg, v in rows if gg == g]
            for p in (0.25, 0.5):
                assert math.isclose(got[(g, p)], float(np.quantile(data, p)))


def test_round_rank_rule(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    r = exact_quantiles(df, ["x"], [0.2], rank_rule="round").first()
    assert r.quantile == 2.0  # the 2nd smallest of 10 (round(0.2*10) = 2)


def test_split_cut_equals_window(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    a = {r.k: r.split for r in prep.stratified_split(df, "k", "y", method="cut").collect()}
    b = {r.k: r.split for r in prep.stratified_split(df, "k", "y", method="window").collect()}
    assert a == b
    n_val = sum(1 for v in a.values() if v == "validation")
    assert n_val == round(0.2 * 56) + round(0.2 * 444)


def test_missing_and_constant(spark):
    df = spark.createDataFrame([(1, None, 5.0, None), (2, None, 5.0, "x"), (3, None, 5.0, None)],
                               "k int, allnull double, same double, s string")
    mp = {r.column: r for r in prof.missing_profile(df).collect()}
    assert mp["allnull"].null_count == 3 and math.isclose(mp["s"].null_pct, 200 / 3)
    const = {r.column: r.is_constant for r in prof.constant_columns(df).collect()}
    assert const == {"k": False, "allnull": True, "same": True, "s": False}
    d2 = spark.createDataFrame([(5.0,), (None,)], "v double")
    assert prof.constant_columns(d2).first().is_constant is False


def test_histogram_edges_and_box(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [0, 1, 2, 3, 4, 10, None]], "x double")
    h = {r.bin: r["count"] for r in prof.histogram(df, "x", bins=5).collect()}
    counts, _ = np.histogram([0, 1, 2, 3, 4, 10], bins=5)
    assert [h[i] for i in range(5)] == counts.tolist()
    b = prof.box_stats(df.withColumn("g", F.lit(1)), "x", "g").first()
    assert (b.q1, b.median, b.q3) == (1.25, 2.5, 3.75) and b.whisker_high == 4.0 and b.outliers == 1


def test_preparation_fixture(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, None), (3.0, "a"), (4.0, "b"), (None, "a")], "x double, c string")
    assert prep.fit_medians(df, ["x"])["x"] == 2.5
    sc = spark.createDataFrame([(float(v),) for v in (2, 4, 4, 4, 5, 5, 7, 9)], "v double")
    assert prep.fit_scaling(sc, ["v"])["v"] == (5.0, 2.0)
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert prep.fit_scaling(const, ["v"])["v"] == (3.0, 1.0)
    spec = prep.fit_preprocessor(df, ["x"], ["c"], scale_numeric=False)
    assert spec.output_columns() == ["x", "c_a", "c_b", "c_None"]
    test = spark.createDataFrame([(None, "z")], "x double, c string")
    row = prep.transform(test, spec).first()
    assert (row.x, row.c_a, row.c_b, row.c_None) == (2.5, 0.0, 0.0, 0.0)
    mode_spec = prep.fit_preprocessor(df, ["x"], ["c"], scale_numeric=False, null_category="mode")
    assert mode_spec.categories["c"] == ["a", "b"] and mode_spec.modes["c"] == "a"


def test_safe_names_and_families(spark):
    from riskframe.operators.naming import safe_name_list

    assert safe_name_list(spark, ["A/B", "A B", "A_B", "***", ""]) == ["A_B", "A_B_1", "A_B_2", "feature", "feature_1"]
    assert safe_name_list(spark, ["A B", "A/B", "A_B_1", "A_B"]) == ["A_B", "A_B_1", "A_B_1_1", "A_B_2"]
    assert safe_name_list(spark, ["A_B_1", "A B", "A/B"]) == ["A_B_1", "A_B", "A_B_2"]
    df = spark.createDataFrame([("BUREAU_X",), ("PREV_Y",), ("AMT",)], "f string")
    fam = [r.g for r in df.select(ex.prefix_family("f", [("BUREAU_", "bureau_family"), ("PREV_", "prev")],
                                                   "application").alias("g")).collect()]
    assert fam == ["bureau_family", "prev", "application"]


def test_clip_keeps_null_and_flags(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (4.0,)], "x double")
    out = df.select(ex.clip_lower("x", 0).alias("c"), ex.flag(F.col("x") > 0).alias("f")).collect()
    assert [(r.c, r.f) for r in out] == [(0.0, 0), (None, 0), (4.0, 1)]
    assert df.select(ex.safe_divide(F.lit(1.0), "x").alias("r")).collect()[1].r is None


def test_fold_summary_single_fold(spark):
    from riskframe.operators.metrics import fold_summary

    df = spark.createDataFrame([("e", "m", 0, 0.7)], "experiment string, model string, fold int, auc double")
    r = fold_summary(df).first()
    assert r.auc_mean == 0.7 and r.auc_std is None


def test_csv_null_spellings_and_row_cap(spark, tmp_path):
    from riskframe.sources.catalog import read_csv_table

    p = tmp_path / "t.csv"
    p.write_text("k,s,x\n1,NA,1.5\n2,,2.5\n3,ok,NA\n")
    df = read_csv_table(spark, str(p), null_values=["", "NA"])
    rows = {r.k: r for r in df.collect()}
    assert rows[1].s is None and rows[2].s is None and rows[3].s == "ok"
    assert read_csv_table(spark, str(p), columns=["k"], n_rows=2).count() == 2


def test_sigmoid_and_hard_decision(spark):
    df = spark.createDataFrame([(0.0, 0.5), (2.0, 0.49)], "z double, s double")
    r = df.select(ex.sigmoid("z").alias("p"), ex.hard_decision("s", 0.5).alias("y")).collect()
    assert r[0].p == 0.5 and math.isclose(r[1].p, 1 / (1 + math.exp(-2))) and [x.y for x in r] == [1, 0]


def test_constant_variance_guard(spark):
    # a constant column can come out of merged partial moments with var ~1e-33 instead of 0
    df = spark.createDataFrame([(7.7e-34, 1.0, 15000.0), (0.0, 1.0, 3.0), (0.01, 1.0, 15000.0)],
                               "var double, mean double, n double")
    got = [r.c for r in df.select(prep.constant_variance(F.col("var"), F.col("mean"), F.col("n")).alias("c")).collect()]
    assert got == [True, True, False]
    many = spark.range(15000).select(F.lit(1.0).alias("v")).repartition(7)
    assert prep.fit_scaling(many, ["v"])["v"] == (1.0, 1.0)


def test_quantiles_of_every_small_size(spark):
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 0.99, 1.0]
    data = {n: [float((i * 7919) % 101) for i in range(n)] for n in [*range(1, 12), 19, 20, 21, 100, 101]}
    df = spark.createDataFrame([(n, v) for n, vs in data.items() for v in vs] + [(0, None), (None, 4.0)], "g int, v double").repartition(3)
    rows = {(r.g, r.p): (r.n, r.quantile) for r in exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for n, vs in data.items():
        for p in probs:
            assert rows[n, p][0] == n and math.isclose(rows[n, p][1], float(np.quantile(vs, p)), abs_tol=1e-12), (n, p)
    assert rows[0, 0.5] == (0, None) and rows[None, 0.5] == (1, 4.0)


def test_no_frame_stays_cached(spark):
    from riskframe.operators import metrics as met

    df = spark.createDataFrame([(i % 2, i / 50) for i in range(50)], "label int, score double")
    met.binary_metrics(df).collect()
    met.threshold_table(df).collect()
    exact_quantiles(df, ["score"], [0.5], ["label"]).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_sums_do_not_depend_on_partitioning(spark):
    from riskframe.operators.rollup import RollupSpec, rollup

    rnd = random.Random(1)
    rows = [(i % 5, round(rnd.random() * 1e5, 2)) for i in range(4000)]
    spec = RollupSpec(prefix="T", key="k", numerics=("v",), scales={"v": 2}, unique="v")
    got = [sorted(map(tuple, rollup(spark.createDataFrame(rows, "k int, v double").repartition(n), spec).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]
    from decimal import Decimal
    for k, n, unique, mean, _hi, _lo, total in got[0]:
        exact = sum(Decimal(str(v)) for kk, v in rows if kk == k)
        assert total == float(exact) and mean == float(exact) / n and unique == len({v for kk, v in rows if kk == k})


def test_null_group_keeps_its_row(spark):
    from riskframe.operators import metrics as met

    df = spark.createDataFrame([(g, i % 2, (i * 7 % 10) / 10) for g in ("a", None) for i in range(20)], "model string, label int, score double")
    for out in (met.binary_metrics(df, group_cols=["model"]), met.best_f1_metrics(df, ["model"]), met.pr_curve(df, ["model"])):
        assert {r.model for r in out.collect()} == {"a", None}


def test_folds_of_every_class_differ_by_one_row_at_most(spark):
    from collections import Counter

    from riskframe.operators import prepare as prep

    classes = [0] * 203 + [1] * 31 + [2] * 3 + [None] * 7 + [4]
    df = spark.createDataFrame(list(enumerate(classes)), "k int, label int").repartition(5)
    rows = prep.stratified_folds(df, "k", "label", 5).collect()
    assert sorted(r.k for r in rows) == list(range(len(classes)))
    sizes = Counter((r.label, r.fold) for r in rows)
    for label, n in Counter(classes).items():
        own = [sizes[label, f] for f in range(5)]
        assert sum(own) == n and max(own) - min(own) <= 1
    again = {r.k: r.fold for r in prep.stratified_folds(df.repartition(2), "k", "label", 5).collect()}
    assert again == {r.k: r.fold for r in rows}
    assert {r.fold for r in prep.stratified_folds(df, "k", "label", 1).collect()} == {0}
    assert prep.stratified_folds(df.where("k < 0"), "k", "label", 5).count() == 0


def test_few_groups_are_joined_without_dealing_the_rows_by_group(spark):
    from riskframe.operators.joins import null_safe_join, small_side

    few = spark.createDataFrame([(0, 1.0), (1, 2.0), (None, 3.0)], "g int, cut double").checkpoint()
    many = spark.range(2000).selectExpr("cast(id as int) g", "1D cut").checkpoint()
    rows = spark.range(30).selectExpr("CASE WHEN id < 20 THEN cast(id % 2 as int) END g", "id")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with a table whose size is not known
    try:
        plan = lambda side: null_safe_join(rows, small_side(side, ["g"]), ["g"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(few) and "BroadcastHashJoin" not in plan(many)
        assert null_safe_join(rows, small_side(few, ["g"]), ["g"]).groupBy("cut").count().count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_experiment_counts_build_no_family_column(spark, monkeypatch):
    from riskframe.plans import modeling as mdl

    monkeypatch.setattr(mdl, "split_frames", lambda *a: pytest.fail("the wide table is stored"))
    counts = mdl.experiment_counts(spark, "/root/testdata/sf0.001").collect()
    assert [r.experiment for r in counts] == mdl.RECOMMENDED_RUNS
    assert {r.validation_rows for r in counts} == {round(spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count() * 0.2)}


def test_decimal_sums_in_whole_numbers_are_those_of_decimals(spark):
    from riskframe.operators.rollup import decimal_sum

    rnd = random.Random(3)
    hard = [None, -0.0, 0.005, 0.015, 1.005, 2.675, -2.675, 1e13, 4e15, 0.125, -0.125, 0.5, 1e-30, 99999999999.995]
    vals = hard + [rnd.uniform(-1, 1) * 10 ** rnd.randint(-14, 14) for _ in range(2000)] + [rnd.randint(-10**6, 10**6) / 1000 for _ in range(2000)]
    df = spark.createDataFrame([(i % 300, v) for i, v in enumerate(vals)] + [(500, None), (501, 4e15), (502, 0.1), (502, 0.2)], "k int, v double")
    for scale in (0, 2, 4, 9, 12):
        got = df.groupBy("k").agg(F.expr(f"sum(CAST(v AS DECIMAL(28, {scale}))) AS a"), F.expr(f"{decimal_sum('v', scale)} AS b"))
        assert got.where("NOT (a <=> b) OR NOT (CAST(a AS DOUBLE) <=> CAST(b AS DOUBLE))").count() == 0


def test_rollup_takes_its_ids_from_another_frame(spark):
    from riskframe.operators.rollup import RollupSpec, rollup

    spec = RollupSpec(prefix="P", key="k", unique="i", numerics=("x",), scales={"x": 2})
    rows = spark.createDataFrame([(1, 1, 0.1), (1, 1, 0.2), (1, 2, None), (None, 3, 0.3), (2, None, None)], "k int, i int, x double")
    want = rollup(rows, spec).collect()
    assert sorted(map(str, rollup(rows, spec, rows.select("k", "i").distinct()).collect())) == sorted(map(str, want))
    found = {r.k: (r.P_RECORD_COUNT, r.P_UNIQUE_LOAN_COUNT, r.P_X_SUM, r.P_X_MEAN) for r in want}
    assert found == {1: (3, 2, 0.3, 0.15), None: (1, 1, 0.3, 0.3), 2: (1, 1, 0.0, None)}


def test_marked_parts_are_the_selected_parts(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e"), (4, "f")], "k int, x string")
    split = spark.createDataFrame([(1, "train"), (1, "validation"), (2, "train"), (2, "train"), (None, "train"), (3, None)], "k int, split string")
    marked = prep.mark_parts(rows, split, "k")
    for part in prep.PARTS:
        assert sorted(prep.marked_part(marked, part).collect()) == sorted(prep.select_part(rows, split, "k", part).collect())
    assert prep.marked_part(marked).exceptAll(rows).count() == 0 and prep.marked_part(marked).count() == 6


def test_ready_tables_join_the_split_once(spark, monkeypatch):
    from riskframe.plans.queries import preparation

    seen = []
    monkeypatch.setattr(prep, "build_ready", lambda train, test, *a, **k: seen.extend([train, test]))
    preparation.ready_tables(spark, "/root/testdata/sf0.001", True)
    assert len(seen) == 2 and not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)


def test_ungrouped_quantiles_carry_no_bracket_with_each_row(spark):
    from riskframe.operators import quantiles as q

    values = spark.createDataFrame([(float(i), None) for i in range(50)], "__v0 double, __v1 double")
    edges = q._edges(values, q._brackets(values, [], 2, [0.5], 100).checkpoint(), [], 2, [0.5])
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1  # the two one-row results
    nan = spark.createDataFrame([(x,) for x in (1.0, float("nan"), float("inf"), float("-inf"), None)], "a double")
    assert {r.p: (r.n, r.quantile) for r in exact_quantiles(nan, ["a"], [0.0, 1 / 3]).collect()}[1 / 3] == (4, 1.0)
