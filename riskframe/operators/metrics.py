"""Exact binary-classification metrics as DataFrame queries.

Input is a long score table: optional group columns (model, blend weight,
fold ...), a 0/1 ``label`` and a ``score``. Everything is computed per group.

Global order without a global window
-------------------------------------
ROC AUC and average precision need cumulative counts in score order. A
window ordered over the whole table is one task. Instead:

1. aggregate to one row per distinct (group, score) with positive and
   negative counts (ties collapse; partial aggregation absorbs hot scores);
2. cut each group's distinct scores into ``RANGES`` score ranges with
   ``percentile_approx`` (approximate cut points are fine: any monotone
   bucketing gives the same exact result) and each range evenly into
   ``RANGES`` sub-ranges;
3. totals per sub-range, prefix sums over the sub-ranges of a range and over
   the ranges of a group (at most ``RANGES`` rows each);
4. a window *within* each sub-range adds the running count inside it.

A null group is a group of its own everywhere.

The threshold sweep assigns every distinct score to the number of grid
thresholds it passes, counts per slot and suffix-sums over the grid (no row x
threshold cross join), so 91 thresholds cost one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.joins import null_safe_join
from riskframe.session import cut_lineage

RANGES = 256


def tuning_grid() -> list[float]:
    """The best-F1 search grid: 0.05, 0.06, ... 0.95 (91 values, with the float
    drift of ``arange``, e.g. 0.6800000000000002)."""
    return [float(x) for x in np.arange(0.05, 0.96, 0.01)]


def report_grid() -> list[float]:
    """The threshold-table grid: 0.05 ... 0.95 in steps of 0.05 (19 values)."""
    return [float(x) for x in np.arange(0.05, 0.96, 0.05)]


def _ratio(n: Column, d: Column) -> Column:
    """n / d as double, 0 when d is 0 (``zero_division=0``)."""
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def per_score(scores: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
              score: str = "score") -> DataFrame:
    """One row per distinct (group, score): pos, neg."""
    y = F.col(label).cast("long")
    return scores.groupBy(*group_cols, score).agg(
        F.sum(y).alias("pos"), (F.count(F.lit(1)) - F.sum(y)).alias("neg"))


def cumulative(scores: DataFrame, group_cols: Sequence[str] = (), label: str = "label", score: str = "score",
               buckets: int = RANGES, accuracy: int = 10_000) -> DataFrame:
    """Per distinct (group, score): pos, neg, cum_tp, cum_fp (counts at scores >= this one)."""
    g = list(group_cols)
    ps = per_score(scores, g, label, score)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = ps.groupBy(*g).agg(F.percentile_approx(score, probs, accuracy).alias("__cuts"),
                              F.min(score).alias("__min"), F.max(score).alias("__max"))
    s = F.col(score)
    placed = null_safe_join(ps, cuts, g).withColumn("__b", F.size(F.filter("__cuts", lambda c: c < s)))
    # The range's ends: the cut below (or the smallest score) and the cut above (or the largest).
    lo = F.when(F.col("__b") == 0, F.col("__min")).otherwise(F.get("__cuts", F.col("__b") - 1))
    hi = F.when(F.col("__b") >= F.size("__cuts"), F.col("__max")).otherwise(F.get("__cuts", F.col("__b")))
    part = F.floor((s - lo) / (hi - lo) * F.lit(buckets))
    placed = placed.withColumn("__s", F.when(hi > lo, F.greatest(F.lit(0), F.least(F.lit(buckets - 1), part))).otherwise(0).cast("int"))
    placed = placed.drop("__cuts", "__min", "__max")
    totals = placed.groupBy(*g, "__b", "__s").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    later_sub = Window.partitionBy(*g, "__b").orderBy(F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*g).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.groupBy(*g, "__b").agg(F.sum("__p").alias("__rp"), F.sum("__n").alias("__rn"))
    ranges = ranges.select(*g, "__b", _running("__rp", later).alias("__rp"), _running("__rn", later).alias("__rn"))
    offsets = totals.select(*g, "__b", "__s", _running("__p", later_sub).alias("__op"), _running("__n", later_sub).alias("__on"))
    offsets = null_safe_join(offsets, ranges, [*g, "__b"])
    inside = Window.partitionBy(*g, "__b", "__s").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    counted = placed.select(*g, score, "pos", "neg", "__b", "__s", F.sum("pos").over(inside).alias("__ip"), F.sum("neg").over(inside).alias("__in"))
    return null_safe_join(counted, offsets, [*g, "__b", "__s"]).select(
        *g, score, "pos", "neg", (F.col("__rp") + F.col("__op") + F.col("__ip")).alias("cum_tp"), (F.col("__rn") + F.col("__on") + F.col("__in")).alias("cum_fp"))


def _running(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def ranking_metrics(scores: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
                    score: str = "score", buckets: int = RANGES) -> DataFrame:
    """Per group: roc_auc (ties count one half) and average_precision (step-wise,
    sum over distinct scores of recall increase times precision)."""
    g = list(group_cols)
    cum = cumulative(scores, g, label, score, buckets)
    agg = cum.groupBy(*g).agg(
        F.sum("pos").alias("__P"), F.sum("neg").alias("__N"),
        F.sum(F.col("neg") * (F.col("cum_tp") - F.col("pos") / 2.0)).alias("__auc"),
        F.sum(F.col("pos") * (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp")))).alias("__ap"))
    return agg.select(
        *g,
        F.when((F.col("__P") > 0) & (F.col("__N") > 0),
               F.col("__auc") / (F.col("__P").cast("double") * F.col("__N"))).alias("roc_auc"),
        F.when(F.col("__P") > 0, F.col("__ap") / F.col("__P")).alias("average_precision"))


def roc_auc(scores: DataFrame, group_cols: Sequence[str] = (), **kw) -> DataFrame:
    return ranking_metrics(scores, group_cols, **kw).select(*group_cols, "roc_auc")


def average_precision(scores: DataFrame, group_cols: Sequence[str] = (), **kw) -> DataFrame:
    return ranking_metrics(scores, group_cols, **kw).select(*group_cols, "average_precision")


def pr_curve(scores: DataFrame, group_cols: Sequence[str] = (), label: str = "label", score: str = "score",
             buckets: int = RANGES) -> DataFrame:
    """precision, recall per distinct score (the threshold); the final (1, 0) point
    is not included."""
    g = list(group_cols)
    cum = cumulative(scores, g, label, score, buckets)
    src = null_safe_join(cum, cum.groupBy(*g).agg(F.sum("pos").alias("__P")), g)
    return src.select(
        *g, (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
        F.when(F.col("__P") > 0, F.col("cum_tp") / F.col("__P")).alias("recall"),
        F.col(score).alias("threshold"))


def _confusion_metrics(tp: Column, fp: Column, P: Column, N: Column) -> list[Column]:
    fn, tn = P - tp, N - fp
    return [
        _ratio(tp + tn, P + N).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, P).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def threshold_table(scores: DataFrame, thresholds: Sequence[float] | None = None,
                    group_cols: Sequence[str] = (), label: str = "label", score: str = "score",
                    ranking: DataFrame | None = None, buckets: int = RANGES) -> DataFrame:
    """One row per (group, threshold): tp, fp, fn, tn, accuracy, precision, recall,
    f1 (prediction = score >= threshold), plus roc_auc and average_precision
    (from ``ranking`` if it was computed before)."""
    g = list(group_cols)
    thr = sorted(float(t) for t in (thresholds if thresholds is not None else report_grid()))
    grid = F.array(*[F.lit(t) for t in thr])
    s = F.col(score)
    ps = per_score(scores, g, label, score)
    slots = (ps.withColumn("__slot", F.size(F.filter(grid, lambda t: t <= s)))
             .groupBy(*g, "__slot").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n")))
    totals = slots.groupBy(*g).agg(F.sum("__p").alias("P"), F.sum("__n").alias("N"))
    entries = F.array(*[F.struct(F.lit(j + 1).alias("__slot"), F.lit(t).alias("threshold"))
                        for j, t in enumerate(thr)])
    full = totals.select(*g, "P", "N", F.explode(entries).alias("e")).select(*g, "P", "N", "e.*")
    joined = null_safe_join(full, slots, g + ["__slot"], "left").fillna(0, subset=["__p", "__n"])
    suffix = Window.partitionBy(*g).orderBy(F.desc("__slot")).rowsBetween(Window.unboundedPreceding, 0)
    counted = joined.select(*g, "threshold", "P", "N", F.sum("__p").over(suffix).alias("tp"),
                            F.sum("__n").over(suffix).alias("fp"))
    out = counted.select(*g, "threshold", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
                         (F.col("N") - F.col("fp")).alias("tn"),
                         *_confusion_metrics(F.col("tp"), F.col("fp"), F.col("P"), F.col("N")))
    rank = ranking_metrics(scores, g, label, score, buckets) if ranking is None else ranking
    return null_safe_join(out, rank, g)


def binary_metrics(scores: DataFrame, threshold: float = 0.5, group_cols: Sequence[str] = (),
                   label: str = "label", score: str = "score", buckets: int = RANGES, ranking: DataFrame | None = None) -> DataFrame:
    """accuracy, precision, recall, f1 at ``threshold`` plus roc_auc, average_precision."""
    g = list(group_cols)
    y, pred = F.col(label).cast("long"), (F.col(score) >= F.lit(float(threshold))).cast("long")
    c = scores.groupBy(*g).agg(F.sum(y * pred).alias("tp"), F.sum((1 - y) * pred).alias("fp"),
                               F.sum(y).alias("P"), F.count(F.lit(1)).alias("n"))
    base = c.select(*g, *_confusion_metrics(F.col("tp"), F.col("fp"), F.col("P"), F.col("n") - F.col("P")))
    rank = ranking_metrics(scores, g, label, score, buckets) if ranking is None else ranking
    return null_safe_join(base, rank, g)


def best_threshold(table: DataFrame, group_cols: Sequence[str] = (), metric: str = "f1") -> DataFrame:
    """Row of the threshold table with the highest ``metric``; the lowest
    threshold wins ties (strictly-greater scan over a rising grid)."""
    g = list(group_cols)
    w = Window.partitionBy(*g).orderBy(F.desc(metric), F.asc("threshold"))
    return table.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def best_f1_metrics(scores: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
                    score: str = "score", ranking: DataFrame | None = None) -> DataFrame:
    """Metrics at the best-F1 threshold of the 91-value grid, with ``threshold``
    and ``best_f1_from_sweep``."""
    table = threshold_table(scores, tuning_grid(), group_cols, label, score, ranking)
    best = best_threshold(table, group_cols, "f1")
    return best.select(*group_cols, "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
                       "threshold", F.col("f1").alias("best_f1_from_sweep"))


def target_precision_threshold(scores: DataFrame, target_precision: float = 0.30,
                               group_cols: Sequence[str] = (), label: str = "label",
                               score: str = "score") -> DataFrame:
    """Among thresholds reaching the target precision, the one with the highest
    recall (then F1); if none does, the one with the highest precision."""
    g = list(group_cols)
    table = threshold_table(scores, report_grid(), g, label, score)
    eligible = F.col("precision") >= F.lit(float(target_precision))
    any_ok = F.max(eligible.cast("int")).over(Window.partitionBy(*g))
    ranked = table.withColumn("__ok", eligible.cast("int")).withColumn("__any", any_ok)
    k1 = F.when(F.col("__any") == 1, F.col("recall")).otherwise(F.col("precision"))
    k2 = F.when(F.col("__any") == 1, F.col("f1")).otherwise(F.lit(0.0))
    w = Window.partitionBy(*g).orderBy(F.desc("__ok"), F.desc(k1), F.desc(k2), F.asc("threshold"))
    return (ranked.withColumn("__r", F.row_number().over(w)).where("__r = 1")
            .drop("__r", "__ok", "__any"))


# ------------------------------------------------------------------ blending and alignment

def align_scores(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Key join of two score tables (never positional): keys, label, score_a, score_b.

    A key whose two labels differ raises an error when the row is read."""
    a = primary.select(*keys, F.col(label).alias("__la"), F.col("score").alias("score_a"))
    b = secondary.select(*keys, F.col(label).alias("__lb"), F.col("score").alias("score_b"))
    same = F.when(F.col("__la").eqNullSafe(F.col("__lb")), F.col("__la")).otherwise(F.raise_error(F.lit("labels of the two score tables differ")).cast("int"))
    return a.join(b, list(keys), "inner").select(*keys, same.alias(label), "score_a", "score_b")


def alignment_check(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Counts that must be zero before blending: label mismatches, unmatched keys."""
    a = primary.select(*keys, F.col(label).alias("__la")).withColumn("__ina", F.lit(1))
    b = secondary.select(*keys, F.col(label).alias("__lb")).withColumn("__inb", F.lit(1))
    j = a.join(b, list(keys), "full")
    both = F.col("__ina").isNotNull() & F.col("__inb").isNotNull()
    return j.agg(
        F.sum(both.cast("long")).alias("aligned"),
        F.sum((both & ~F.col("__la").eqNullSafe(F.col("__lb"))).cast("long")).alias("label_mismatches"),
        F.sum(F.col("__inb").isNull().cast("long")).alias("primary_only"),
        F.sum(F.col("__ina").isNull().cast("long")).alias("secondary_only"))


def blend_sweep_scores(aligned: DataFrame, weights: Sequence[float], keys: Sequence[str],
                       label: str = "label") -> DataFrame:
    """Long table (primary_weight, keys, label, score) for every weight: one job for all weights."""
    w = F.explode(F.array(*[F.lit(float(x)) for x in weights])).alias("primary_weight")
    long = aligned.select(*keys, label, "score_a", "score_b", w)
    return long.select("primary_weight", *keys, label,
                       (F.col("primary_weight") * F.col("score_a")
                        + (F.lit(1.0) - F.col("primary_weight")) * F.col("score_b")).alias("score"))


def blend_weight_sweep(aligned: DataFrame, weights: Sequence[float] = (0.5, 0.6, 0.7, 0.8, 0.9),
                       keys: Sequence[str] = (), label: str = "label", primary_name: str = "primary",
                       secondary_name: str = "secondary") -> DataFrame:
    """Per weight: roc_auc, average_precision, F1 at 0.5, and the best-F1 sweep
    result; ordered by (roc_auc, tuned_f1) descending."""
    long = blend_sweep_scores(aligned, weights, keys, label)
    g = ["primary_weight"]
    rank = cut_lineage(ranking_metrics(long, g, label))  # one row per weight, used twice
    default = binary_metrics(long, 0.5, g, label, ranking=rank).select(*g, "roc_auc", "average_precision",
                                                                      F.col("f1").alias("default_f1"))
    tuned = best_f1_metrics(long, g, label, ranking=rank).select(
        *g, F.col("f1").alias("tuned_f1"), F.col("precision").alias("tuned_precision"),
        F.col("recall").alias("tuned_recall"), F.col("threshold").alias("tuned_threshold"))
    return (default.join(tuned, g)
            .withColumn("secondary_weight", F.lit(1.0) - F.col("primary_weight"))
            .withColumn("label", F.format_string(f"{primary_name} %.1f + {secondary_name} %.1f",
                                                 "primary_weight", "secondary_weight"))
            .select("label", "primary_weight", "secondary_weight", "roc_auc", "average_precision", "default_f1",
                    "tuned_f1", "tuned_precision", "tuned_recall", "tuned_threshold")
            .orderBy(F.desc("roc_auc"), F.desc("tuned_f1")))


def leaderboard(long_scores: DataFrame, model_col: str = "model", label: str = "label") -> DataFrame:
    """Default (0.5) and tuned (best-F1) metrics per model, stacked, ordered by
    (average_precision, roc_auc, f1) descending within each kind."""
    g = [model_col]
    rank = cut_lineage(ranking_metrics(long_scores, g, label))  # one row per model, used twice
    default = binary_metrics(long_scores, 0.5, g, label, ranking=rank).select(
        F.lit("default").alias("kind"), *g, "accuracy", "precision", "recall", "f1", "roc_auc",
        "average_precision", F.lit(0.5).alias("threshold"))
    tuned = best_f1_metrics(long_scores, g, label, ranking=rank).select(
        F.lit("tuned").alias("kind"), *g, "accuracy", "precision", "recall", "f1", "roc_auc",
        "average_precision", "threshold")
    return default.unionByName(tuned).orderBy("kind", F.desc("average_precision"), F.desc("roc_auc"),
                                              F.desc("f1"), model_col)


def fold_records(scores: DataFrame, experiment: str, fold_col: str = "fold", threshold: float = 0.5, extra: dict | None = None) -> DataFrame:
    """One record (model, experiment, fold, metrics, then the ``extra`` fields) per model and fold of long scores,
    all evaluated in one job; the input of :func:`fold_summary`."""
    metrics = binary_metrics(scores, threshold, ["model", fold_col])
    values = [c for c in metrics.columns if c not in ("model", fold_col)]
    return metrics.select("model", F.lit(experiment).alias("experiment"), fold_col, *values, *[F.lit(v).alias(k) for k, v in (extra or {}).items()])


def fold_summary(fold_metrics: DataFrame, group_cols: Sequence[str] = ("experiment", "model"),
                 fold_col: str = "fold") -> DataFrame:
    """Mean and sample std of every numeric metric per group (``metric_mean``, ``metric_std``)."""
    from riskframe.operators.profile import numeric_columns

    metrics = [c for c in numeric_columns(fold_metrics) if c not in set(group_cols) | {fold_col}]
    aggs = []
    for c in metrics:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return fold_metrics.groupBy(*group_cols).agg(*aggs)
