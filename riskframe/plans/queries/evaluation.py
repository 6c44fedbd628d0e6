"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.operators import metrics as met
from riskframe.plans import tpch
from riskframe.plans.queries.common import register, round_doubles, union_all


SCORE_KEYS = ["l_orderkey", "l_linenumber"]
# Scores derived from lineitem columns, each in [0, 1]; label = returned line.
SCORE_MODELS = {"quantity": ("l_quantity", 1 / 50.0), "discount": ("l_discount", 10.0), "tax": ("l_tax", 12.5)}
BLEND_WEIGHT = 0.8
FOLDS = 5


def scored_lines(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", SCORE_KEYS + ["l_returnflag", "l_quantity", "l_discount", "l_tax"])
    return li.select(*SCORE_KEYS, (F.col("l_returnflag") == "R").cast("int").alias("label"),
                     *[(F.col(c) * F.lit(f)).alias(f"score_{m}") for m, (c, f) in SCORE_MODELS.items()])


def model_scores(spark, sf_dir, with_blend=False):
    s = scored_lines(spark, sf_dir)
    parts = [s.select(F.lit(m).alias("model"), *SCORE_KEYS, "label", F.col(f"score_{m}").alias("score"))
             for m in SCORE_MODELS]
    if with_blend:
        from riskframe.functions.exprs import blend

        parts.append(s.select(F.lit("blend").alias("model"), *SCORE_KEYS, "label",
                              blend("score_quantity", "score_discount", BLEND_WEIGHT).alias("score")))
    return union_all(parts)


ALIGN_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def one_model(spark, sf_dir, m, keys=None):
    li = tpch.table(spark, sf_dir, "lineitem", ALIGN_KEYS + ["l_returnflag", SCORE_MODELS[m][0]])
    c, f = SCORE_MODELS[m]
    return li.select(*(keys or SCORE_KEYS), (F.col("l_returnflag") == "R").cast("int").alias("label"),
                     (F.col(c) * F.lit(f)).alias("score"))


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    return round_doubles(met.binary_metrics(model_scores(spark, sf_dir), 0.5, ["model"]))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return round_doubles(met.roc_auc(model_scores(spark, sf_dir), ["model"]))


@register("average_precision")
def q_average_precision(spark, sf_dir):
    return round_doubles(met.average_precision(model_scores(spark, sf_dir), ["model"]))


@register("pr_curve")
def q_pr_curve(spark, sf_dir):
    return round_doubles(met.pr_curve(model_scores(spark, sf_dir), ["model"]))


@register("threshold_table")
def q_threshold_table(spark, sf_dir):
    return round_doubles(met.threshold_table(model_scores(spark, sf_dir), met.report_grid(), ["model"]))


@register("best_f1_threshold")
def q_best_f1_threshold(spark, sf_dir):
    return round_doubles(met.best_f1_metrics(model_scores(spark, sf_dir), ["model"]))


@register("target_precision_threshold")
def q_target_precision_threshold(spark, sf_dir):
    return round_doubles(met.target_precision_threshold(model_scores(spark, sf_dir), 0.30, ["model"]))


@register("blend_scores")
def q_blend_scores(spark, sf_dir):
    from riskframe.functions.exprs import blend

    s = scored_lines(spark, sf_dir)
    return round_doubles(s.select(*SCORE_KEYS, "label",
                                  blend("score_quantity", "score_discount", BLEND_WEIGHT).alias("score")))


@register("score_alignment")
def q_score_alignment(spark, sf_dir):
    return met.alignment_check(one_model(spark, sf_dir, "quantity", ALIGN_KEYS),
                               one_model(spark, sf_dir, "discount", ALIGN_KEYS), ALIGN_KEYS)


@register("blend_weight_sweep")
def q_blend_weight_sweep(spark, sf_dir):
    # both scores of a line sit on the same row, so no key join is needed here
    aligned = scored_lines(spark, sf_dir).select(*SCORE_KEYS, "label", F.col("score_quantity").alias("score_a"),
                                                  F.col("score_discount").alias("score_b"))
    return round_doubles(met.blend_weight_sweep(aligned, (0.5, 0.6, 0.7, 0.8, 0.9), SCORE_KEYS,
                                                primary_name="quantity", secondary_name="discount"))


@register("model_leaderboard")
def q_model_leaderboard(spark, sf_dir):
    return round_doubles(met.leaderboard(model_scores(spark, sf_dir, with_blend=True)))


def fold_of(keys) -> Column:
    tag = F.concat_ws(":", F.lit("fold"), *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(tag), 1, 8), 16, 10).cast("long"), F.lit(FOLDS)).cast("int")


@register("fold_records")
def q_fold_records(spark, sf_dir):
    long = model_scores(spark, sf_dir).withColumn("fold", fold_of(SCORE_KEYS))
    return round_doubles(met.fold_records(long, "lineitem_scores", extra={"folds": FOLDS}))


@register("fold_summary")
def q_fold_summary(spark, sf_dir):
    long = model_scores(spark, sf_dir).withColumn("fold", fold_of(SCORE_KEYS))
    per_fold = met.binary_metrics(long, 0.5, ["model", "fold"]).withColumn("experiment", F.lit("lineitem_scores"))
    return round_doubles(met.fold_summary(per_fold, ["experiment", "model"], "fold"))
