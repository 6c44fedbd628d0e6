"""Training, ablation and attribution queries (M1-M11); rows-only checks:
learners differ between engines, so only the parts that don't depend on the
learner have a SQL twin."""

from __future__ import annotations

from riskframe.operators import metrics as met
from riskframe.operators.attribution import additivity, top_features
from riskframe.plans import modeling as mdl
from riskframe.plans.queries.common import register, round_doubles
from riskframe.plans.queries.expressions import FAMILY_PREFIXES


@register("train_lr")
def q_train_lr(spark, sf_dir):
    return round_doubles(mdl.evaluate(mdl.trained_scores(spark, sf_dir, "logistic_regression", mdl.QUERY_ROUNDS)))


@register("train_rf")
def q_train_rf(spark, sf_dir):
    return round_doubles(mdl.evaluate(mdl.train_forest(spark, sf_dir, mdl.QUERY_TREES)[1]))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    return round_doubles(mdl.evaluate(mdl.trained_scores(spark, sf_dir, "boosted_trees", mdl.QUERY_ROUNDS)))


@register("train_mlp")
def q_train_mlp(spark, sf_dir):
    return round_doubles(mdl.evaluate(mdl.train_network(spark, sf_dir, mdl.QUERY_HIDDEN)[1]))


@register("network_history")
def q_network_history(spark, sf_dir):
    history = mdl.network_history(mdl.train_network(spark, sf_dir, mdl.QUERY_HIDDEN)[0])
    return round_doubles(spark.createDataFrame(history, "iteration int, loss double"))


@register("network_grid")
def q_network_grid(spark, sf_dir):
    return round_doubles(mdl.network_grid(spark, sf_dir))


@register("grid_search")
def q_grid_search(spark, sf_dir):
    return round_doubles(mdl.logistic_grid(spark, sf_dir))


@register("forest_grid")
def q_forest_grid(spark, sf_dir):
    return round_doubles(mdl.forest_grid(spark, sf_dir))


@register("hybrid_trained")
def q_hybrid_trained(spark, sf_dir):
    return round_doubles(mdl.hybrid_sweep(spark, sf_dir, mdl.QUERY_ROUNDS))


@register("leaderboard_trained")
def q_leaderboard_trained(spark, sf_dir):
    return round_doubles(mdl.trained_leaderboard(spark, sf_dir, mdl.QUERY_ROUNDS))


@register("score_alignment_trained")
def q_score_alignment_trained(spark, sf_dir):
    return met.alignment_check(mdl.trained_scores(spark, sf_dir, "boosted_trees", mdl.QUERY_ROUNDS),
                               mdl.trained_scores(spark, sf_dir, "logistic_regression", mdl.QUERY_ROUNDS), [mdl.KEY])


@register("stacked_ensemble")
def q_stacked_ensemble(spark, sf_dir):
    return round_doubles(mdl.stacked(spark, sf_dir, mdl.QUERY_TREES, mdl.QUERY_ROUNDS, mdl.QUERY_HIDDEN))


@register("ablation_columns")
def q_ablation_columns(spark, sf_dir):
    return mdl.experiment_columns(spark, sf_dir)


@register("ablation")
def q_ablation(spark, sf_dir):
    return round_doubles(mdl.ablation(spark, sf_dir, mdl.QUERY_ROUNDS))


@register("experiment_counts")
def q_experiment_counts(spark, sf_dir):
    return mdl.experiment_counts(spark, sf_dir)


@register("removal_impact")
def q_removal_impact(spark, sf_dir):
    return round_doubles(mdl.removal_impact(mdl.ablation(spark, sf_dir, mdl.QUERY_ROUNDS)))


@register("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    return round_doubles(mdl.attributions(spark, sf_dir, n_iter=mdl.QUERY_ROUNDS).select(mdl.KEY, "feature", "contribution"))


@register("attribution_additivity")
def q_attribution_additivity(spark, sf_dir):
    return additivity(mdl.attributions(spark, sf_dir, n_iter=mdl.QUERY_ROUNDS), mdl.KEY)


@register("ablation_invariants")
def q_ablation_invariants(spark, sf_dir):
    return mdl.ablation_invariants(mdl.ablation(spark, sf_dir, mdl.QUERY_ROUNDS))


@register("boosted_grid")
def q_boosted_grid(spark, sf_dir):
    return round_doubles(mdl.boosted_grid(spark, sf_dir))


@register("boosted_invariants")
def q_boosted_invariants(spark, sf_dir):
    return mdl.boosted_invariants(spark, sf_dir, mdl.QUERY_ROUNDS)


@register("top_features")
def q_top_features(spark, sf_dir):
    return round_doubles(top_features(mdl.attributions(spark, sf_dir, None, mdl.QUERY_ROUNDS), 10, FAMILY_PREFIXES))


@register("balanced_forest")
def q_balanced_forest(spark, sf_dir):
    return round_doubles(mdl.evaluate(mdl.balanced_forest_scores(spark, sf_dir, mdl.QUERY_TREES)))


@register("forest_invariants")
def q_forest_invariants(spark, sf_dir):
    return mdl.forest_invariants(spark, sf_dir, mdl.QUERY_TREES)
