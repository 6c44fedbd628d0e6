"""``name -> SQL`` for every registered query that has a SQL equivalent."""

from __future__ import annotations

from riskframe.plans import oracle as o

ORACLE: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


add("applicant_features", o.applicant_features_query())
add("two_level_rollup", o.family_query("bureau"))
add("history_rollup", o.family_query("previous_application"))
add("monthly_status_rollup", o.family_query("pos_cash"))
add("utilisation_rollup", o.family_query("credit_card"))
add("instalment_rollup", o.family_query("installments"))

# profiling
from riskframe.plans import queries as q  # noqa: E402

add("missing_profile", o.missing_profile_sql())
add("top_missing", o.top_missing_sql(12))
add("table_overview", o.table_overview_sql(q.OVERVIEW_TABLES))
add("schema_summary", o.schema_summary_sql())
add("status_counts", o.status_counts_sql(q.STATUS_SOURCES))
add("records_per_id", o.records_per_id_sql(q.RECORD_SOURCES))
add("target_balance", o.target_balance_sql())
add("rate_by_category", o.rate_by_category_sql(["c_mktsegment", "n_name"]))
add("categorical_cardinality", o.categorical_cardinality_sql("orders", ["o_orderstatus", "o_orderdate",
                                                                         "o_orderpriority"]))
add("describe_numeric", o.describe_sql("lineitem", q.LINEITEM_NUMERIC))
add("correlation_matrix", o.correlation_sql(q.CORR_COLUMNS))
add("histogram", o.histogram_sql("lineitem", "l_extendedprice", 50))
add("box_stats", o.box_stats_sql())
add("constant_columns", o.constant_columns_sql())
add("class_weights", o.class_weights_sql())
add("clip_at_quantile", o.clip_at_quantile_sql())
add("schema_diff", o.schema_diff_sql())
add("dtype_counts", o.dtype_counts_sql())
add("missing_train_test", o.missing_train_test_sql())
# split, sample, preparation
add("stratified_split", o.stratified_split_sql())
add("stratified_folds", o.stratified_folds_sql())
add("fold_records", o.fold_records_sql())
add("split_semi_join", o.split_semi_join_sql())
add("sample_n", o.sample_n_sql(200, 42))
add("impute_median", o.impute_median_sql())
add("impute_mode", o.impute_mode_sql("orders", ["o_orderstatus", "o_orderpriority"]))
add("standardize", o.standardize_sql())
add("one_hot", o.one_hot_sql(["c_mktsegment", "n_name"]))
add("ready_tree", o.ready_summary_sql(scale=False))
add("ready_linear", o.ready_summary_sql(scale=True))
# evaluation
add("binary_metrics", o.binary_metrics_sql())
add("roc_auc", o.roc_auc_sql())
add("average_precision", o.average_precision_sql())
add("pr_curve", o.pr_curve_sql())
add("threshold_table", o.threshold_table_sql())
add("best_f1_threshold", o.best_f1_sql())
add("target_precision_threshold", o.target_precision_sql(0.30))
add("blend_scores", o.blend_scores_sql())
add("score_alignment", o.score_alignment_sql())
add("blend_weight_sweep", o.blend_sweep_sql())
add("model_leaderboard", o.leaderboard_sql())
add("fold_summary", o.fold_summary_sql(5))
# expressions, components, names, I/O
add("derived_columns", o.derived_columns_sql())
add("sentinel_to_null", o.sentinel_sql())
add("safe_ratio", o.safe_ratio_sql())
add("status_flags", o.status_flags_sql())
add("threshold_flags", o.threshold_flags_sql())
add("payment_lateness", o.payment_lateness_sql())
add("row_stats", o.row_stats_sql())
add("age_years", o.age_years_sql(q.ORDER_REFERENCE_DATE))
add("group_count", o.group_count_sql())
add("unique_count", o.unique_count_sql())
add("status_counts_per_parent", o.status_counts_per_parent_sql())
add("flag_rollup", o.flag_rollup_sql())
add("numeric_stat_pack", o.numeric_stat_pack_sql())
add("safe_names", o.safe_names_sql())
add("feature_family", o.feature_family_sql(q.FAMILY_PREFIXES))
add("parquet_roundtrip", o.parquet_roundtrip_sql())
add("csv_scan", o.csv_scan_sql())
add("csv_report_roundtrip", o.threshold_table_sql())
add("feature_manifest", o.feature_manifest_sql())
add("manifest_roundtrip", o.manifest_roundtrip_sql())
# modeling (spec expansion only; trained-model outputs get the rows-only check)
from riskframe.plans import modeling as _mdl  # noqa: E402

add("ablation_columns", o.ablation_columns_sql(_mdl.EXPERIMENTS))
add("experiment_counts", o.experiment_counts_sql(_mdl.EXPERIMENTS, _mdl.RECOMMENDED_RUNS))
add("score_alignment_trained", o.score_alignment_trained_sql())
add("attribution_additivity", o.attribution_additivity_sql(2000))
add("boosted_invariants", o.boosted_invariants_sql(_mdl.QUERY_ROUNDS))
add("ablation_invariants", o.ablation_invariants_sql(_mdl.EXPERIMENTS, _mdl.RECOMMENDED_RUNS))
add("forest_invariants", o.forest_invariants_sql(_mdl.QUERY_TREES))
from riskframe.plans.queries.profiling import SKETCH_COLUMNS  # noqa: E402
from riskframe.sources.inference import SAMPLE_ROWS  # noqa: E402

add("csv_inferred", o.csv_inferred_sql(SAMPLE_ROWS))
add("sketch_accuracy", o.sketch_accuracy_sql(SKETCH_COLUMNS))
