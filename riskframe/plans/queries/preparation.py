"""Split, sample and fitted-preparation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import prepare as prep
from riskframe.operators import profile as prof
from riskframe.plans import tpch
from riskframe.plans.queries.common import (
    features, register, round_doubles, split_assignment, stored_features,
)


@register("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    apps = tpch.applicants(spark, sf_dir).select(tpch.KEY, tpch.TARGET)
    return prep.stratified_folds(apps, tpch.KEY, tpch.TARGET, 5)


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return split_assignment(spark, sf_dir)


@register("split_semi_join")
def q_split_semi_join(spark, sf_dir):
    train = prep.select_part(features(spark, sf_dir), split_assignment(spark, sf_dir), tpch.KEY, "train")
    return train.select(tpch.KEY, tpch.TARGET, "BUREAU_RECORD_COUNT", "INST_INST_DPD_SUM")


@register("sample_n")
def q_sample_n(spark, sf_dir):
    return prep.sample_n(tpch.applicants(spark, sf_dir), tpch.KEY, 200, seed=42).select(tpch.KEY, tpch.TARGET)


def feature_numeric(spark, sf_dir):
    df = stored_features(spark, sf_dir)
    return df, prof.numeric_columns(df, exclude=[tpch.KEY, tpch.TARGET])


@register("impute_median")
def q_impute_median(spark, sf_dir):
    df, num = feature_numeric(spark, sf_dir)
    med = prep.fit_medians(df, num)
    return round_doubles(df.select(tpch.KEY, *[prep.impute(c, med[c]).alias(c) for c in num]))


@register("impute_mode")
def q_impute_mode(spark, sf_dir):
    orders = tpch.table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    return prep.modes_frame(orders, ["o_orderstatus", "o_orderpriority"])


@register("standardize")
def q_standardize(spark, sf_dir):
    df, num = feature_numeric(spark, sf_dir)
    med = prep.fit_medians(df, num)
    imputed = df.select(*[prep.impute(c, med[c]).alias(c) for c in num])
    return round_doubles(prep.scaling_frame(imputed, num))


def _long_summary(ready: DataFrame, keep) -> DataFrame:
    cols = [c for c in ready.columns if c not in keep]
    long = ready.select(*cols).unpivot([], cols, "feature", "value")
    return long.groupBy("feature").agg(F.count("value").alias("n"), F.min("value").alias("min_value"),
                                       F.max("value").alias("max_value"))


@register("one_hot")
def q_one_hot(spark, sf_dir):
    apps = tpch.applicants(spark, sf_dir)
    cats = prep.fit_categories(apps, ["c_mktsegment", "n_name"])
    cols = [c for col in cats for c in prep.one_hot_columns(col, cats[col])]
    hot = apps.select(*cols)
    long = hot.unpivot([], hot.columns, "feature", "value")
    return long.groupBy("feature").agg(F.sum("value").alias("ones"), F.count(F.lit(1)).alias("rows"))


def ready_tables(spark, sf_dir, scale):
    from riskframe.session import cut_lineage

    # Every pass of the fit reads a part, so the split is joined once and stored with the rows.
    split = cut_lineage(split_assignment(spark, sf_dir))
    feats = cut_lineage(prep.mark_parts(features(spark, sf_dir), split, tpch.KEY))
    train = prep.marked_part(feats, "train")
    test = prep.marked_part(feats, "validation").drop(tpch.TARGET)
    return prep.build_ready(train, test, tpch.KEY, tpch.TARGET, scale_numeric=scale)


@register("ready_tree")
def q_ready_tree(spark, sf_dir):
    tr, _te, _spec, _dropped = ready_tables(spark, sf_dir, scale=False)
    return round_doubles(_long_summary(tr, [tpch.KEY, tpch.TARGET]))


@register("ready_linear")
def q_ready_linear(spark, sf_dir):
    _tr, te, _spec, _dropped = ready_tables(spark, sf_dir, scale=True)
    return round_doubles(_long_summary(te, [tpch.KEY]))
