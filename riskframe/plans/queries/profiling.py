"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import profile as prof
from riskframe.operators import sketches as sk
from riskframe.plans import tpch
from riskframe.plans.queries.common import (
    CORR_COLUMNS, LINEITEM_NUMERIC, OVERVIEW_TABLES, RECORD_SOURCES, STATUS_SOURCES, features, register,
    round_doubles, split_assignment, stage_dir, stored_features, union_all,
)


@register("missing_profile")
def q_missing_profile(spark, sf_dir):
    return round_doubles(prof.missing_profile(features(spark, sf_dir)))


@register("top_missing")
def q_top_missing(spark, sf_dir):
    return round_doubles(prof.top_missing(features(spark, sf_dir), top_n=12))


@register("table_overview")
def q_table_overview(spark, sf_dir):
    return prof.table_overview({t: tpch.table(spark, sf_dir, t) for t in OVERVIEW_TABLES}, OVERVIEW_TABLES)


@register("schema_summary")
def q_schema_summary(spark, sf_dir):
    return prof.schema_summary(features(spark, sf_dir), "applicant_features")


@register("dtype_counts")
def q_dtype_counts(spark, sf_dir):
    """Columns per data type of the applicant table, with its rows."""
    feats = features(spark, sf_dir)
    rows = feats.agg(F.count(F.lit(1)).alias("rows"))
    return prof.dtype_counts(feats).crossJoin(rows)  # one-row side


@register("status_counts")
def q_status_counts(spark, sf_dir):
    parts = []
    for t, c in STATUS_SOURCES:
        df = prof.status_counts(tpch.table(spark, sf_dir, t, [c]), c)
        parts.append(df.select(F.lit(t).alias("table_name"), F.lit(c).alias("column"),
                               F.col(c).cast("string").alias("value"), "count"))
    return union_all(parts)


@register("records_per_id")
def q_records_per_id(spark, sf_dir):
    return round_doubles(union_all([prof.records_per_id(tpch.table(spark, sf_dir, t, [c]), c, t)
                                 for t, c in RECORD_SOURCES]))


@register("target_balance")
def q_target_balance(spark, sf_dir):
    return round_doubles(prof.value_counts(tpch.applicants(spark, sf_dir), tpch.TARGET))


@register("rate_by_category")
def q_rate_by_category(spark, sf_dir):
    apps = tpch.applicants(spark, sf_dir)
    parts = [prof.rate_by_category(apps, c, tpch.TARGET).select(
        F.lit(c).alias("feature"), F.col(c).alias("category"), "rate", "n") for c in ("c_mktsegment", "n_name")]
    return round_doubles(union_all(parts))


@register("categorical_cardinality")
def q_categorical_cardinality(spark, sf_dir):
    return prof.categorical_cardinality(tpch.table(spark, sf_dir, "orders"))


@register("describe_numeric")
def q_describe_numeric(spark, sf_dir):
    return round_doubles(prof.describe_numeric(tpch.table(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC))


@register("correlation_matrix")
def q_correlation_matrix(spark, sf_dir):
    return round_doubles(prof.correlation_matrix(features(spark, sf_dir), CORR_COLUMNS))


@register("histogram")
def q_histogram(spark, sf_dir):
    return round_doubles(prof.histogram(tpch.table(spark, sf_dir, "lineitem", ["l_extendedprice"]),
                                        "l_extendedprice", bins=50))


def returned_lines(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
                                                "l_discount", "l_extendedprice"])
    return li.withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))


@register("box_stats")
def q_box_stats(spark, sf_dir):
    return round_doubles(prof.box_stats(returned_lines(spark, sf_dir), "l_extendedprice", "is_returned"))


@register("constant_columns")
def q_constant_columns(spark, sf_dir):
    return prof.constant_columns(features(spark, sf_dir))


@register("class_weights")
def q_class_weights(spark, sf_dir):
    return round_doubles(prof.class_weights(tpch.applicants(spark, sf_dir), tpch.TARGET))


@register("clip_at_quantile")
def q_clip_at_quantile(spark, sf_dir):
    counts = (tpch.table(spark, sf_dir, "orders", ["o_custkey"]).groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("record_count")))
    return round_doubles(prof.clip_at_quantile(counts, "record_count", 0.99, out="clipped"))


@register("schema_diff")
def q_schema_diff(spark, sf_dir):
    return prof.schema_diff(features(spark, sf_dir), tpch.applicants(spark, sf_dir).drop(tpch.TARGET))


@register("missing_train_test")
def q_missing_train_test(spark, sf_dir):
    from riskframe.operators.prepare import select_part

    feats, split = stored_features(spark, sf_dir), split_assignment(spark, sf_dir)
    train = select_part(feats, split, tpch.KEY, "train")
    test = select_part(feats, split, tpch.KEY, "validation").drop(tpch.TARGET)
    return round_doubles(prof.missing_train_test(train, test))


SKETCH_COLUMNS = ["l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("sketch_accuracy")
def q_sketch_accuracy(spark, sf_dir):
    """Sketches stored by return flag, one part refreshed, merged: per column the counts, and whether distinct
    counts (four deviations) and quartiles (twice the rank error) hold against the exact ones."""
    path = stage_dir(spark, "lineitem-sketches")
    items = tpch.table(spark, sf_dir, "lineitem", ["l_returnflag", *SKETCH_COLUMNS])
    sk.refresh_sketches(spark, path, items, "l_returnflag", SKETCH_COLUMNS)
    stored = sk.refresh_sketches(spark, path, items.where("l_returnflag = 'R'"), "l_returnflag", SKETCH_COLUMNS)
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = sk.sketch_statistics(stored, probs)
    long = items.select(*[F.col(c).cast("double").alias(c) for c in SKETCH_COLUMNS]).unpivot([], SKETCH_COLUMNS, "column", "x")
    # One row per column: its exact distinct count, and the ranks that the estimates take.
    near = long.join(F.broadcast(found), "column").groupBy("column").agg(
        F.count_distinct("x").alias("exact"), F.count("x").alias("n"),
        *[F.count_if(F.col("x") < F.col(q)).alias(f"{q}_low") for q in probs], *[F.count_if(F.col("x") <= F.col(q)).alias(f"{q}_high") for q in probs])
    slack = 2 * sk.RANK_ERROR
    within = [(F.col(f"{q}_low") / F.col("n") <= p + slack) & (F.col(f"{q}_high") / F.col("n") >= p - slack) for q, p in probs.items()]
    return found.join(near, "column").select(
        "column", "n_rows", "n_values", (F.abs(F.col("n_unique") - F.col("exact")) <= 4 * sk.DISTINCT_ERROR * F.col("exact") + 1).alias("distinct_holds"),
        (within[0] & within[1] & within[2]).alias("quantiles_hold"))
