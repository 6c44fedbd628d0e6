"""Scalar-expression, aggregate-component and naming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import exprs as ex
from riskframe.operators import profile as prof
from riskframe.operators.naming import safe_names
from riskframe.operators.rollup import Flag, RollupSpec, rollup
from riskframe.plans import tpch
from riskframe.plans.queries.common import features, register, round_doubles, union_all
from riskframe.plans.queries.evaluation import ALIGN_KEYS


ORDER_REFERENCE_DATE = "2002-01-01"


@register("derived_columns")
def q_derived_columns(spark, sf_dir):
    return round_doubles(tpch.applicants(spark, sf_dir))


@register("sentinel_to_null")
def q_sentinel_to_null(spark, sf_dir):
    o = tpch.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey", ex.sentinel_to_null(F.dayofmonth("o_orderdate"), tpch.ORDER_DAY_SENTINEL)
                    .alias("ORDER_DAY"))


@register("safe_ratio")
def q_safe_ratio(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", ALIGN_KEYS + ["l_tax", "l_discount"])
    return round_doubles(li.select(*ALIGN_KEYS, ex.safe_divide("l_tax", "l_discount").alias("tax_discount_ratio")))


@register("status_flags")
def q_status_flags(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", ALIGN_KEYS + ["l_returnflag", "l_linestatus"])
    flags = {f"RETURN_{v}_FLAG": ex.equals_flag("l_returnflag", v) for v in tpch.RETURN_FLAGS}
    flags.update({f"LINE_{v}_FLAG": ex.equals_flag("l_linestatus", v) for v in ("O", "F")})
    return li.select(*ALIGN_KEYS, *[c.alias(n) for n, c in flags.items()])


@register("threshold_flags")
def q_threshold_flags(spark, sf_dir):
    ev = tpch.table(spark, sf_dir, "events", ["event_id", "value"])
    v = F.col("value")
    return ev.select("event_id", ex.flag(v > tpch.DPD_THRESHOLD).alias("DPD_FLAG"),
                     ex.flag(v >= tpch.DPD_30_THRESHOLD).alias("DPD_30_FLAG"),
                     ex.flag(v >= tpch.DPD_DEF_THRESHOLD).alias("DPD_DEF_FLAG"))


@register("payment_lateness")
def q_payment_lateness(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", ALIGN_KEYS + ["l_shipdate"])
    o = tpch.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    j = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    lag = F.datediff("l_shipdate", "o_orderdate")
    return j.select(*ALIGN_KEYS, lag.alias("SHIP_LAG_DAYS"), ex.clip_lower(lag, 0).alias("DAYS_PAST_DUE"),
                    ex.clip_lower(F.datediff("o_orderdate", "l_shipdate"), 0).alias("DAYS_BEFORE_DUE"))


@register("row_stats")
def q_row_stats(spark, sf_dir):
    li = tpch.table(spark, sf_dir, "lineitem", ALIGN_KEYS + ["l_discount", "l_tax", "l_quantity"])
    parts = (ex.sentinel_to_null("l_discount", 0.0), F.col("l_tax"), F.col("l_quantity") / F.lit(50.0))
    return round_doubles(li.select(*ALIGN_KEYS, ex.row_mean(*parts).alias("ROW_MEAN"),
                                   ex.row_min(*parts).alias("ROW_MIN"), ex.row_max(*parts).alias("ROW_MAX")))


@register("age_years")
def q_age_years(spark, sf_dir):
    o = tpch.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    days = F.datediff("o_orderdate", F.lit(ORDER_REFERENCE_DATE).cast("date"))
    return round_doubles(o.select("o_orderkey", days.alias("DAYS_ORDER"), ex.years_from_days(days).alias("YEARS_ORDER")))


@register("group_count")
def q_group_count(spark, sf_dir):
    spec = RollupSpec(prefix="ORDERS", key="o_custkey")
    return rollup(tpch.table(spark, sf_dir, "orders", ["o_custkey"]), spec)


@register("unique_count")
def q_unique_count(spark, sf_dir):
    spec = RollupSpec(prefix="LINES", key="l_orderkey", unique="l_partkey", unique_name="UNIQUE_PART_COUNT")
    return rollup(tpch.table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"]), spec)


@register("status_counts_per_parent")
def q_status_counts_per_parent(spark, sf_dir):
    return rollup(tpch.table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"]),
                  tpch.bureau_balance_spec())


@register("flag_rollup")
def q_flag_rollup(spark, sf_dir):
    v = F.col("value")
    spec = RollupSpec(prefix="EV", key="user_id", flags=[
        Flag("EV_DPD", v > tpch.DPD_THRESHOLD, rate=True), Flag("EV_DPD_30", v >= tpch.DPD_30_THRESHOLD, rate=True),
        Flag("EV_DPD_DEF", v >= tpch.DPD_DEF_THRESHOLD, rate=True)])
    return round_doubles(rollup(tpch.table(spark, sf_dir, "events", ["user_id", "value"]), spec))


@register("numeric_stat_pack")
def q_numeric_stat_pack(spark, sf_dir):
    spec = RollupSpec(prefix="ORDERS", key="o_custkey", numerics=("o_totalprice",), scales=tpch.ORDER_SCALES)
    return round_doubles(rollup(tpch.table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice"]), spec))


FAMILY_PREFIXES = [("BUREAU_", "bureau_family"), ("PREV_", "previous_application"), ("POS_", "pos_cash"),
                   ("CC_", "credit_card"), ("INST_", "installments")]


def one_hot_names(spark, sf_dir) -> DataFrame:
    o = tpch.table(spark, sf_dir, "orders", ["o_orderpriority", "o_orderstatus"])
    parts = [o.select(F.concat(F.lit(f"{c}_"), F.coalesce(F.col(c), F.lit("None"))).alias("name")).distinct()
             for c in ("o_orderpriority", "o_orderstatus")]
    return union_all(parts).distinct()


@register("safe_names")
def q_safe_names(spark, sf_dir):
    return safe_names(one_hot_names(spark, sf_dir), order="name").select("name", "safe_name")


@register("feature_family")
def q_feature_family(spark, sf_dir):
    """Family label of every applicant column, on its null profile (whole table)."""
    prof_rows = prof.missing_profile(features(spark, sf_dir))
    return prof_rows.select(F.col("column").alias("feature"),
                            ex.prefix_family("column", FAMILY_PREFIXES, "application").alias("family"),
                            "null_count")
