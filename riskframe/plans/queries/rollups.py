"""Roll-up queries."""

from __future__ import annotations

from riskframe.plans import tpch
from riskframe.plans.queries.common import applicant_features, register, round_doubles


@register("applicant_features")
def q_applicant_features(spark, sf_dir):
    return round_doubles(applicant_features(spark, sf_dir))


@register("two_level_rollup")
def q_two_level_rollup(spark, sf_dir):
    return round_doubles(tpch.bureau_family(spark, sf_dir))


@register("history_rollup")
def q_history_rollup(spark, sf_dir):
    return round_doubles(tpch.previous_family(spark, sf_dir))


@register("monthly_status_rollup")
def q_monthly_status_rollup(spark, sf_dir):
    return round_doubles(tpch.pos_family(spark, sf_dir))


@register("utilisation_rollup")
def q_utilisation_rollup(spark, sf_dir):
    return round_doubles(tpch.credit_card_family(spark, sf_dir))


@register("instalment_rollup")
def q_instalment_rollup(spark, sf_dir):
    return round_doubles(tpch.installments_family(spark, sf_dir))
