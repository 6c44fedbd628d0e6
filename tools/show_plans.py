"""Print the physical plan trees of a few headline queries (docs/PLANS.md).

    python tools/show_plans.py [sf_dir]

Broadcast thresholds are switched off so that the plans shown are the ones a
large input gets (small inputs additionally get broadcast joins).
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def tree(df) -> str:
    import re

    text = df._jdf.queryExecution().executedPlan().treeString()
    # elide long literal arrays (percentile cut points) and expression ids
    text = re.sub(r"\[(?:-?[0-9.E]+,){8,}-?[0-9.E]+\]", "[...]", text)
    text = re.sub(r"#\d+L?", "", text)
    return text.rstrip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from riskframe.operators import metrics as met
    from riskframe.operators.quantiles import exact_quantiles
    from riskframe.plans import queries as q
    from riskframe.plans import tpch
    from riskframe.session import get_session

    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    shown = {
        "applicant_features (flagship)": q.applicant_features(spark, sf_dir),
        "ranking metrics (AUC / AP per model)": met.ranking_metrics(q.model_scores(spark, sf_dir), ["model"]),
        "threshold sweep (19 thresholds, one pass) with ranking": met.threshold_table(
            q.model_scores(spark, sf_dir), met.report_grid(), ["model"]),
        "exact quantiles, last step over the stored bands (lineitem prices by return flag)": exact_quantiles(
            q.returned_lines(spark, sf_dir), ["l_extendedprice"], [0.25, 0.5, 0.75], ["is_returned"]),
        "instalment roll-up": tpch.installments_family(spark, sf_dir),
    }
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")
    _ = F


if __name__ == "__main__":
    main()
