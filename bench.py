"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed to completion through the ``noop`` sink (full
computation, nothing collected to the driver) and timed from plan
construction to the end of the write, in one session (cold JVM). With
``BENCH_WARMUP_DIR=/root/testdata/sf0.001`` every query first runs once on that
table set to warm the JIT and code-generation caches. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "applicant_features", "two_level_rollup", "history_rollup", "monthly_status_rollup", "utilisation_rollup",
    "instalment_rollup", "missing_profile", "describe_numeric", "correlation_matrix", "records_per_id",
    "box_stats", "histogram", "constant_columns", "stratified_split", "impute_median", "ready_tree",
    "binary_metrics", "pr_curve", "threshold_table", "best_f1_threshold", "blend_weight_sweep",
    "model_leaderboard", "fold_summary", "train_lr", "train_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    shuffle = max(8, 2 * cpus)

    from riskframe.plans.queries import QUERIES
    from riskframe.session import get_session

    extra = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    if not os.environ.get("SPARK_CHECKPOINT_SET"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-ckpt-", dir="/tmp")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=shuffle, app_name="riskframe-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "")
    warm_seconds = None
    if warm_dir:
        t0 = time.perf_counter()
        for name in names:
            try:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - reported by the timed pass
                pass
        warm_seconds = round(time.perf_counter() - t0, 3)

    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
           "cpus": cpus, "shuffle_partitions": shuffle, "warmup_dir": warm_dir or None,
           "warmup_seconds": warm_seconds}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
