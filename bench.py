"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs
per query after one warm-up (the median counts), BENCH_QUERIES a subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duewatch.catalog import QUERIES  # noqa: E402
from duewatch.session import build_session  # noqa: E402

HEADLINES = [
    "loan_dpd", "gold_label", "attr_age_impute", "click_mean_impute", "fin_numeric_clean", "fin_loan_onehot",
    "flt_asof_restamp", "asof_latest", "gold_join", "feat_cross", "prj_model_full", "join_lagged_label",
    "join_label_eval", "join_label_membership", "agg_bad_rate_by_mob", "agg_auc_by_group", "stat_auc", "stat_ks_2samp",
    "stat_chi2", "stat_histogram", "mon_auc_scores", "mon_alert_table", "mon_eval_record", "snk_snapshot_overwrite",
    "src_csv_scan", "ml_stratified_folds", "ml_cv_metrics", "ml_fit_classifier", "ml_attribution_totals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        taken = []
        for _ in range(1 + runs):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "total seconds over the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
