"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from panelkit.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "fs4_silver_loans", "fs3_silver_financials", "fs7_label_rate_by_month", "jn6_as_of_orders", "agg4_group_median",
    "agg9_window_statistics", "agg9_window_medians", "fs15_lookback_features", "fs11_age_imputation", "fs13_count_imputation",
    "fs16_gold_feature_store", "fs19_inference_features", "st4_psi_by_month", "st6_auc_by_month", "st13_spearman_with_label",
    "mon2_monthly_summary", "gov1_refresh_decisions", "snk3_dynamic_partitions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", 8, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not measured
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
