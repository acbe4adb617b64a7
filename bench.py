"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one warm-up, then the measured run, one JSON line.

Each result is computed in full and thrown away (``noop`` sink), so the time is that of the query.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("RISKMART_DRIVER_MEMORY", "12g")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskmart.queries import QUERIES  # noqa: E402
from riskmart.session import local_session  # noqa: E402

HEADLINE = (
    "s7_risk_profile", "s1_credit_score", "s2_fraud_score", "s3_market_score",
    "k1_dense_key", "k3_upsert", "k5_scd2_apply", "f1_fact_loan", "f2_fact_customer", "f5_fact_fraud",
    "v4_check_outliers", "v10_validate_staging", "v12_validate_pre_production", "v16_profile",
    "r2_consensus_by_group", "r4_fix_loan", "m5_suffix_duplicate_ids", "p16_common_words", "p17_fill_categorical",
    "i9_ecl", "w1_customer_risk", "w5_risk_dashboard",
    "p6_impute_numeric", "p7_knn_impute", "p15_split_multivalue", "e1_cook_dataset", "e3_stage_to_mart", "i10_ecl_movement", "i11_run_ifrs9",
)


def run(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "riskmart-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in HEADLINE:
        run(spark, key, sf_dir)
        times[key] = round(run(spark, key, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
