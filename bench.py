"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from counterfold.catalog import QUERIES

HEADLINE = [
    "ate_saturated", "aie_order2", "ps_bounded", "tmle_binary", "cvtmle_saturated",
    "joint_ate_cov", "factorial_ate", "ate_glm", "multi_estimator", "ate_glmnet",
    "ate_continuous_covariates", "glm_linear_fit", "glm_logistic_fit", "enet_cv", "gbt_fit",
    "gbt_tuned",
    "folds_cv", "folds_joint", "interactions_order2", "snp_dosage", "column_kinds",
    "influence_kept", "batched_run", "merge_results", "many_estimands",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, failed = {}, {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        start = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as e:  # the other queries still count
            failed[name] = f"{type(e).__name__}: {e}"[:200]
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "failed": failed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
