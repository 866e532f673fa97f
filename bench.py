"""Time the headline queries: one warm-up pass, then one measured pass, written to a no-op sink.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores;
``BENCH_QUERIES`` (comma separated) restricts the list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from lifeloom.session import configure  # noqa: E402
from lifeloom.workload import QUERIES, runner  # noqa: E402

HEADLINE = [
    "ins_lifetime_value", "ins_category_affinity", "ins_activation", "seg_high_value_at_risk",
    "job_global_suppression", "job_refresh_engagement", "job_cascade_orphans", "job_abandoned_carts", "job_loyalty_tiers",
    "job_inactive_tiers", "job_sunset", "job_frequency_cap", "job_catalog_promote", "job_order_fallback",
    "job_anonymized_orders", "job_crm_suppression", "job_dsar_erasure", "job_allocate_codes", "job_retention_sweep",
    "rpt_campaign_performance", "rpt_deliverability", "rpt_ab_test", "rpt_content_selection", "rpt_engagement_distribution",
    "rpt_program_kpis", "mon_guardrail_action", "dq_all_checks", "dq_unknown_sku", "rec_cross_sell", "rec_cart_blocks",
    "rec_welcome_products", "join_latest_asof", "win_change_detect", "top_k_under_cap", "out_welcome", "out_abandoned_cart",
    "out_post_purchase", "out_winback", "idr_exact_email", "idr_fuzzy_name",
    "idr_components", "idr_survivorship", "idr_write_bridge", "rpt_campaign_performance_daily", "agg_percentile_double",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    if wanted == ["all"]:
        wanted = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lifeloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    configure(spark)
    seconds = {}
    for key in wanted:
        run = runner(key)
        for attempt in ("warm", "measured"):
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
        seconds[key] = round(took, 3)
        print(f"{key} {took:.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "lifecycle_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
