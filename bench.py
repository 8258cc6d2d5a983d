"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
BENCH_SCALING=1 also times all queries warm on the sibling folders with other scale factors.
Each query is planned and run to a sink that discards rows: once cold, then twice warm. The
per-query figure is the better warm run; ``cold`` holds the first ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sfqueries import REGISTRY  # noqa: E402

HEADLINE = [
    "band_threshold_sums",
    "band_reconciliation",
    "fact_provider",
    "fact_specialty",
    "fact_ae_kpis",
    "grain_reconciliation",
    "published_total_check",
    "duplicate_keys",
    "conflicting_attributes",
    "foreign_key_renamed",
    "range_checks",
    "qa_summary",
    "missing_profile",
    "numeric_profile",
    "character_profile",
    "character_profile_texts",
    "exact_duplicates",
    "exact_duplicate_texts",
    "rows_and_distinct",
    "date_dim",
    "entity_dim",
    "attribute_dim",
    "csv_round_trip",
    "zip_read",
    "stage_hand_off",
    "parse_month",
    "first_n",
    "month_on_month",
    "rank_percentile",
    "region_compare",
    "model_qa_summary",
]


def scale_factor(folder: str) -> float:
    return float(os.path.basename(folder.rstrip("/")).removeprefix("sf"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallymart-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str, folder: str = sf_dir) -> float:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = {name: once(name) for name in HEADLINE}
    warm = {name: min(once(name), once(name)) for name in HEADLINE}
    report = {
        "metric": "headline_queries_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": scale_factor(sf_dir),
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_SCALING"):
        parent = os.path.dirname(sf_dir.rstrip("/"))
        folders = [os.path.join(parent, d) for d in os.listdir(parent) if d.startswith("sf")]
        report["scaling"] = {
            scale_factor(d): round(sum(min(once(n, d), once(n, d)) for n in HEADLINE), 3)
            for d in sorted(folders, key=scale_factor)
        }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
