"""Time the headline jobs and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. A job is
timed until its last row was produced; the load is timed once, queries are run once to
warm up and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from haulmark.session import build_session  # noqa: E402
from workload import materialised as built  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

ONCE = {
    "land_raw": built.raw_root,
    "load_warehouse": built.warehouse,
    "stream_ingest": built.event_table,
    "stream_ingest_stateful": built.stateful_event_table,
    "fit_logistic_full": built.logistic_model,
    "fit_boosting_ten_rounds": built.boosted_model,
}
HEADLINE = [
    "raw_scan_lineage",
    "star_extract",
    "shipment_page",
    "shipment_page_deep",
    "shipment_detail",
    "raw_explorer",
    "explorer_newest",
    "kpi_summary",
    "kpi_by_month",
    "kpi_by_region",
    "driver_scorecard",
    "route_scorecard",
    "weather_impact",
    "panel_filtered",
    "panel",
    "status_mix",
    "monthly_on_time",
    "weekday_delay",
    "segment_revenue",
    "monthly_revenue",
    "top_drivers",
    "vehicle_delay",
    "weather_delay",
    "traffic_delay",
    "dashboard_page",
    "lake_weather",
    "lake_traffic",
    "lake_count",
    "quality_report_clean",
    "quality_report_grown",
    "delay_risk",
    "stream_enrich",
    "features",
    "stratified_test_set",
    "label_encode",
    "filter_options",
    "first_wins_attributes",
    "recent_enrichment",
    "raw_csv_scan",
    "orphans",
    "rule_auc",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(job) -> float:
        start = time.perf_counter()
        job()
        return round(time.perf_counter() - start, 3)

    def drain(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: seconds(lambda job=job: job(spark, sf_dir)) for name, job in ONCE.items()}
    for name in HEADLINE:
        drain(name)
        times[name] = seconds(lambda name=name: drain(name))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
