"""Times the headline queries: median of three runs after one warm-up, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsework.plans.catalog import QUERIES
from pulsework.session import build_session

HEADLINES = [
    "daily_channel_report",
    "n7_campaign_variants",
    "n9_a6_canvas_steps",
    "n10_a5_campaign_channels",
    "n11_a5_canvas_channels",
    "n14_user_campaigns",
    "n16_user_canvas_steps",
    "n23_channel_days",
    "w1_latest_event_per_user_and_type",
    "j1_j5_delivery_metrics",
    "j2_journey_metrics",
    "j3_mixpanel_events",
    "j4_x15_amplitude_events",
    "a3_monthly_active_users",
    "a4_channel_touches",
    "a11_meter_merge",
    "k3_upsert",
    "k4_upsert_if_newer",
    "k5_replace_days",
    "r1_sync_registry",
    "r6_batch_ids",
    "st4_stream_daily_channel_sums",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        times = []
        for _ in range(repeats + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
