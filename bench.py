"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from tierworks.plans.catalog import REGISTRY
from tierworks.session import build_session

HEADLINE = [
    "spc_08_sensor_alerts", "agg_01_daily_sensor_kpi", "agg_02_daily_revenue", "win_01_rank_readings",
    "win_02_neighbours", "win_05_previous_day", "ddp_02_dedup_latest", "join_01_validated_orders", "join_08_as_of",
    "chg_06_scd2_merge", "chg_13_change_feed", "chg_16_cdc_apply", "dq_08_suite", "dq_12_reconcile",
    "sem_02_flatten_array", "str_03_hourly_complete", "str_08_sessions_batch", "str_08_sessions_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(3):  # later runs are warm
            start = time.perf_counter()
            REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    per_second = {n: round(events / s) for n, s in seconds.items() if n.startswith(("spc_08", "str_"))}
    found = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds_warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "events_per_second": per_second,
                "sf": float(found.group(1)) if found else None,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
