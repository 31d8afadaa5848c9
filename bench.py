"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local threads (default 8). Each query
is written to the no-op sink, so every row and column is computed. One small untimed query starts the
session's workers first.
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
    "ward_energy_15m", "energy_daily_rollup", "aqi_rolling_10m", "aqi_advisory", "gps_enriched", "dlq_records",
    "dlq_report", "null_aqi_rate", "valid_bus_gps", "json_roundtrip", "dedupe_readings", "event_milestones",
    "aqi_emergency", "gridlock_latched", "gridlock_rolling", "bus_bunching", "bus_pair_distance", "bus_contact_intervals", "incidents_all",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from kerbside.plans import catalog, views

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kerbside-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kerbside-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = catalog.queries()

    def seconds(name: str) -> float:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds("null_aqi_rate")
    times = {name: seconds(name) for name in HEADLINE}
    events = views.table(spark, sf_dir, "events").count()
    slowest = max(times.values())
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "events": events,
        "slowest_events_per_sec": round(events / slowest),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
