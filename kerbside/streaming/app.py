"""Runs one streaming application: ``spark-submit kerbside/streaming/app.py JOB --topics LOCATION --checkpoint DIR``.

Topics keep the feeds' names; ``--out`` names the topic that a job writes. With ``--once`` a job handles what its
topics hold now and ends, otherwise it runs until it is stopped.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from kerbside.schemas import FEEDS  # noqa: E402
from kerbside.sources.reference import UpsertSnapshot, read_zone_profile, schedule_rows  # noqa: E402
from kerbside.sources.topics import Topics  # noqa: E402
from kerbside.streaming import jobs  # noqa: E402
from kerbside.streaming.detectors import BUS_BLOCKS  # noqa: E402

#: Messages that a micro-batch takes at most (files, where topics are folders), so that a backlog comes in pieces.
MAX_PER_BATCH = 500_000
JOBS = ["ward-energy", "health-advisories", "incidents", "rolling-gridlock", "enrichment", "message-enrichment", "dlq-router"]
NEEDED = {"ward-energy": ["archive"], "health-advisories": ["zones"]}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--topics", required=True, help="broker list, or the folder of the topics")
    parser.add_argument("--format", default="kafka")
    parser.add_argument("--out", required=True, help="topic to write")
    parser.add_argument("--checkpoint", required=True, help="folder that driver and executors share")
    parser.add_argument("--archive", help="folder of the energy archive")
    parser.add_argument("--counts", help="folder in which the router counts rejected messages")
    parser.add_argument("--zones", help="zone profile as CSV")
    parser.add_argument("--schedule", default="route_schedule", help="upsert topic of the route schedule")
    parser.add_argument("--refresh-seconds", type=float, default=60, help="how long a schedule is kept")
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--max-per-batch", type=int, default=MAX_PER_BATCH)
    parser.add_argument("--ttl-ms", type=int, help="forget detector keys that are silent for so long")
    parser.add_argument("--event-order", action="store_true", help="incidents in event-time order, late rows dropped")
    parser.add_argument(
        "--bus-blocks", type=int, default=BUS_BLOCKS, help="incidents: blocks that a route's buses are dealt into")
    parser.add_argument("--trigger", help="such as '1 minute'; each job has its own default")
    parser.add_argument("--once", action="store_true")
    found = parser.parse_args(argv)
    for name in NEEDED.get(found.job, []):
        if getattr(found, name) is None:
            parser.error(f"{found.job} needs --{name}")
    return found


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """The job's query, started. Progress and shared tables stay under the checkpoint folder, a folder per job."""
    jobs.configure(spark)
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(f"{args.checkpoint}/shared")
    topics = Topics(args.topics, args.format)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger} if args.trigger else None
    to = (topics, args.out)
    last = (f"{args.checkpoint}/{args.job}", trigger)

    def feed(name: str):
        return jobs.read_feed(spark, topics, name, starting=args.starting, max_per_batch=args.max_per_batch)

    def raw(*names: str):
        return topics.stream(spark, *names, starting=args.starting, max_per_batch=args.max_per_batch)

    snapshot = UpsertSnapshot(spark, topics, args.schedule, f"{args.checkpoint}/{args.job}-schedule")
    schedule = jobs.refreshed(lambda: schedule_rows(snapshot.refresh()), args.refresh_seconds)
    if args.job == "ward-energy":
        return jobs.start_ward_energy(feed("smart_meters"), *to, args.archive, *last)
    if args.job == "health-advisories":
        return jobs.start_health_advisories(feed("air_quality"), read_zone_profile(spark, args.zones), *to, *last)
    if args.job == "incidents":
        feeds = [feed(name) for name in ("air_quality", "traffic_signals", "bus_gps")]
        found = jobs.incidents(*feeds, args.ttl_ms, args.event_order, args.bus_blocks)
        return jobs.start_incidents(found, *to, *last)
    if args.job == "rolling-gridlock":
        return jobs.start_rolling_gridlock(
            feed("traffic_signals"), *to, args.job, args.checkpoint, trigger, args.ttl_ms)
    if args.job == "enrichment":
        return jobs.start_enrichment(feed("bus_gps"), schedule, *to, *last)
    if args.job == "message-enrichment":
        return jobs.start_message_enrichment(raw("bus_gps"), schedule, *to, *last)
    return jobs.start_dlq_router(raw(*FEEDS), *to, *last, counts_path=args.counts)


if __name__ == "__main__":
    start(SparkSession.builder.getOrCreate(), arguments()).awaitTermination()
