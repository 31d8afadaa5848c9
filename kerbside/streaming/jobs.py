"""The streaming applications: topics in, operators, topics and archives out."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kerbside.functions.json_codec import decode_json, encode_json
from kerbside.operators import advisory, alerts, energy, enrich, validate
from kerbside.operators.staging import new_path, staged
from kerbside.schemas import FEEDS
from kerbside.sources.reference import COMMIT_COLUMNS, commits_of
from kerbside.sources.topics import Topics
from kerbside.streaming import detectors

# How often a micro-batch starts, how often rejected records are reported, and how late
# the detectors' rows may come.
TRIGGER = "1 minute"
REPORT_WINDOW = "5 minutes"
DETECTOR_LATENESS = {"air_quality": "15 seconds", "traffic_signals": "10 seconds", "bus_gps": "5 seconds"}

# The keyed state of the detectors needs this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings of the streaming jobs: state store, and times that do not depend on the machine."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def read_feed(
    spark: SparkSession,
    topics: Topics,
    feed: str,
    topic: str | None = None,
    starting: str = "latest",
    max_per_batch: int | None = None,
    valid_only: bool = False,
) -> DataFrame:
    """One feed's topic as typed rows with ``event_time`` and the message offset as ``event_id``.

    Like the applications they serve, feeds come unvalidated unless ``valid_only`` is set.
    """
    raw = topics.stream(spark, topic or feed, starting=starting, max_per_batch=max_per_batch)
    rows = decode_json(raw, FEEDS[feed], keep=("offset",)).withColumnRenamed("offset", "event_id")
    return validate.valid_rows(rows, feed) if valid_only else rows


def _start(
    writer: DataStreamWriter,
    checkpoint: str,
    mode: str,
    trigger: dict,
    name: str | None = None,
) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    return writer.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _every(trigger: dict | None) -> dict:
    return trigger or {"processingTime": TRIGGER}


def dual_sink(
    write_messages: Callable[[DataFrame], None], archive_path: str, folders: tuple[str, ...] = ("ward_id", "date")
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer of ward summaries: keyed JSON and the partitioned Parquet archive.

    The batch is computed once for both. A window appears in the archive once per batch that changed it,
    marked with the batch id and the start of the job; ``latest_ward_energy`` picks the newest, which also absorbs a batch that
    was written twice because the job failed in between. Last of all the batch and its dates are noted in the archive's
    commits, so that ``committed_energy_archive`` shows no batch whose job failed between the sinks and ``EnergyDays``
    knows what has changed. ``folders`` are the archive's partition columns; by ``date`` alone it has fewer files.
    """
    started = datetime.now(timezone.utc)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_messages(encode_json(batch.drop("reading_count", "power_factor_count"), "ward_id"))
            (
                energy.archive_rows(batch, batch_id, started)
                .repartition(*folders)  # one file per folder and batch
                .write.mode("append")
                .partitionBy(*folders)
                .parquet(archive_path)
            )
            written = energy.archive_rows(batch, batch_id, started).select(*COMMIT_COLUMNS).distinct()
            written.coalesce(1).write.mode("append").parquet(commits_of(archive_path))
        finally:
            batch.unpersist()

    return write


def start_ward_energy(
    meters: DataFrame, topics: Topics, topic: str, archive_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ward energy windows to a topic keyed by ward and to the archive."""
    sink = dual_sink(topics.writer(topic), archive_path)
    writer = energy.ward_energy(meters, weights=True).writeStream.foreachBatch(sink)
    return _start(writer, checkpoint, "update", _every(trigger))


def start_health_advisories(
    readings: DataFrame, zones: DataFrame, topics: Topics, topic: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Unhealthy rolling averages to a topic keyed by zone.

    A window that falls back below the threshold is not withdrawn; it is no longer sent.
    """
    found = advisory.health_advisories(advisory.rolling_aqi(readings), zones)
    return _start(topics.append_stream(encode_json(found, "zone"), topic), checkpoint, "update", _every(trigger))


def incidents(
    air_quality: DataFrame,
    signals: DataFrame,
    gps: DataFrame,
    ttl_ms: int | None = None,
    in_event_order: bool = False,
    bus_blocks: int = detectors.BUS_BLOCKS,
) -> DataFrame:
    """Alerts of the three detectors as one stream; keys silent for ``ttl_ms`` are forgotten (default: never).

    ``in_event_order`` makes the feeds' lateness count: rows wait for it and are handled in event-time order.
    ``bus_blocks`` spreads each route over as many tasks as it has pairs of blocks.
    """
    late = DETECTOR_LATENESS
    how = {"ttl_ms": ttl_ms, "in_event_order": in_event_order}
    return alerts.all_incidents(
        detectors.stream_aqi_emergencies(air_quality.withWatermark("event_time", late["air_quality"]), **how),
        detectors.stream_gridlock(signals.withWatermark("event_time", late["traffic_signals"]), **how),
        detectors.stream_bus_bunching(
            gps.withWatermark("event_time", late["bus_gps"]), bus_blocks=bus_blocks, **how),
    )


def start_rolling_gridlock(
    signals: DataFrame,
    topics: Topics,
    topic: str,
    group: str,
    checkpoint_root: str,
    trigger: dict | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """An alert per breaching cycle from the third in a row on, keyed by junction, as a reader of its own."""
    late = signals.withWatermark("event_time", DETECTOR_LATENESS["traffic_signals"])
    found = detectors.stream_gridlock(late, latch=False, ttl_ms=ttl_ms)
    return start_reader(
        found, lambda batch, _: topics.append(encode_json(batch, "junction_id"), topic), group, checkpoint_root,
        trigger, mode="update",
    )


def start_incidents(found: DataFrame, topics: Topics, topic: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Alerts to a topic, without a key and with their NULL fields written out."""
    messages = encode_json(found, None, keep_nulls=True)
    return _start(topics.append_stream(messages, topic), checkpoint, "update", trigger or {"processingTime": "0 seconds"})


def refreshed(read: Callable[[], DataFrame], seconds: float) -> Callable[[], DataFrame]:
    """``read`` as a source of micro-batches that runs at most every so many seconds.

    Between, its rows come from one staged table, whose size tells the planner whether to broadcast it; a table
    read from a broker has no known size. Only for micro-batches that follow one another: the table is replaced.
    """
    held: dict = {}

    def current() -> DataFrame:
        if not held or time.monotonic() - held["at"] >= seconds:
            rows = read()
            path = held.get("path") or new_path(rows.sparkSession)
            held.update(path=path, rows=staged(rows, path), at=time.monotonic())
        return held["rows"]

    return current


def start_enrichment(
    gps: DataFrame,
    schedule: Callable[[], DataFrame],
    topics: Topics,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Positions with their schedule to a topic keyed by route; ``schedule`` is asked anew for every batch."""
    columns = [c for c in gps.columns if c not in ("event_time", "event_id")]

    def write(batch: DataFrame, _: int) -> None:
        found = enrich.enrich_positions(batch.select(*columns), schedule())
        topics.append(encode_json(found, "route_id", keep_nulls=True), topic)

    return _start(gps.writeStream.foreachBatch(write), checkpoint, "append", trigger or {"processingTime": "0 seconds"})


def start_message_enrichment(
    raw: DataFrame,
    schedule: Callable[[], DataFrame],
    topics: Topics,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The same without a schema: keys unchanged, undeclared fields passed through."""

    def write(batch: DataFrame, _: int) -> None:
        topics.append(enrich.enrich_messages(batch, schedule()), topic)

    return _start(raw.writeStream.foreachBatch(write), checkpoint, "append", trigger or {"processingTime": "0 seconds"})


def start_dlq_router(
    raw: DataFrame,
    topics: Topics,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    counts_path: str | None = None,
) -> StreamingQuery:
    """Messages that fail validation to the dead-letter topic, under their own key.

    With ``counts_path`` the same pass over the topics counts them by window of arrival and reason, for
    ``routed_report``. Each batch's counts replace what an earlier try of it wrote, so none counts twice.
    """
    _, rejected = validate.split(validate.validate_messages(raw))
    trigger = trigger or {"processingTime": "0 seconds"}
    if counts_path is None:
        messages = validate.dlq_messages(validate.dlq_records(rejected))
        return _start(topics.append_stream(messages, topic), checkpoint, "append", trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            topics.append(validate.dlq_messages(validate.dlq_records(batch)), topic)
            window = F.window("timestamp", REPORT_WINDOW)["start"].alias("window_start")
            counts = batch.groupBy(window, "error_reason").agg(F.count(F.lit(1)).alias("n"))
            counts.coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return _start(rejected.writeStream.foreachBatch(write), checkpoint, "append", trigger)


def routed_report(spark: SparkSession, counts_path: str, window: bool = True) -> DataFrame:
    """Count and share of each reason as the router counted them, per window of arrival or over everything.

    It reads a row per batch, window and reason, never the topics.
    """
    keys = ["window_start"] if window else []
    counted = spark.read.schema("window_start timestamp, error_reason string, n long, batch long").parquet(counts_path)
    counts = counted.groupBy(*keys, "error_reason").agg(F.sum("n").alias("n"))
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return counts.withColumn("pct", share).orderBy(*keys, F.desc("n"), "error_reason")


def dlq_counts(raw: DataFrame, window: str | None = REPORT_WINDOW, lateness: str = "0 seconds") -> DataFrame:
    """Running count of rejected messages per reason: since the start, or per window of arrival time."""
    _, rejected = validate.split(validate.validate_messages(raw))
    if window is None:
        return rejected.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))
    late = rejected.withWatermark("timestamp", lateness)
    # Grouped by the window as a whole: its start alone would carry no watermark, and state would stay for good.
    return late.groupBy(F.window("timestamp", window).alias("w"), "error_reason").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("window_start"), "error_reason", "n")


def dlq_shares(raw: DataFrame, window: str = REPORT_WINDOW, lateness: str = "0 seconds") -> DataFrame:
    """Count and share of each reason per window of arrival time; a window's reasons always come together.

    The reasons are a fixed list, so a window is one row of counts, and shares need no second aggregate.
    """
    _, rejected = validate.split(validate.validate_messages(raw))
    if raw.isStreaming:
        rejected = rejected.withWatermark("timestamp", lateness)
    counts = rejected.groupBy(F.window("timestamp", window).alias("w")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("error_reason") == reason).alias(reason) for reason in validate.REASONS],
    )
    each = F.explode(F.array(*[
        F.struct(F.lit(reason).alias("error_reason"), F.col(reason).alias("n")) for reason in validate.REASONS
    ]))
    return counts.select(F.col("w.start").alias("window_start"), "total", each.alias("r")).where(F.col("r.n") > 0).select(
        "window_start", "r.error_reason", "r.n", (100.0 * F.col("r.n") / F.col("total")).alias("pct")
    )


def start_dlq_report(
    raw: DataFrame, publish: Callable[[DataFrame], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every five minutes, hand the shares of all reasons seen so far to ``publish``."""

    def write(counts: DataFrame, _: int) -> None:
        share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
        publish(counts.withColumn("pct", share).orderBy(F.desc("n"), "error_reason"))

    writer = dlq_counts(raw, window=None).writeStream.foreachBatch(write)
    return _start(writer, checkpoint, "complete", trigger or {"processingTime": REPORT_WINDOW})


def start_raw_archive(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Typed rows of a feed to Parquet, one folder per event date."""
    dated = rows.withColumn("date", F.to_date("event_time"))
    writer = dated.writeStream.format("parquet").option("path", path).partitionBy("date")
    return _start(writer, checkpoint, "append", _every(trigger))


def start_reader(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    group: str,
    checkpoint_root: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """A reader with its own progress and scheduler pool.

    Readers of one topic do not hold each other up: each keeps its offsets in its own checkpoint, and a
    fair scheduler shares the cluster between their pools.
    """
    spark = rows.sparkSession
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", group)
    try:
        return _start(
            rows.writeStream.foreachBatch(handle), f"{checkpoint_root}/{group}", mode, _every(trigger), group
        )
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
