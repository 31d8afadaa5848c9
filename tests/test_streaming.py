"""Streams: fed file by file in event-time order, they must end where the batch operators do."""

from __future__ import annotations

import json
import random
import re
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from kerbside.functions.json_codec import decode_json
from kerbside.operators import advisory, alerts, energy, enrich, milestones, validate
from kerbside.operators.aqi import aqi_emergencies
from kerbside.operators.bunching import bus_bunching
from kerbside.operators.gridlock import gridlock
from kerbside.plans import views
from kerbside.schemas import FEEDS
from kerbside.sources.reference import EnergyDays, UpsertSnapshot, committed_energy_archive, current_route_schedule, read_energy_archive, schedule_rows
from kerbside.sources.topics import Topics
from kerbside.streaming import app, detectors, jobs

SF_DIR = "/root/testdata/sf0.001"
NOW = {"availableNow": True}
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    """The four feeds as topics of message files, three files each, in event-time order."""
    root = tmp_path_factory.mktemp("topics")
    topics = Topics(str(root), "parquet")
    for feed in FEEDS:
        messages = views.messages(spark, SF_DIR, feed).withColumn("timestamp", F.col("event_time").cast("timestamp"))
        for low, high in ((0, 400), (400, 700), (700, 1000)):
            part = messages.where((F.col("offset") >= low) & (F.col("offset") < high)).drop("event_time")
            topics.append(part.coalesce(1), feed)
    return topics


def read(spark, feeds, feed, **options):
    return jobs.read_feed(spark, feeds, feed, max_per_batch=1, **options)


def typed(spark, feed):
    """What the stream of a feed holds, as a batch table."""
    return decode_json(views.messages(spark, SF_DIR, feed), FEEDS[feed], keep=("offset",)).withColumnRenamed(
        "offset", "event_id")


def collected(df, **writing):
    """Rows of a stream, collected batch by batch."""
    found = []
    query = df.writeStream.foreachBatch(lambda batch, n: found.append(batch.collect()))
    query = query.outputMode(writing.pop("mode", "update")).trigger(**NOW)
    for name, value in writing.items():
        query = query.option(name, value)
    started = query.start()
    started.awaitTermination()
    return found


def values(topics, name, spark):
    return [json.loads(r.value) for r in spark.read.parquet(f"{topics.location}/{name}").collect()]


def at(seconds):
    return START + timedelta(seconds=seconds)


# --- ward energy ---------------------------------------------------------------------------------

def test_ward_energy_reaches_both_sinks_and_survives_a_restart(spark, feeds, tmp_path):
    out, archive, checkpoint = Topics(str(tmp_path), "parquet"), str(tmp_path / "archive"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new and adds nothing
        jobs.start_ward_energy(
            read(spark, feeds, "smart_meters"), out, "summary", archive, checkpoint, NOW).awaitTermination()
    written = read_energy_archive(spark, archive)
    keep = ["ward_id", "window_start", "window_end", "peak_voltage", F.round("total_kwh_consumed", 6)]
    latest = {tuple(r) for r in energy.latest_ward_energy(written).select(*keep).collect()}
    batch = {tuple(r) for r in energy.ward_energy(typed(spark, "smart_meters")).select(*keep).collect()}
    assert latest == batch
    assert written.count() > len(batch)  # windows that two batches changed are there twice
    sent = values(out, "summary", spark)
    assert len(sent) == written.count()
    assert set(sent[0]) >= {"ward_id", "window_start", "window_end", "total_kwh_consumed", "peak_voltage"}


def meter_stream(spark, path, *batches):
    schema = "ward_id string, kwh_reading double, voltage double, power_factor double, event_time timestamp"
    for rows in batches:
        spark.createDataFrame([("W", kwh, 220.0, 0.9, at(s)) for s, kwh in rows], schema).coalesce(1).write.mode(
            "append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_half_written_batches_are_not_read(spark, tmp_path, monkeypatch):
    archive = str(tmp_path / "archive")
    rows = [("W", 1.0, 220.0, 0.9, at(0))]
    schema = "ward_id string, kwh_reading double, voltage double, power_factor double, event_time timestamp"
    summary = energy.ward_energy(spark.createDataFrame(rows, schema), weights=True)
    sent = []
    write = jobs.dual_sink(lambda messages: sent.append(messages.count()), archive)
    write(summary, 0)

    def lost(path):
        raise RuntimeError("the job is lost here")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "commits_of", lost)
        with pytest.raises(RuntimeError):
            write(summary, 1)
    assert sent == [1, 1] and read_energy_archive(spark, archive).count() == 2
    assert [r.batch_id for r in committed_energy_archive(spark, archive).collect()] == [0]
    jobs.dual_sink(lambda messages: None, archive)(summary, 1)  # the job started anew repeats its batch
    done = committed_energy_archive(spark, archive)
    assert sorted(r.batch_id for r in done.collect()) == [0, 1]
    assert energy.latest_ward_energy(done).count() == 1


def test_late_meter_rows(spark, tmp_path):
    # After the second batch the watermark stands at 2:00 - 45 min, after windows that end by 1:15.
    stream = meter_stream(
        spark, str(tmp_path / "in"), [(10, 1.0), (4000, 1.0)], [(7200, 1.0)], [(7201, 1.0)], [(20, 10.0), (4600, 10.0)])
    batches = collected(energy.ward_energy(stream), checkpointLocation=str(tmp_path / "cp"))
    final = {}
    for batch in batches:
        final.update({r.window_start.replace(tzinfo=timezone.utc): r.total_kwh_consumed for r in batch})
    assert final[at(0)] == 1.0  # ten seconds past midnight is too late to count
    assert final[at(4500)] == 10.0  # the window from 1:15 is still open


def test_days_follow_the_commits_of_the_archive(spark, tmp_path):
    archive, day = str(tmp_path / "archive"), 86_400
    schema = "ward_id string, kwh_reading double, voltage double, power_factor double, event_time timestamp"
    rng, rows = random.Random(1), []
    for i in range(300):
        rows.append((f"W{rng.randrange(3)}", rng.choice([1.0, 2.5]), 220.0 + i % 7, rng.choice([0.5, 0.75, None]), at(rng.randrange(40 * day))))
    early = [row for row in rows if row[-1] < at(35 * day)]
    write, kept = jobs.dual_sink(lambda messages: None, archive), EnergyDays(spark, archive, str(tmp_path / "kept"))

    def windows(part):
        return energy.ward_energy(spark.createDataFrame(part, schema), weights=True)

    def periods(df):
        return sorted(tuple(None if c is None else round(c, 9) if isinstance(c, float) else c for c in r) for r in df.collect())

    def agree(part):
        return all(periods(energy.energy_periods(kept.days(), level)) == periods(energy.energy_rollup(windows(part), level))
                   for level in ("day", "week", "month"))

    def files():
        return {f.name: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "days").glob("date=*/*.parquet")}

    write(windows(early), 0)
    kept.refresh()
    assert agree(early) and len(kept.rebuilt[0]) > 30
    before = files()
    assert kept.refresh().count() > 30 and len(kept.rebuilt) == 1 and files() == before  # nothing new
    changed = windows(rows).join(windows([r for r in rows if r[-1] >= at(35 * day)]).select("ward_id", "window_start"), ["ward_id", "window_start"], "left_semi")
    write(changed, 1)
    kept.refresh()
    assert agree(rows) and len(kept.rebuilt) == 2 and min(kept.rebuilt[1]) >= at(35 * day).date()
    assert before.items() <= files().items()  # the other days' files are as they were
    plan = kept.windows(kept.rebuilt[1])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ IN", plan)
    write(changed, 1)  # a repeated batch changes nothing
    kept.refresh()
    assert agree(rows)
    write(changed.limit(0), 2)  # nor does one without rows
    kept.refresh()
    assert agree(rows)


# --- air quality ---------------------------------------------------------------------------------

def test_advisories_end_like_the_batch(spark, feeds, tmp_path):
    zones, out = views.zone_profile(spark, SF_DIR), Topics(str(tmp_path), "parquet")
    jobs.start_health_advisories(
        read(spark, feeds, "air_quality"), zones, out, "advisories", str(tmp_path / "cp"), NOW).awaitTermination()
    sent = {(v["zone"], v["window_start"]) for v in values(out, "advisories", spark)}
    final = advisory.health_advisories(advisory.rolling_aqi(typed(spark, "air_quality")), zones).collect()
    # Open windows alert too and are not withdrawn, so the stream may have sent more.
    assert {(r.zone, r.window_start.strftime("%Y-%m-%dT%H:%M:%S.000Z")) for r in final} <= sent


def test_streaming_sql_equals_the_dataframe_form(spark, feeds, tmp_path):
    read(spark, feeds, "air_quality").where("aqi IS NOT NULL").withWatermark(
        "event_time", "5 minutes").createOrReplaceTempView("streamed_readings")
    found = {}
    for batch in collected(advisory.rolling_aqi_sql(spark, "streamed_readings"), checkpointLocation=str(tmp_path / "cp")):
        found.update({(r.zone, r.window_start): round(r.rolling_avg_aqi, 6) for r in batch})
    batch = advisory.rolling_aqi(typed(spark, "air_quality")).collect()
    assert found == {(r.zone, r.window_start): round(r.rolling_avg_aqi, 6) for r in batch}


def test_redelivered_readings_are_dropped(spark, feeds, tmp_path):
    again = Topics(str(tmp_path), "parquet")
    source = spark.read.parquet(f"{feeds.location}/air_quality")
    for _ in range(2):
        again.append(source.coalesce(1), "air_quality")
    kept = enrich.dedupe_readings(read(spark, again, "air_quality"), lateness="1 day")
    batches = collected(kept, mode="append", checkpointLocation=str(tmp_path / "cp"))
    assert sum(map(len, batches)) == typed(spark, "air_quality").count()


# --- detectors -----------------------------------------------------------------------------------

def rows_of(df):
    return sorted(tuple(None if c is None else round(c, 4) if isinstance(c, float) else c for c in r) for r in df)


def test_incidents_equal_the_batch(spark, feeds, tmp_path):
    out, checkpoint = Topics(str(tmp_path), "parquet"), str(tmp_path / "cp")
    for _ in range(2):  # started anew from the checkpoint, it repeats nothing
        found = jobs.incidents(*[read(spark, feeds, f) for f in ("air_quality", "traffic_signals", "bus_gps")])
        jobs.start_incidents(found, out, "incidents", checkpoint, NOW).awaitTermination()
    batch = alerts.all_incidents(
        aqi_emergencies(typed(spark, "air_quality")), gridlock(typed(spark, "traffic_signals")),
        bus_bunching(typed(spark, "bus_gps")),
    ).collect()
    sent = values(out, "incidents", spark)
    columns = list(batch[0].asDict())
    assert all(set(v) == set(columns) for v in sent)  # NULL fields are written out
    assert sorted(repr([round(x, 4) if isinstance(x, float) else x for x in map(v.get, columns)]) for v in sent) == sorted(
        repr([round(x, 4) if isinstance(x, float) else x for x in r]) for r in batch)
    assert {v["incident_type"] for v in sent} == {"AQI_EMERGENCY", "TRAFFIC_GRIDLOCK", "BUS_BUNCHING"}
    assert spark.read.parquet(f"{out.location}/incidents").where("key IS NOT NULL").count() == 0


def test_rolling_gridlock_stream(spark, feeds, tmp_path):
    stream = detectors.stream_gridlock(read(spark, feeds, "traffic_signals"), latch=False)
    found = [r for batch in collected(stream, checkpointLocation=str(tmp_path / "cp")) for r in batch]
    assert rows_of(found) == rows_of(gridlock(typed(spark, "traffic_signals"), latch=False).collect())


def test_jobs_by_name(spark, feeds, tmp_path):
    def run(job, *more):
        asked = [job, "--topics", feeds.location, "--format", "parquet", "--out", f"out-{job}", "--checkpoint", str(tmp_path)]
        app.start(spark, app.arguments([*asked, "--once", "--max-per-batch", "1", *more])).awaitTermination()
        return values(feeds, f"out-{job}", spark)

    alerts_sent = run("rolling-gridlock")
    assert len(alerts_sent) == gridlock(typed(spark, "traffic_signals"), latch=False).count() > 0
    assert run("ward-energy", "--archive", str(tmp_path / "archive"))
    assert read_energy_archive(spark, str(tmp_path / "archive")).count() > 0
    with pytest.raises(SystemExit):
        app.arguments(["ward-energy", "--topics", "x", "--out", "y", "--checkpoint", "z"])


def test_schedule_is_held_for_a_while(spark):
    reads = []

    def read_rows():
        reads.append(1)
        return spark.range(len(reads))

    held = jobs.refreshed(read_rows, 3600)
    assert [held().count(), held().count(), len(reads)] == [1, 1, 1]
    always = jobs.refreshed(read_rows, 0)
    assert [always().count(), always().count()] == [2, 3]


def out_of_order(spark, path, schema, rows, last, batches=4, lateness=10):
    """``rows`` (event time in column ``at``), each up to ``lateness`` seconds after its place; ``last`` ends the stream."""
    rng = random.Random(7)
    arrivals = sorted(rows, key=lambda r: r[-2] + timedelta(seconds=rng.uniform(0, lateness - 0.001)))
    assert arrivals != sorted(rows, key=lambda r: (r[-2], r[-1]))
    size = -(-len(rows) // batches)
    for part in [*(arrivals[i:i + size] for i in range(0, len(rows), size)), last]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)  # files are taken by their time
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream.withWatermark("event_time", f"{lateness} seconds")


def dropped_late(query):
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_all(df, checkpoint):
    found = []
    query = df.writeStream.foreachBatch(lambda batch, _: found.extend(batch.collect())).outputMode("update")
    query = query.option("checkpointLocation", checkpoint).trigger(**NOW).start()
    query.awaitTermination()
    return found, query


def test_event_order_makes_the_batch_result_of_late_rows(spark, tmp_path):
    rng = random.Random(3)
    schema = "sensor_id string, zone string, aqi double, sensor_status string, event_time timestamp, event_id long"
    rows = [(f"S{rng.randrange(3)}", "Z", rng.choice([200.0, 400.0, 450.0]), "OK", at(rng.randrange(900)), i)
            for i in range(240)]
    stream = out_of_order(spark, str(tmp_path / "in"), schema, rows, [("end", "Z", 1.0, "OK", at(5000), 9999)])
    found, query = run_all(
        detectors.stream_aqi_emergencies(stream, in_event_order=True), str(tmp_path / "cp"))
    batch = aqi_emergencies(spark.createDataFrame(rows, schema)).collect()
    assert len(batch) > 10 and rows_of(found) == rows_of(batch)
    assert dropped_late(query) == 0


def test_event_order_of_cycles_and_positions(spark, tmp_path):
    rng = random.Random(4)
    schema = "junction_id string, zone string, avg_wait_sec double, event_time timestamp, event_id long"
    rows = [(f"J{rng.randrange(2)}", "Z", rng.choice([100.0, 200.0, 250.0, 300.0]), at(rng.randrange(600)), i)
            for i in range(240)]
    stream = out_of_order(spark, str(tmp_path / "signals"), schema, rows, [("J0", "Z", 1.0, at(5000), 9999)])
    found, _ = run_all(detectors.stream_gridlock(stream, in_event_order=True), str(tmp_path / "cp1"))
    batch = gridlock(spark.createDataFrame(rows, schema)).collect()
    assert len(batch) > 5 and rows_of(found) == rows_of(batch)

    schema = "route_id string, bus_id string, lat double, lon double, event_time timestamp, event_id long"
    rows = [("R", f"B{i % 3}", 12.9 + rng.choice([0.0, 0.0, 0.0, 0.0, 0.001, 0.005]), 77.6, at(4 * i), i) for i in range(400)]
    stream = out_of_order(spark, str(tmp_path / "gps"), schema, rows, [("end", "B", 12.9, 77.6, at(9000), 9999)])
    found, _ = run_all(
        detectors.stream_bus_bunching(stream, hold_ms=30_000, in_event_order=True), str(tmp_path / "cp2"))
    batch = bus_bunching(spark.createDataFrame(rows, schema), hold_ms=30_000).collect()
    assert len(batch) > 5 and rows_of(found) == rows_of(batch)


def test_event_order_drops_what_is_too_late(spark, tmp_path):
    schema = "sensor_id string, zone string, aqi double, sensor_status string, event_time timestamp, event_id long"
    for part in ([(0, 1)], [(1000, 2)], [(1001, 6)], [(5, 3), (995, 4)], [(9000, 5)]):
        spark.createDataFrame([("S", "Z", 400.0, "OK", at(s), i) for s, i in part], schema).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found, query = run_all(
        detectors.stream_aqi_emergencies(stream.withWatermark("event_time", "15 seconds"), in_event_order=True),
        str(tmp_path / "cp"))
    # The reading at 5 s came behind the watermark; the one at 995 s counts before those after it and mutes them.
    assert [r.event_id for r in found] == [1, 4] and dropped_late(query) == 1
    with pytest.raises(ValueError):
        detectors.stream_aqi_emergencies(stream, ttl_ms=1000, in_event_order=True)


def test_late_hazard_is_muted_in_arrival_order(spark, tmp_path):
    schema = "sensor_id string, zone string, aqi double, sensor_status string, event_time timestamp, event_id long"
    for i, second in enumerate((100, 50, 230)):
        spark.createDataFrame([("S", "Z", 400.0, "OK", at(second), i)], schema).write.mode("append").parquet(
            str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = collected(detectors.stream_aqi_emergencies(stream), checkpointLocation=str(tmp_path / "cp"))
    assert [r.event_id for batch in found for r in batch] == [0, 2]


# --- enrichment, dead letters, readers, archive --------------------------------------------------

def test_enrichment_reads_the_schedule_anew(spark, feeds, tmp_path):
    out = Topics(str(tmp_path), "parquet")
    log = views.route_schedule_log(spark, SF_DIR).where("route_id <= 'RT-005'")  # others have no schedule
    body = F.when(F.col("route_name").isNotNull(), F.to_json(F.struct(
        "route_id", "route_name", "terminal", "scheduled_arrival_time")))
    out.append(log.select(
        F.col("route_id").cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.lit("schedule").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.current_timestamp().alias("timestamp")), "schedule")
    jobs.start_enrichment(
        read(spark, feeds, "bus_gps"), lambda: current_route_schedule(spark, out, "schedule"), out, "enriched",
        str(tmp_path / "cp"), NOW).awaitTermination()
    sent = values(out, "enriched", spark)
    assert len(sent) == 1000
    matched = [v for v in sent if v["schedule_match"]]
    assert {v["route_id"] for v in matched} == {"RT-001", "RT-002", "RT-003", "RT-004"}
    assert {v["scheduled_arrival_time"] for v in matched if v["route_id"] == "RT-002"} == {"09:00:00"}
    jobs.start_message_enrichment(
        feeds.stream(spark, "bus_gps"), lambda: current_route_schedule(spark, out, "schedule"), out, "enriched_raw",
        str(tmp_path / "cp2"), NOW).awaitTermination()
    raw = values(out, "enriched_raw", spark)
    assert len(raw) == 990  # ten messages are unreadable
    assert {len(v) for v in raw if not v["schedule_match"]} <= {6, 7, 8}  # no schedule fields
    assert sum(v["schedule_match"] for v in raw) == sum(v["bus_id"] is not None for v in matched)


def test_dead_letters_and_their_report(spark, feeds, tmp_path):
    out, raw = Topics(str(tmp_path), "parquet"), lambda: feeds.stream(spark, *FEEDS)
    jobs.start_dlq_router(raw(), out, "dlq", str(tmp_path / "cp1"), NOW).awaitTermination()
    sent = values(out, "dlq", spark)
    expected = {r.error_reason: r.n for r in validate.dlq_report(
        validate.split(validate.validate_messages(views.all_messages(spark, SF_DIR)))[1]).collect()}
    counts = {}
    for record in sent:
        counts[record["error_reason"]] = counts.get(record["error_reason"], 0) + 1
    assert counts == expected
    assert {v["original_payload"] for v in sent if v["error_reason"] == "MALFORMED_JSON"} == {
        "{bad json", '{"lat": 13.0}{"lon": 77.0}', '{"lat": 13.0} junk}'}

    reports = []
    jobs.start_dlq_report(raw(), lambda df: reports.append(df.collect()), str(tmp_path / "cp2"), NOW).awaitTermination()
    assert {r.error_reason: r.n for r in reports[-1]} == expected
    assert sum(r.pct for r in reports[-1]) == pytest.approx(100.0)

    shares = collected(jobs.dlq_shares(raw()), mode="append", checkpointLocation=str(tmp_path / "cp4"))
    whole = validate.dlq_report(
        validate.split(validate.validate_messages(views.all_messages(spark, SF_DIR).withColumn(
            "timestamp", F.col("event_time").cast("timestamp"))))[1], jobs.REPORT_WINDOW, "timestamp").collect()
    expected_shares = {(r.window_start, r.error_reason): (r.n, r.pct) for r in whole}
    found = {(r.window_start, r.error_reason): (r.n, r.pct) for batch in shares for r in batch}
    assert found and all(expected_shares[k][0] == n and pct == pytest.approx(expected_shares[k][1]) for k, (n, pct) in found.items())

    windows = collected(jobs.dlq_counts(raw()), checkpointLocation=str(tmp_path / "cp3"))
    assert sum(r.n for batch in windows for r in batch) == sum(expected.values())


def test_router_counts_what_it_routes(spark, feeds, tmp_path):
    out, counts = Topics(str(tmp_path), "parquet"), str(tmp_path / "counts")
    stream = feeds.stream(spark, *FEEDS, max_per_batch=5)
    query = jobs.start_dlq_router(stream, out, "dlq", str(tmp_path / "cp"), NOW, counts_path=counts)
    query.awaitTermination()
    assert sum(p.numInputRows for p in query.recentProgress) == feeds.log(spark, *FEEDS).count()
    rejected = validate.split(validate.validate_messages(feeds.log(spark, *FEEDS)))[1]
    by_window = validate.dlq_report(rejected, jobs.REPORT_WINDOW, "timestamp").collect()
    assert len(by_window) > 20 and jobs.routed_report(spark, counts).collect() == by_window
    whole = {r.error_reason: r.n for r in jobs.routed_report(spark, counts, window=False).collect()}
    assert whole == {r.error_reason: r.n for r in validate.dlq_report(rejected).collect()}
    assert len(values(out, "dlq", spark)) == sum(whole.values())
    # The last batch again, as after a failure before its commit: counted once all the same.
    (commit,) = [max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))]
    commit.unlink()
    commit.with_name(f".{commit.name}.crc").unlink()
    jobs.start_dlq_router(stream, out, "dlq", str(tmp_path / "cp"), NOW, counts_path=counts).awaitTermination()
    assert jobs.routed_report(spark, counts).collect() == by_window


def schedule_messages(spark, rows):
    return spark.createDataFrame(
        [(key.encode(), None if name is None else json.dumps({"route_id": key, "route_name": name}).encode(),
          "schedule", 0, offset, at(offset)) for offset, key, name in rows],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp").coalesce(1)


def test_snapshot_follows_its_topic(spark, tmp_path):
    topics = Topics(str(tmp_path), "parquet")
    topics.append(schedule_messages(spark, [(0, "A", "a0"), (1, "B", "b0"), (2, "A", "a1"), (3, "C", "c0")]), "schedule")
    snapshot = UpsertSnapshot(spark, topics, "schedule", str(tmp_path / "snapshot"))

    def now(of=snapshot):
        found = {r.route_id: r.route_name for r in schedule_rows(of.refresh()).collect()}
        whole = current_route_schedule(spark, topics, "schedule").collect()
        assert found == {r.route_id: r.route_name for r in whole}
        return found

    assert now() == {"A": "a1", "B": "b0", "C": "c0"}
    assert now() == {"A": "a1", "B": "b0", "C": "c0"}  # nothing new, nothing read
    topics.append(schedule_messages(spark, [(4, "B", None), (5, "C", "c1"), (6, "D", "d0")]), "schedule")
    assert now() == {"A": "a1", "C": "c1", "D": "d0"}
    assert snapshot.read_rows == [4, 0, 3]
    again = UpsertSnapshot(spark, topics, "schedule", str(tmp_path / "snapshot"))  # a job started anew
    topics.append(schedule_messages(spark, [(7, "B", "b1"), *[(8 + i, k, None) for i, k in enumerate("ACD")]]), "schedule")
    assert now(again) == {"B": "b1"} and again.read_rows == [4]
    topics.append(schedule_messages(spark, [(11, "B", None)]), "schedule")
    assert now(again) == {}


def test_enrichment_job_by_name_keeps_its_schedule(spark, feeds, tmp_path):
    names = {f"RT-00{i}": f"name {i}" for i in range(1, 4)}
    feeds.append(schedule_messages(spark, [(i, key, name) for i, (key, name) in enumerate(names.items())]), "kept")
    asked = ["enrichment", "--topics", feeds.location, "--format", "parquet", "--out", "out-enrichment", "--checkpoint",
             str(tmp_path), "--schedule", "kept", "--refresh-seconds", "0", "--once", "--max-per-batch", "1"]
    app.start(spark, app.arguments(asked)).awaitTermination()
    sent = values(feeds, "out-enrichment", spark)
    assert len(sent) == 1000
    assert {(v["route_id"], v["route_name"]) for v in sent if v["schedule_match"]} == set(names.items())


def test_readers_of_one_topic_are_independent(spark, feeds, tmp_path):
    seen = {"high": 0, "standard": 0}

    def counter(group):
        def handle(batch, _):
            seen[group] += batch.count()
        return handle

    jobs.start_reader(read(spark, feeds, "traffic_signals"), counter("high"), "high", str(tmp_path), NOW).awaitTermination()
    assert seen == {"high": 1000, "standard": 0}
    for group in ("high", "standard"):
        jobs.start_reader(
            read(spark, feeds, "traffic_signals"), counter(group), group, str(tmp_path), NOW).awaitTermination()
    assert seen == {"high": 1000, "standard": 1000}


def test_running_count(spark, feeds, tmp_path):
    batches = collected(
        milestones.processed_count(read(spark, feeds, "traffic_signals")), mode="complete",
        checkpointLocation=str(tmp_path / "cp"))
    assert [(b[0].processed, b[0].milestone) for b in batches][-1] == (1000, 1000)


def test_valid_only_stream_and_archive(spark, feeds, tmp_path):
    path = str(tmp_path / "raw")
    jobs.start_raw_archive(
        read(spark, feeds, "air_quality", valid_only=True), path, str(tmp_path / "cp"), NOW).awaitTermination()
    stored = spark.read.parquet(path)
    assert stored.count() == 940
    assert [str(r.date) for r in stored.select("date").distinct().collect()] == ["2024-01-01"]
