"""Decoding, enrichment, windows, roll-ups, milestones and sources in batch."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.functions.clock import duration_ms, iso_instant, parse_event_time
from kerbside.functions.geo import haversine_m, pair_key
from kerbside.functions.json_codec import decode_json, encode_json
from kerbside.operators.advisory import _rolling_direct, aqi_daily, aqi_quarterly_change, health_advisories, rolling_aqi
from kerbside.operators.energy import archive_rows, compact_archive, energy_rollup, latest_ward_energy, ward_energy
from kerbside.operators.enrich import dedupe_readings, enrich_messages, enrich_positions, latest_by_key
from kerbside.operators.milestones import event_milestones
from kerbside.plans import views
from kerbside.schemas import AIR_QUALITY, BUS_GPS
from kerbside.sources.reference import (
    current_route_schedule, publish_route_schedule, read_energy_archive, read_route_schedule, read_zone_profile)
from kerbside.sources.topics import Topics, as_envelope
from plain_rules import metres_between

SF_DIR = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# --- functions -----------------------------------------------------------------------------------

def test_durations():
    assert [duration_ms(t) for t in ("10 minutes", "1 minute", "45 seconds", "2 hours", "1 day")] == [
        600_000, 60_000, 45_000, 7_200_000, 86_400_000]
    with pytest.raises(ValueError):
        duration_ms("1 month")


@pytest.mark.parametrize("text, expected", [
    ("2024-01-01T00:00:00.123456+00:00", "2024-01-01 00:00:00.123456"),
    ("2024-01-01T05:30:00+05:30", "2024-01-01 00:00:00"),
    ("2024-01-01T00:00:00Z", "2024-01-01 00:00:00"),
    ("not a time", "None"), (None, "None"), ("", "None"),
])
def test_event_time(spark, text, expected):
    assert str(one(spark, parse_event_time(F.lit(text)))) == expected


@pytest.mark.parametrize("ms, expected", [
    (0, "1970-01-01T00:00:00Z"), (1704067200007, "2024-01-01T00:00:00.007Z"),
    (1704067200120, "2024-01-01T00:00:00.120Z"), (1704067201000, "2024-01-01T00:00:01Z"),
])
def test_iso_instant(spark, ms, expected):
    assert one(spark, iso_instant(F.lit(ms))) == expected


def test_distance_and_pair_key(spark):
    points = (12.97, 77.59, 13.01, 77.61)
    found = one(spark, haversine_m(*[F.lit(v) for v in points]))
    assert found == pytest.approx(metres_between(*points), abs=1e-6)
    assert one(spark, pair_key(F.lit("B"), F.lit("A"))) == one(spark, pair_key(F.lit("A"), F.lit("B"))) == "A::B"


# --- JSON ----------------------------------------------------------------------------------------

def test_decode_is_permissive_or_strict(spark):
    raw = spark.createDataFrame(
        [(bytearray(b'{"bus_id": "B", "lat": 1.5, "speed_kmh": "x", "more": 1}'),), (bytearray(b"{bad"),), (None,)],
        "value binary",
    )
    rows = decode_json(raw, BUS_GPS).collect()
    assert [(r.bus_id, r.lat, r.speed_kmh, r.event_time) for r in rows] == [("B", 1.5, None, None), (None,) * 4]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode_json(raw, BUS_GPS, mode="FAILFAST").collect()


def test_encode_leaves_or_keeps_nulls(spark):
    rows = spark.createDataFrame([("Z", None, 2)], "zone string, name string, n int")
    short, full = encode_json(rows, "zone").first(), encode_json(rows, None, keep_nulls=True).first()
    assert (short.key, short.value) == ("Z", '{"zone":"Z","n":2}')
    assert (full.key, full.value) == (None, '{"zone":"Z","name":null,"n":2}')


# --- enrichment ----------------------------------------------------------------------------------

def test_latest_by_key(spark):
    log = spark.createDataFrame(
        [("a", "1", 1), ("a", "2", 5), ("b", "1", 2), ("b", None, 3), ("c", None, 1), ("c", "9", 4)],
        "key string, value string, offset long",
    )
    found = latest_by_key(log.repartition(3), deleted="value")
    assert sorted((r.key, r.value) for r in found.collect()) == [("a", "2"), ("c", "9")]


def test_enrichment_keeps_unmatched_and_keyless_positions(spark):
    gps = spark.createDataFrame([("R1", 1), ("R9", 2), (None, 3)], "route_id string, n int")
    schedule = spark.createDataFrame(
        [("R1", "East", "Depot", "08:00:00")],
        "route_id string, route_name string, terminal string, scheduled_arrival_time string")
    found = {r.n: (r.schedule_match, r.route_name) for r in enrich_positions(gps, schedule).collect()}
    assert found == {1: (True, "East"), 2: (False, None), 3: (False, None)}


def test_message_enrichment_passes_unknown_fields(spark):
    texts = ['{"route_id":"R1","extra":{"a":[1,2]},"lat":null}', '{"route_id":"R9","schedule_match":"old"}', "{bad", "[1]"]
    raw = spark.createDataFrame([(b"k", t.encode()) for t in texts], "key binary, value binary")
    schedule = spark.createDataFrame(
        [("R1", "East", None, "08:00:00")],
        "route_id string, route_name string, terminal string, scheduled_arrival_time string")
    found = {json.loads(r.value)["route_id"]: json.loads(r.value) for r in enrich_messages(raw, schedule).collect()}
    assert found == {
        "R1": {"route_id": "R1", "extra": {"a": [1, 2]}, "lat": None, "scheduled_arrival_time": "08:00:00",
               "route_name": "East", "terminal": None, "schedule_match": True},
        "R9": {"route_id": "R9", "schedule_match": False},
    }


def test_schedule_topic_round_trip(spark, tmp_path):
    csv = tmp_path / "schedule.csv"
    csv.write_text("route_id,route_name,terminal,scheduled_arrival_time\nR1,East,Depot,08:00:00\nR2,West,Gate,09:05:00\n")
    assert [r.scheduled_arrival_time for r in read_route_schedule(spark, str(csv)).collect()] == ["08:00:00", "09:05:00"]
    topics = Topics(str(tmp_path / "topics"), "parquet")
    publish_route_schedule(spark, str(csv), topics, "published")
    log = as_envelope(spark.read.parquet(str(tmp_path / "topics" / "published")), "schedule").coalesce(1)
    topics.append(log, "schedule")
    later = spark.createDataFrame([("R2", None, 10**12)], "key string, value string, offset long").select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("schedule").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.current_timestamp().alias("timestamp"))
    topics.append(later, "schedule")
    assert [tuple(r) for r in current_route_schedule(spark, topics, "schedule").collect()] == [
        ("R1", "East", "Depot", "08:00:00")]


def test_zone_profile_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("zone,zone_name,population,num_schools\nZONE-01,North,1000,3\n")
    assert tuple(read_zone_profile(spark, str(path)).first()) == ("ZONE-01", "North", 1000, 3)


def test_dedupe_keeps_the_first(spark):
    rows = spark.createDataFrame(
        [("S", "2024-01-01 00:00:00", 2.0, 7), ("S", "2024-01-01 00:00:00", 1.0, 3), ("S", "2024-01-01 00:00:01", 5.0, 8)],
        "sensor_id string, t string, aqi double, event_id long",
    ).withColumn("event_time", F.col("t").cast("timestamp")).drop("t")
    assert sorted((r.event_id, r.aqi) for r in dedupe_readings(rows).collect()) == [(3, 1.0), (8, 5.0)]


# --- windows and roll-ups ------------------------------------------------------------------------

@pytest.mark.parametrize("window, slide", [("10 minutes", "1 minute"), ("15 minutes", "5 minutes"), ("1 minute", "1 minute")])
def test_rolling_average_equals_the_direct_form(spark, window, slide):
    readings = views.feed(spark, SF_DIR, "air_quality")
    present = readings.where("aqi IS NOT NULL")

    def rows(df):
        return sorted((r.zone, r.window_start, r.window_end, round(r.rolling_avg_aqi, 6)) for r in df.collect())

    assert rows(rolling_aqi(readings, window, slide)) == rows(_rolling_direct(present, window, slide))


def test_rolling_average_of_uneven_steps(spark):
    readings = views.feed(spark, SF_DIR, "air_quality")
    assert rolling_aqi(readings, "10 minutes", "3 minutes").count() > 0


def test_advisory_threshold_is_exclusive(spark):
    rolling = spark.createDataFrame([("Z", 150.0), ("Z", 150.1), ("Y", 400.0)], "zone string, rolling_avg_aqi double")
    rolling = rolling.withColumns({c: F.current_timestamp() for c in ("window_start", "window_end")})
    zones = spark.createDataFrame([("Z", "North", 10, 1)], "zone string, zone_name string, population int, num_schools int")
    assert [r.rolling_avg_aqi for r in health_advisories(rolling, zones).collect()] == [150.1]


def test_rollup_weights_power_factors(spark):
    meters = spark.createDataFrame(
        [("W", 1.0, 200.0, 0.5, "2024-01-01 00:01:00"), ("W", 2.0, 210.0, None, "2024-01-01 00:02:00"),
         ("W", 3.0, 190.0, 0.9, "2024-01-01 00:20:00"), ("W", 4.0, 220.0, 0.9, "2024-01-01 00:21:00"),
         ("W", None, 999.0, 0.1, "2024-01-01 00:22:00"), ("V", 1.0, 200.0, None, "2024-01-02 00:00:00")],
        "ward_id string, kwh_reading double, voltage double, power_factor double, t string",
    ).withColumn("event_time", F.col("t").cast("timestamp"))
    summary = ward_energy(meters, weights=True)
    assert summary.count() == 3
    found = {r.ward_id: r for r in energy_rollup(summary, "day").collect()}
    assert (found["W"].total_kwh_consumed, found["W"].peak_voltage, found["W"].reading_count) == (10.0, 220.0, 4)
    assert found["W"].avg_power_factor == pytest.approx((0.5 + 0.9 + 0.9) / 3)
    assert found["V"].avg_power_factor is None


def test_archive_versions_and_compaction(spark, tmp_path):
    columns = "ward_id string, window_start timestamp, total_kwh_consumed double"
    start = "2024-01-01 00:00:00"

    def batch(total, number):
        rows = spark.createDataFrame([("W", total)], "ward_id string, total_kwh_consumed double").select(
            "ward_id", F.lit(start).cast("timestamp").alias("window_start"), "total_kwh_consumed")
        return archive_rows(rows, number)

    path = str(tmp_path / "archive")
    for total, number in ((1.0, 0), (5.0, 2), (5.0, 2), (3.0, 1)):
        batch(total, number).write.mode("append").partitionBy("ward_id", "date").parquet(path)
    archive = read_energy_archive(spark, path)
    assert archive.count() == 4
    assert [r.total_kwh_consumed for r in latest_ward_energy(archive).collect()] == [5.0]
    compact_archive(archive, str(tmp_path / "compact"))
    compacted = read_energy_archive(spark, str(tmp_path / "compact"))
    assert compacted.count() == 1
    plan = compacted.where("ward_id = 'W'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ward_id" in plan


def test_archive_of_a_new_checkpoint_and_its_own_path(spark, tmp_path):
    rows = spark.createDataFrame(
        [("W", datetime(2024, 1, 1), 1.0)], "ward_id string, window_start timestamp, total_kwh_consumed double")
    path = str(tmp_path / "archive")
    for total, number, day in ((1.0, 7, 1), (2.0, 0, 2)):
        batch = rows.withColumn("total_kwh_consumed", F.lit(total))
        archive_rows(batch, number, datetime(2024, 2, day)).write.mode("append").partitionBy("ward_id", "date").parquet(path)
    archive = read_energy_archive(spark, path)
    assert [r.total_kwh_consumed for r in latest_ward_energy(archive).collect()] == [2.0]
    with pytest.raises(ValueError):
        compact_archive(archive, path)
    assert read_energy_archive(spark, path).count() == 2


def test_dedupe_keeps_readings_without_time(spark):
    rows = spark.createDataFrame([("S1", None, 1.0, 1), ("S1", None, 2.0, 2)], "sensor_id string, event_time timestamp, aqi double, event_id long")
    assert sorted(r.event_id for r in dedupe_readings(rows).collect()) == [1, 2]


def test_dedupe_plan_counts_hashes(spark):
    rows = spark.range(1000).selectExpr(
        "cast(id % 900 as string) AS sensor_id", "timestamp_millis(id % 900) AS event_time", "id AS event_id", "id * 1.0 AS aqi")
    found = dedupe_readings(rows)
    assert sorted(r.event_id for r in found.collect()) == list(range(900))
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_quarterly_median_within_its_error(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('Z', id % 3) AS zone", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 364) AS event_time",
        "cast((id * 7919) % 5003 AS double) AS aqi")
    rows = rows.unionByName(rows.limit(1).withColumn("aqi", F.lit(None).cast("double")))
    got = {(r.zone, r.quarter_start): r for r in aqi_quarterly_change(aqi_daily(rows)).collect()}
    values = {}
    for r in rows.where("aqi IS NOT NULL").collect():
        start = r.event_time.date().replace(month=(r.event_time.month - 1) // 3 * 3 + 1, day=1)
        values.setdefault((r.zone, start), []).append(r.aqi)
    assert set(got) == set(values) and len(got) == 12
    for key, held in values.items():
        rank = sum(v <= got[key].median_aqi for v in held) / len(held)
        assert abs(rank - 0.5) < 0.02 and got[key].reading_count == len(held)
        assert (got[key].change is None) == (key[1].month == 1)


# --- milestones ----------------------------------------------------------------------------------

@pytest.mark.parametrize("bucket_rows", [10, 150, 4_000_000])
def test_milestones(spark, bucket_rows):
    rng = random.Random(bucket_rows)
    # A third of the events carry one and the same time.
    rows = [(i, 1_704_067_200_000 + (0 if rng.random() < 0.33 else rng.randrange(900_000_000))) for i in range(3_000)]
    expected = [(n, ms, i) for n, (ms, i) in enumerate(sorted((ms, i) for i, ms in rows), 1) if n % 50 == 0]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id long, ms long").select("event_id", F.timestamp_millis("ms").alias("event_time"))
    found = event_milestones(df, 50, bucket_rows=bucket_rows).collect()
    assert sorted((r.processed, r.ms, r.event_id) for r in found) == expected


# --- row order and partitions do not matter ------------------------------------------------------

@pytest.mark.parametrize("name", ["aqi_emergency", "gridlock_rolling", "bus_bunching", "dlq_report_5m", "dedupe_readings"])
def test_input_order_does_not_matter(spark, monkeypatch, name):
    from kerbside.plans import catalog

    def result():
        return sorted(map(repr, catalog.queries()[name](spark, SF_DIR).collect()))

    before, table = result(), views.table
    monkeypatch.setattr(views, "table", lambda *args: table(*args).orderBy(F.rand(7)).repartition(5, F.rand(3)))
    assert result() == before


# --- Kafka options -------------------------------------------------------------------------------

def test_kafka_options():
    topics = Topics("b1:9092,b2:9092", options={"kafka.security.protocol": "SSL"})
    assert topics.read_options(["a", "b"], True, max_per_batch=500) == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "a,b", "startingOffsets": "latest",
        "failOnDataLoss": "false", "kafka.security.protocol": "SSL", "maxOffsetsPerTrigger": "500"}
    assert topics.read_options(["a"], False)["startingOffsets"] == "earliest"
    assert topics.write_options("out") == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "topic": "out", "kafka.security.protocol": "SSL"}


def test_feed_messages_decode_to_the_feed(spark):
    decoded = decode_json(views.messages(spark, SF_DIR, "air_quality"), AIR_QUALITY, keep=("offset",))
    typed = views.feed(spark, SF_DIR, "air_quality")
    a = sorted((r.offset, r.sensor_id, r.aqi, r.pm10) for r in decoded.collect())
    b = sorted((r.event_id, r.sensor_id, r.aqi, r.pm10) for r in typed.collect())
    assert list(map(repr, a)) == list(map(repr, b))
    assert json.loads(views.messages(spark, SF_DIR, "air_quality").first().value)["zone"].startswith("ZONE-")
