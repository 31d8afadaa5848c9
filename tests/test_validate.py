"""Validation rules, dead-letter records and reports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from kerbside.operators import validate
from kerbside.operators.validate import dlq_messages, dlq_records, dlq_report, split, validate_messages

NAN = float("nan")
GPS = {"bus_id": "B", "route_id": "R", "lat": 13.0, "lon": 77.0, "speed_kmh": 30.0}
SIGNAL = {"junction_id": "J", "avg_wait_sec": 10.0, "vehicle_count": 3}
AQI = {"sensor_id": "S", "aqi": 100.0}
METER = {"meter_id": "M", "kwh_reading": 1.0, "voltage": 220.0}


def gps(**changed):
    return "bus_gps", json.dumps({**GPS, **changed})


def signal(**changed):
    return "traffic_signals", json.dumps({**SIGNAL, **changed})


def aqi(**changed):
    return "air_quality", json.dumps({**AQI, **changed})


def meter(**changed):
    return "smart_meters", json.dumps({**METER, **changed})


CASES = [
    (gps(), None),
    (gps(lat=12.0, lon=76.5), None), (gps(lat=14.0, lon=78.5), None),
    (gps(lat=11.999), "IMPOSSIBLE_GPS_COORDINATE"), (gps(lon=78.501), "IMPOSSIBLE_GPS_COORDINATE"),
    (gps(lat=None), "NULL_GPS_COORDINATE"), (gps(lon=None, speed_kmh=-1), "NULL_GPS_COORDINATE"),
    (gps(speed_kmh=0), None), (gps(speed_kmh=120), None),
    (gps(speed_kmh=-0.1), "INVALID_SPEED"), (gps(speed_kmh=120.1), "INVALID_SPEED"),
    (gps(speed_kmh=None), "INVALID_SPEED"), (gps(speed_kmh="fast"), "INVALID_SPEED"),
    (("bus_gps", '{"bus_id": "B"}'), "NULL_GPS_COORDINATE"),
    (signal(), None), (signal(avg_wait_sec=0), None),
    (signal(avg_wait_sec=-1), "NEGATIVE_WAIT_TIME"), (signal(avg_wait_sec=None), "NULL_SIGNAL_METRIC"),
    (signal(vehicle_count=None, avg_wait_sec=-1), "NULL_SIGNAL_METRIC"),
    (aqi(aqi=0), None), (aqi(aqi=500), None), (aqi(aqi=500.1), "OUT_OF_RANGE_AQI"),
    (aqi(aqi=-1), "OUT_OF_RANGE_AQI"), (aqi(aqi=None), "NULL_AQI_VALUE"),
    (meter(voltage=150), None), (meter(voltage=280), None), (meter(voltage=149.9), "OUT_OF_RANGE_VOLTAGE"),
    (meter(voltage=280.1), "OUT_OF_RANGE_VOLTAGE"), (meter(kwh_reading=None), "NULL_METER_READING"),
    (meter(voltage=None), "NULL_METER_READING"),
    (("bus_gps", "{bad json"), "MALFORMED_JSON"), (("air_quality", '[{"aqi": 1}]'), "MALFORMED_JSON"),
    (("air_quality", "12"), "MALFORMED_JSON"), (("air_quality", ""), "MALFORMED_JSON"),
    (("air_quality", '{"aqi": 1} and more'), "MALFORMED_JSON"), (("air_quality", '{"aqi": 1, "x": {"y"}}'), "MALFORMED_JSON"),
    (("air_quality", '\n{"aqi": 1}\r\n'), None),
    (("air_quality", None), "MALFORMED_JSON"), (("smart_meters", "null"), "MALFORMED_JSON"),
    (("city.air_quality", '  {"aqi": 501}'), "OUT_OF_RANGE_AQI"),
    (("elsewhere", "{}"), None),
]


def message_table(spark):
    rows = [(i, f"k{i}".encode(), None if text is None else text.encode(), topic)
            for i, ((topic, text), _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "id int, key binary, value binary, topic string")


@pytest.fixture(scope="module")
def reasons(spark):
    return {r.id: r.error_reason for r in validate_messages(message_table(spark)).collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_reason(reasons, number):
    assert reasons[number] == CASES[number][1]


@pytest.mark.parametrize("text, reason", [
    ('{"aqi": 10} junk}', "MALFORMED_JSON"),
    ('{"aqi": 10}{"b":1}', "MALFORMED_JSON"),
    ("{'aqi': 10}", "MALFORMED_JSON"),
    ('{"aqi": 10},{"aqi": 11}', "MALFORMED_JSON"),
    ('{"aqi": 10}] junk', "MALFORMED_JSON"),
    ('{"aqi": 10},{}] junk', "MALFORMED_JSON"),
    ('{"aqi": 10,}', "MALFORMED_JSON"),
    ("[1]", "MALFORMED_JSON"), ("5", "MALFORMED_JSON"), ("", "MALFORMED_JSON"), ("null", "MALFORMED_JSON"),
    ('{"aqi": NaN}', "OUT_OF_RANGE_AQI"),
    ("{}", "NULL_AQI_VALUE"), ('{"aqi": "x"}', "NULL_AQI_VALUE"),
    (' {"aqi": 10, "zone": "a]}"}\n', None),
])
def test_one_object_is_well_formed(spark, text, reason):
    row = spark.createDataFrame([(b"", text.encode(), "air_quality")], "key binary, value binary, topic string")
    found = validate_messages(row)
    assert found.first().error_reason == reason
    record = dlq_messages(dlq_records(found)).first()
    assert record.key is None and json.loads(record.value)["original_payload"] is not None or text == "null"


def test_nan_follows_python_comparisons(spark):
    rows = spark.createDataFrame([(13.0, 77.0, NAN), (NAN, 77.0, 1.0)], "lat double, lon double, speed_kmh double")
    found = [r.error_reason for r in validate.validate(rows, "bus_gps").collect()]
    assert found == [None, "IMPOSSIBLE_GPS_COORDINATE"]


def test_split_loses_nothing(spark):
    valid, rejected = split(validate_messages(message_table(spark)))
    assert valid.count() == sum(reason is None for _, reason in CASES)
    assert valid.count() + rejected.count() == len(CASES)


def test_dead_letter_messages(spark):
    _, rejected = split(validate_messages(message_table(spark)))
    sent = {r.key: json.loads(r.value) for r in dlq_messages(dlq_records(rejected)).collect()}
    number = next(i for i, (case, _) in enumerate(CASES) if case == gps(speed_kmh=-0.1))
    assert sent[f"k{number}"]["original_payload"] == {**GPS, "speed_kmh": -0.1}
    assert sent[f"k{number}"]["error_reason"] == "INVALID_SPEED"
    assert sent[f"k{number}"]["source_topic"] == "bus_gps"
    broken = next(i for i, (case, _) in enumerate(CASES) if case[1] == "{bad json")
    assert sent[f"k{broken}"]["original_payload"] == "{bad json"
    assert "quarantined_at" in sent[f"k{broken}"]


def test_report(spark):
    rejected = spark.createDataFrame(
        [("A",), ("B",), ("B",), ("C",)], "error_reason string"
    ).withColumn("quarantined_at", F.lit("2024-01-01 00:07:00").cast("timestamp"))
    assert [tuple(r) for r in dlq_report(rejected).collect()] == [("B", 2, 50.0), ("A", 1, 25.0), ("C", 1, 25.0)]
    windowed = dlq_report(rejected, "5 minutes").collect()
    assert [(str(r.window_start), r.error_reason, r.n) for r in windowed] == [
        ("2024-01-01 00:05:00", "B", 2), ("2024-01-01 00:05:00", "A", 1), ("2024-01-01 00:05:00", "C", 1)]


def test_messages_are_parsed_once(spark):
    plan = split(validate_messages(message_table(spark)))[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
