"""DuckDB SQL that computes the registered queries independently, from the same tables."""

from __future__ import annotations

_BASE = """
WITH base AS (
  SELECT event_id AS id, user_id AS u, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60 AS et
  FROM events
), timed AS (
  SELECT *, et // 1200000000 AS slot, u // 8 AS u8,
         TIMESTAMP '2024-01-01' + to_microseconds(et) AS event_time,
         epoch_us(TIMESTAMP '2024-01-01') // 1000 + et // 1000 AS ms
  FROM base
)"""

_BUS_GPS = """, bus_gps AS (
  SELECT 'RT-' || lpad(CAST(u % 8 + 1 AS VARCHAR), 3, '0') AS route_id,
         'RT-' || lpad(CAST(u % 8 + 1 AS VARCHAR), 3, '0') || '-BUS-'
           || lpad(CAST(u8 % 3 AS VARCHAR), 3, '0') AS bus_id,
         CASE WHEN id % 53 = 0 THEN NULL WHEN id % 59 = 0 THEN 0.0::DOUBLE
              ELSE 12.9::DOUBLE + 0.01::DOUBLE * (u % 8)
                   + (u8 % 3) * (CASE WHEN (slot + u % 8) % 3 = 0 THEN 0.0005::DOUBLE ELSE 0.01::DOUBLE END)
                   + k * 0.000001::DOUBLE END AS lat,
         77.6::DOUBLE + k * 0.000001::DOUBLE AS lon,
         CASE WHEN id % 61 = 0 THEN (-5.0)::DOUBLE WHEN id % 67 = 0 THEN NULL
              ELSE k * 0.6::DOUBLE END AS speed_kmh,
         k AS occupancy_pct, event_time, id AS event_id, ms
  FROM timed
)"""

_AIR_QUALITY = """, air_quality AS (
  SELECT 'AQS-' || lpad(CAST(u % 60 + 1 AS VARCHAR), 3, '0') AS sensor_id,
         'ZONE-' || lpad(CAST(u % 30 + 1 AS VARCHAR), 2, '0') AS zone,
         CASE WHEN id % 20 = 0 THEN NULL ELSE value END AS pm25,
         CASE WHEN id % 20 = 0 THEN NULL ELSE value * 1.2::DOUBLE END AS pm10,
         CASE WHEN id % 20 = 0 THEN NULL ELSE k::DOUBLE END AS no2,
         CASE WHEN id % 20 = 0 THEN NULL WHEN id % 97 = 0 THEN 600.0::DOUBLE
              WHEN (slot + u % 10) % 2 = 0 THEN k * 5.0::DOUBLE ELSE k * 2.0::DOUBLE END AS aqi,
         CASE WHEN id % 20 = 0 THEN 'TIMEOUT' ELSE 'OK' END AS sensor_status,
         event_time, id AS event_id, ms
  FROM timed
)"""

_TRAFFIC_SIGNALS = """, traffic_signals AS (
  SELECT 'JN-' || lpad(CAST(u % 20 + 1 AS VARCHAR), 4, '0') AS junction_id,
         'ZONE-' || lpad(CAST(u % 10 + 1 AS VARCHAR), 2, '0') AS zone,
         CASE WHEN id % 47 = 0 THEN NULL ELSE k END AS vehicle_count,
         CASE WHEN id % 41 = 0 THEN NULL WHEN id % 43 = 0 THEN (-1.0)::DOUBLE
              ELSE k * 3.0::DOUBLE END AS avg_wait_sec,
         CASE k % 3 WHEN 0 THEN 'GREEN' WHEN 1 THEN 'AMBER' ELSE 'RED' END AS signal_phase,
         event_time, id AS event_id, ms
  FROM timed
)"""

_SMART_METERS = """, smart_meters AS (
  SELECT 'MTR-' || lpad(CAST(u AS VARCHAR), 6, '0') AS meter_id,
         'WARD-' || lpad(CAST(u % 15 + 1 AS VARCHAR), 3, '0') AS ward_id,
         CASE WHEN id % 31 = 0 THEN NULL ELSE value END AS kwh_reading,
         CASE WHEN id % 71 = 0 THEN NULL ELSE (145 + (id * 37) % 140)::DOUBLE END AS voltage,
         CASE WHEN id % 37 = 0 THEN NULL ELSE 0.80::DOUBLE + (k % 20) * 0.01::DOUBLE END AS power_factor,
         event_time, id AS event_id, ms
  FROM timed
)"""

_SCHEDULE = """, schedule_log AS (
  SELECT 'RT-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS route_id, n_name AS route_name,
         'T-' || n_name AS terminal,
         strftime(TIMESTAMP '2024-01-01 08:00:00' + to_minutes(CAST(5 * n_nationkey AS INTEGER)), '%H:%M:%S') AS scheduled_arrival_time,
         n_nationkey AS pos
  FROM nation
  UNION ALL
  SELECT 'RT-002', n_name, 'T-' || n_name, '09:00:00', 100 FROM nation WHERE n_nationkey = 1
  UNION ALL
  SELECT 'RT-005', NULL, NULL, NULL, 101 FROM nation WHERE n_nationkey = 4
), schedule AS (
  SELECT route_id, route_name, terminal, scheduled_arrival_time
  FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY pos DESC) AS rn FROM schedule_log)
  WHERE rn = 1 AND route_name IS NOT NULL
)"""

_ZONES = """, zone_profile AS (
  SELECT 'ZONE-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS zone, n_name AS zone_name,
         CAST(100000 + 10000 * n_nationkey AS INTEGER) AS population,
         CAST(20 + n_nationkey AS INTEGER) AS num_schools
  FROM nation
)"""

# Fault codes, tested in this order.
_REASONS = {
    "bus_gps": """CASE WHEN lat IS NULL OR lon IS NULL THEN 'NULL_GPS_COORDINATE'
        WHEN NOT (lat >= 12 AND lat <= 14) OR NOT (lon >= 76.5 AND lon <= 78.5) THEN 'IMPOSSIBLE_GPS_COORDINATE'
        WHEN speed_kmh IS NULL OR speed_kmh < 0 OR speed_kmh > 120 THEN 'INVALID_SPEED' END""",
    "traffic_signals": """CASE WHEN avg_wait_sec IS NULL OR vehicle_count IS NULL THEN 'NULL_SIGNAL_METRIC'
        WHEN avg_wait_sec < 0 THEN 'NEGATIVE_WAIT_TIME' END""",
    "air_quality": """CASE WHEN aqi IS NULL THEN 'NULL_AQI_VALUE'
        WHEN NOT (aqi >= 0 AND aqi <= 500) THEN 'OUT_OF_RANGE_AQI' END""",
    "smart_meters": """CASE WHEN kwh_reading IS NULL OR voltage IS NULL THEN 'NULL_METER_READING'
        WHEN NOT (voltage >= 150 AND voltage <= 280) THEN 'OUT_OF_RANGE_VOLTAGE' END""",
}
_FEED_SQL = {
    "bus_gps": _BUS_GPS,
    "traffic_signals": _TRAFFIC_SIGNALS,
    "air_quality": _AIR_QUALITY,
    "smart_meters": _SMART_METERS,
}
_FEED_KEY = {
    "bus_gps": "route_id",
    "traffic_signals": "junction_id",
    "air_quality": "sensor_id",
    "smart_meters": "meter_id",
}
_FEED_FIELDS = {
    "bus_gps": ["bus_id", "route_id", "lat", "lon", "speed_kmh", "occupancy_pct"],
    "traffic_signals": ["junction_id", "zone", "vehicle_count", "avg_wait_sec", "signal_phase"],
    "air_quality": ["sensor_id", "zone", "pm25", "pm10", "no2", "aqi", "sensor_status"],
    "smart_meters": ["meter_id", "ward_id", "kwh_reading", "voltage", "power_factor"],
}
_QUOTED = {"bus_id", "route_id", "junction_id", "zone", "signal_phase", "sensor_id", "sensor_status",
           "meter_id", "ward_id"}

_ISO_INSTANT = """strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') END || 'Z'"""


def _json_text(feed: str) -> str:
    """JSON object text without NULL fields."""
    parts = []
    for name in _FEED_FIELDS[feed]:
        value = f"'\"' || {name} || '\"'" if name in _QUOTED else f"CAST({name} AS VARCHAR)"
        parts.append(f"'\"{name}\":' || {value}")
    parts.append("""'"timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"'""")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _rejected() -> str:
    branches = []
    for feed in _FEED_SQL:
        reason, text = _REASONS[feed], _json_text(feed)
        if feed == "bus_gps":
            reason = f"CASE WHEN event_id % 101 = 0 THEN 'MALFORMED_JSON' ELSE {reason} END"
            text = f"CASE WHEN event_id % 101 = 0 THEN CASE WHEN event_id % 2 = 0 THEN '{{bad json'"
            text += f""" WHEN event_id % 3 = 0 THEN '{{"lat": 13.0}}{{"lon": 77.0}}' ELSE '{{"lat": 13.0}} junk}}' END"""
            text += f" ELSE {_json_text(feed)} END"
        branches.append(
            f"SELECT '{feed}' AS source_topic, {reason} AS error_reason, {_FEED_KEY[feed]} AS original_key,"
            f" {text} AS original_payload, event_time FROM {feed}"
        )
    union = " UNION ALL ".join(branches)
    return _BASE + "".join(_FEED_SQL.values()) + f""", rejected AS (
      SELECT * FROM ({union}) WHERE error_reason IS NOT NULL
    )"""


_ENERGY = _BASE + _SMART_METERS + """, usable AS (
  SELECT *, time_bucket(INTERVAL 15 MINUTE, event_time) AS window_start FROM smart_meters
  WHERE kwh_reading IS NOT NULL AND voltage IS NOT NULL
)"""


def _year(sql: str) -> str:
    """The same views with the 30 days stretched to a year."""
    return sql.replace("// 60 AS et", "* 12 AS et")


def _rollup(level: str) -> str:
    return _year(_ENERGY) + f"""
    SELECT ward_id, CAST(date_trunc('{level}', window_start) AS DATE) AS period_start,
           round(sum(kwh_reading), 4) AS total_kwh_consumed, round(avg(power_factor) + 1e-9::DOUBLE, 6) AS avg_power_factor,
           max(voltage) AS peak_voltage, count(*) AS reading_count
    FROM usable GROUP BY 1, 2"""


_ROLLING = _BASE + _AIR_QUALITY + """, stepped AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(CAST(back AS INTEGER)) AS window_start, zone, aqi
  FROM air_quality, unnest(generate_series(0, 9)) AS s(back)
  WHERE aqi IS NOT NULL
), rolling AS (
  SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, zone, avg(aqi) AS rolling_avg_aqi
  FROM stepped GROUP BY ALL
)"""
_ROLLING_RESULT = """
SELECT window_start, window_end, zone, round(rolling_avg_aqi + 1e-9::DOUBLE, 6) AS rolling_avg_aqi FROM rolling"""

# Each hazard leads to the first one at least two minutes later, starting at a sensor's first.
_EMERGENCY = _AIR_QUALITY + """, hazards AS (
  SELECT sensor_id, zone, aqi, ms, event_id,
         row_number() OVER (PARTITION BY sensor_id ORDER BY ms, event_id) AS rn
  FROM air_quality WHERE aqi > 300 AND sensor_status IS DISTINCT FROM 'TIMEOUT'
), stepped_hazards AS (
  SELECT h.sensor_id, h.rn, min(n.rn) AS next_rn
  FROM hazards h LEFT JOIN hazards n ON n.sensor_id = h.sensor_id AND n.ms >= h.ms + 120000
  GROUP BY 1, 2
), fired(sensor_id, rn) AS (
  SELECT DISTINCT sensor_id, CAST(1 AS BIGINT) FROM hazards
  UNION ALL
  SELECT s.sensor_id, s.next_rn FROM fired f
  JOIN stepped_hazards s ON s.sensor_id = f.sensor_id AND s.rn = f.rn
  WHERE s.next_rn IS NOT NULL
), emergencies AS (
  SELECT h.sensor_id, h.zone, h.aqi, h.ms, h.event_id FROM hazards h JOIN fired USING (sensor_id, rn)
)"""

_CYCLES = _TRAFFIC_SIGNALS + """, cycles AS (
  SELECT *, avg_wait_sec > 180 AS breach,
         sum(CASE WHEN avg_wait_sec > 180 THEN 0 ELSE 1 END)
           OVER (PARTITION BY junction_id ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS island
  FROM traffic_signals WHERE avg_wait_sec IS NOT NULL
), streaks AS (
  SELECT *, row_number() OVER w AS nth, avg(avg_wait_sec) OVER (w ROWS UNBOUNDED PRECEDING) AS avg_wait
  FROM cycles WHERE breach WINDOW w AS (PARTITION BY junction_id, island ORDER BY ms, event_id)
), latched AS (
  SELECT junction_id, zone, avg_wait, ms, event_id FROM streaks WHERE nth = 3
)"""

_HAVERSINE = """2 * 6371000.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))"""

# Every position against the last known one of each other bus of the route.
_COMPARED = _BUS_GPS + """, positions AS (
  SELECT route_id, bus_id, lat, lon, ms, event_id FROM bus_gps WHERE lat IS NOT NULL AND lon IS NOT NULL
), buses AS (
  SELECT DISTINCT route_id, bus_id FROM positions
), pair_rows AS (
  SELECT p.*, b.bus_id AS other_bus, least(p.bus_id, b.bus_id) AS a, greatest(p.bus_id, b.bus_id) AS z
  FROM positions p JOIN buses b ON b.route_id = p.route_id AND b.bus_id <> p.bus_id
), known AS (
  SELECT *,
         last_value(CASE WHEN bus_id = a THEN {'ms': ms, 'lat': lat, 'lon': lon} END IGNORE NULLS) OVER w AS pos_a,
         last_value(CASE WHEN bus_id = z THEN {'ms': ms, 'lat': lat, 'lon': lon} END IGNORE NULLS) OVER w AS pos_z
  FROM pair_rows WINDOW w AS (PARTITION BY route_id, a, z ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING)
), fresh AS (
  SELECT *, CASE WHEN bus_id = a THEN pos_z ELSE pos_a END AS o FROM known
), distances AS (
  SELECT *, sin(radians(o.lat - lat) / 2) ** 2
            + cos(radians(lat)) * cos(radians(o.lat)) * sin(radians(o.lon - lon) / 2) ** 2 AS h
  FROM fresh WHERE o IS NOT NULL AND ms - o.ms <= 180000
), compared AS (
  SELECT route_id, bus_id, other_bus, a, z, ms, event_id, """ + _HAVERSINE + """ AS distance FROM distances
)"""

_BUNCHED = _COMPARED + """, islands AS (
  SELECT *, sum(CASE WHEN distance > 200 THEN 1 ELSE 0 END)
              OVER (PARTITION BY route_id, a, z ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS island
  FROM compared
), since AS (
  SELECT *, min(ms) OVER (PARTITION BY route_id, a, z, island) AS since FROM islands WHERE distance <= 200
), due AS (
  SELECT *, row_number() OVER (PARTITION BY route_id, a, z, island ORDER BY ms, event_id) AS nth
  FROM since WHERE ms - since >= 300000
), bunched AS (
  SELECT route_id, bus_id AS bus_id_1, other_bus AS bus_id_2, round(distance, 4) AS distance_meters, ms, event_id
  FROM due WHERE nth = 1
)"""

_ALERT_AQI = f"""SELECT 'AQI_EMERGENCY' AS incident_type, CAST(NULL AS VARCHAR) AS junction_id, zone, sensor_id, aqi,
  CAST(NULL AS VARCHAR) AS route_id, CAST(NULL AS VARCHAR) AS bus_id_1, CAST(NULL AS VARCHAR) AS bus_id_2,
  0.0::DOUBLE AS distance_meters, {_ISO_INSTANT} AS detected_at,
  'Sensor ' || sensor_id || ' in ' || zone || ' reported hazardous AQI=' || CAST(CAST(round(aqi) AS BIGINT) AS VARCHAR)
    AS details
  FROM emergencies"""
_ALERT_GRIDLOCK = f"""SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, junction_id, zone, CAST(NULL AS VARCHAR) AS sensor_id,
  CAST(NULL AS DOUBLE) AS aqi, CAST(NULL AS VARCHAR) AS route_id, CAST(NULL AS VARCHAR) AS bus_id_1,
  CAST(NULL AS VARCHAR) AS bus_id_2, 0.0::DOUBLE AS distance_meters, {_ISO_INSTANT} AS detected_at,
  'Junction ' || junction_id || ' exceeded 180s avg wait for 3 consecutive cycles (avg='
    || CAST(CAST(round(avg_wait) AS BIGINT) AS VARCHAR) || 's)' AS details
  FROM latched"""
_ALERT_BUNCHING = f"""SELECT 'BUS_BUNCHING' AS incident_type, CAST(NULL AS VARCHAR) AS junction_id,
  CAST(NULL AS VARCHAR) AS zone, CAST(NULL AS VARCHAR) AS sensor_id, CAST(NULL AS DOUBLE) AS aqi, route_id,
  bus_id_1, bus_id_2, distance_meters, {_ISO_INSTANT} AS detected_at,
  'Buses ' || bus_id_1 || ' and ' || bus_id_2 || ' on route ' || route_id || ' within '
    || CAST(CAST(round(distance_meters) AS BIGINT) AS VARCHAR) || 'm for >5 minutes' AS details
  FROM bunched"""


def _nullable_json(column: str, quoted: bool) -> str:
    text = f"""'"' || {column} || '"'""" if quoted else f"CAST({column} AS VARCHAR)"
    return f"""'"{column}":' || coalesce({text}, 'null')"""


_ALERT_JSON = "'{' || " + " || ',' || ".join(
    _nullable_json(c, c not in ("aqi", "distance_meters"))
    for c in ("incident_type", "junction_id", "zone", "sensor_id", "aqi", "route_id", "bus_id_1", "bus_id_2",
              "distance_meters", "detected_at", "details")
) + " || '}'"


def _valid(feed: str) -> str:
    columns = ", ".join([*_FEED_FIELDS[feed], "event_time", "event_id"])
    return _BASE + _FEED_SQL[feed] + f"""
    SELECT {columns} FROM (SELECT *, {_REASONS[feed]} AS reason FROM {feed}) WHERE reason IS NULL"""


def oracle_sql() -> dict[str, str]:
    schedule = "WITH " + _SCHEDULE[2:]
    rejected = _rejected()
    found = {
        "ward_energy_15m": _ENERGY + """
            SELECT ward_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
                   round(sum(kwh_reading), 6) AS total_kwh_consumed, round(avg(power_factor) + 1e-9::DOUBLE, 6) AS avg_power_factor,
                   max(voltage) AS peak_voltage
            FROM usable GROUP BY 1, 2""",
        "energy_daily_rollup": _rollup("day"),
        "energy_weekly_rollup": _rollup("week"),
        "energy_monthly_rollup": _rollup("month"),
        "energy_monthly_kept": _rollup("month"),
        "energy_archive_latest": _ENERGY + """
            SELECT ward_id, window_start, CAST(window_start AS DATE) AS date,
                   CAST(max(event_time) >= TIMESTAMP '2024-01-01 06:07:00' AS BIGINT) AS batch_id,
                   round(sum(kwh_reading), 6) AS total_kwh_consumed, max(voltage) AS peak_voltage
            FROM usable GROUP BY 1, 2""",
        "aqi_rolling_10m": _ROLLING + _ROLLING_RESULT,
        "aqi_rolling_10m_sql": _ROLLING + _ROLLING_RESULT,
        "aqi_advisory": _ROLLING + _ZONES + """
            SELECT zone, zone_name, population, num_schools, window_start, window_end,
                   round(rolling_avg_aqi + 1e-9::DOUBLE, 6) AS rolling_avg_aqi
            FROM rolling JOIN zone_profile USING (zone) WHERE rolling_avg_aqi > 150""",
        "aqi_quarterly_trend": _year(_BASE) + _AIR_QUALITY + """
            SELECT zone, CAST(date_trunc('quarter', event_time) AS DATE) AS quarter_start,
                   round(avg(aqi) + 1e-9::DOUBLE, 6) AS avg_aqi, max(aqi) AS peak_aqi, count(aqi) AS reading_count
            FROM air_quality WHERE aqi IS NOT NULL GROUP BY 1, 2""",
        "aqi_quarterly_change": _year(_BASE) + _AIR_QUALITY + """, daily AS (
              SELECT zone, CAST(event_time AS DATE) AS day, sum(aqi) AS s, count(aqi) AS n, max(aqi) AS m
              FROM air_quality WHERE aqi IS NOT NULL GROUP BY 1, 2), quarters AS (
              SELECT zone, CAST(date_trunc('quarter', day) AS DATE) AS quarter_start, sum(s) / sum(n) AS mean, max(m) AS peak_aqi,
                     CAST(sum(n) AS BIGINT) AS reading_count, regr_slope(s / n, date_diff('day', DATE '1970-01-01', day)) AS slope
              FROM daily GROUP BY 1, 2)
            SELECT zone, quarter_start, round(mean + 1e-9::DOUBLE, 6) AS avg_aqi, peak_aqi, reading_count,
                   round(slope + 1e-9::DOUBLE, 6) AS slope_per_day,
                   round(mean - CASE WHEN lag(quarter_start) OVER z = quarter_start - INTERVAL 3 MONTH THEN lag(mean) OVER z END
                         + 1e-9::DOUBLE, 6) AS change
            FROM quarters WINDOW z AS (PARTITION BY zone ORDER BY quarter_start)""",
        "route_schedule_latest": schedule + " SELECT * FROM schedule",
        "route_schedule_messages": schedule + """
            SELECT route_id AS key, '{"route_id":"' || route_id || '","route_name":"' || route_name
                   || '","terminal":"' || terminal || '","scheduled_arrival_time":"' || scheduled_arrival_time
                   || '"}' AS value
            FROM schedule""",
        "gps_enriched": _BASE + _BUS_GPS + _SCHEDULE + """
            SELECT g.* EXCLUDE (ms), s.scheduled_arrival_time, s.route_name, s.terminal,
                   s.route_id IS NOT NULL AS schedule_match
            FROM bus_gps g LEFT JOIN schedule s ON s.route_id = g.route_id""",
        "gps_enriched_messages": _BASE + _BUS_GPS + _SCHEDULE + """
            SELECT g.route_id AS key, g.* EXCLUDE (ms, event_id, event_time),
                   strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
                   s.scheduled_arrival_time, s.route_name, s.terminal, s.route_id IS NOT NULL AS schedule_match
            FROM bus_gps g LEFT JOIN schedule s ON s.route_id = g.route_id
            WHERE event_id % 101 <> 0""",
        "dlq_records": rejected + """
            SELECT source_topic, error_reason, original_key, original_payload FROM rejected""",
        "dlq_report": rejected + """
            SELECT error_reason, count(*) AS n,
                   round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM rejected) + 1e-9::DOUBLE, 6) AS pct
            FROM rejected GROUP BY 1""",
        "dlq_report_5m": rejected + """, counted AS (
              SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, error_reason, count(*) AS n
              FROM rejected GROUP BY 1, 2)
            SELECT window_start, error_reason, n,
                   round(100.0::DOUBLE * n / CAST(sum(n) OVER (PARTITION BY window_start) AS BIGINT) + 1e-9::DOUBLE, 6) AS pct
            FROM counted""",
        "null_aqi_rate": _BASE + _AIR_QUALITY + """
            SELECT count(*) AS total_readings, count(*) FILTER (WHERE aqi IS NULL) AS null_readings,
                   round(100.0::DOUBLE * count(*) FILTER (WHERE aqi IS NULL) / count(*) + 1e-9::DOUBLE, 6) AS null_pct
            FROM air_quality""",
        "aqi_emergency": _recursive(_EMERGENCY) + " SELECT * FROM emergencies",
        "gridlock_latched": _BASE + _CYCLES + " SELECT * FROM latched",
        "gridlock_rolling": _BASE + _CYCLES + """, framed AS (
              SELECT junction_id, zone, ms, event_id, avg(avg_wait_sec) OVER w AS avg_wait,
                     min(avg_wait_sec) OVER w AS least_wait, count(*) OVER w AS seen
              FROM cycles
              WINDOW w AS (PARTITION BY junction_id ORDER BY ms, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
            SELECT junction_id, zone, avg_wait, ms, event_id FROM framed WHERE seen = 3 AND least_wait > 180""",
        "bus_bunching": _BASE + _BUNCHED + " SELECT * FROM bunched",
        "bus_pair_distance": _BASE + _COMPARED + """
            SELECT route_id, bus_id AS bus_id_1, other_bus AS bus_id_2, round(distance, 4) AS distance_meters,
                   ms, event_id
            FROM compared WHERE distance <= 200""",
        "bus_contact_intervals": _BASE + _BUNCHED + """
            SELECT route_id, a AS bus_id_1, z AS bus_id_2, min(ms) AS from_ms, max(ms) AS to_ms,
                   count(*) AS comparisons, round(min(distance), 4) AS closest_meters
            FROM islands WHERE distance <= 200 GROUP BY route_id, a, z, island""",
        "incidents_all": _recursive(_EMERGENCY + _CYCLES + _BUNCHED)
        + f" {_ALERT_AQI} UNION ALL {_ALERT_GRIDLOCK} UNION ALL {_ALERT_BUNCHING}",
        "incident_messages": _recursive(_EMERGENCY + _CYCLES + _BUNCHED)
        + f" SELECT CAST(NULL AS VARCHAR) AS key, {_ALERT_JSON} AS value"
        + f" FROM ({_ALERT_AQI} UNION ALL {_ALERT_GRIDLOCK} UNION ALL {_ALERT_BUNCHING})",
        "json_roundtrip": _BASE + _BUS_GPS + """
            SELECT event_id AS "offset",
                   CASE WHEN event_id % 101 <> 0 THEN bus_id END AS bus_id,
                   CASE WHEN event_id % 101 <> 0 THEN route_id END AS route_id,
                   CASE WHEN event_id % 101 <> 0 THEN lat WHEN event_id % 2 = 1 THEN 13.0::DOUBLE END AS lat,
                   CASE WHEN event_id % 101 <> 0 THEN lon END AS lon,
                   CASE WHEN event_id % 101 <> 0 THEN speed_kmh END AS speed_kmh,
                   CASE WHEN event_id % 101 <> 0 THEN occupancy_pct END AS occupancy_pct,
                   CASE WHEN event_id % 101 <> 0 THEN event_time END AS event_time
            FROM bus_gps""",
        "dedupe_readings": _BASE + _AIR_QUALITY + """, delivered AS (
              SELECT * FROM air_quality UNION ALL SELECT * FROM air_quality WHERE event_id % 10 = 0)
            SELECT * EXCLUDE (ms, rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY sensor_id, event_time ORDER BY event_id) AS rn FROM delivered)
            WHERE rn = 1""",
        "event_milestones": _BASE + """
            SELECT processed, ms, event_id FROM (
              SELECT row_number() OVER (ORDER BY ms, id) AS processed, ms, id AS event_id FROM timed)
            WHERE processed % 200 = 0""",
        "processed_count": """
            SELECT count(*) AS processed, count(*) - count(*) % 200 AS milestone FROM events""",
    }
    for feed in _FEED_SQL:
        found[f"valid_{feed}"] = _valid(feed)
    return found


def _recursive(views: str) -> str:
    return _BASE.replace("WITH base", "WITH RECURSIVE base", 1) + views
